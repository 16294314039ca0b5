"""File arrival and scheduled refresh on Structured Streaming."""
