"""Column functions: keys, text, time and JSON."""
