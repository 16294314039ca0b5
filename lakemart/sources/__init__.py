"""Readers: landed JSON documents, seeds, and Parquet tables."""
