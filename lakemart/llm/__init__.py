"""Operators that turn raw pages and documents into training data."""
