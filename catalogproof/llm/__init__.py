"""Operators that turn a document collection into training data."""
