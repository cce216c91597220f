"""Structured Streaming forms of the operators. Window functions run on batch frames unchanged."""
