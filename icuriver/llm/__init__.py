"""Operators on training text and its embeddings; nothing else in the library imports this package."""
