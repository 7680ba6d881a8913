"""Operators for text training data; nothing else in the library imports this."""
