"""Operators for large corpora of training text."""
