"""Operators for preparing training text, and the corpus pipeline built from them."""
