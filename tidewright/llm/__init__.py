"""Operators for building training data from text: filters, duplicates, tokens, models and extraction."""
