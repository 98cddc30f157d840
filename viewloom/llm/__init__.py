"""Corpus operators for training data. Nothing else in the library imports this package."""
