"""Operators for building training data from the corpus."""
