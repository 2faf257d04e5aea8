"""Whole jobs, and the test-data adapters and queries built from the operators."""
