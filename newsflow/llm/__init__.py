"""Operators for preparing training data, apart from the news library."""
