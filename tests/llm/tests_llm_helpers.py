"""Plain-Python results that more than one test compares with."""

from test_rules import plain as plain_measures
from test_suffixes import brute as brute_repeats

__all__ = ["brute_repeats", "plain_measures"]
