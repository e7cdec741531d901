"""Operators for preparing training corpora: mixing, deduplication, scoring, search and tokenising.

Nothing else in the library imports this subpackage.
"""
