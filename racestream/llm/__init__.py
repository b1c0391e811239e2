"""Operators for building training corpora: cleaning, near-duplicates, mixing, scoring, packing and placement.

Nothing else in the library imports this subpackage.
"""
