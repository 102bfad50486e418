"""Operators for large training corpora and free text. Nothing outside this package imports it."""
