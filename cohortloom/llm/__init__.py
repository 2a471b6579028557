"""Operators for large text and vector collections. Nothing outside this package imports it."""
