"""Operators for large-scale text training data. Nothing outside this subpackage imports it."""
