"""Operators for large-scale training-data preparation (see the README)."""
