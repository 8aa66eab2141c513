"""Scalar functions on columns: cleaning and string similarity."""
