"""Readers and writers, and the linkage tables derived from the star schema."""
