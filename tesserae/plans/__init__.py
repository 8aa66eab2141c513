"""Configuration, the staged pipeline, and the registered queries with their SQL."""
