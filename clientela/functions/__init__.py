"""Column expressions and dataset-level helpers."""
