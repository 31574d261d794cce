"""Operators for large text corpora: tokens, duplicates, language, quality, mixing, search."""
