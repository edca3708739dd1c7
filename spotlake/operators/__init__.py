"""Operators on typed tables: loading, deduplication, merging, quality and catalogues."""
