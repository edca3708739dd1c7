"""Operators of a training-data pipeline, on whole tables.

Nothing outside this package imports it. Every operator takes a DataFrame and the names of
the columns that it reads, selects only those, and returns a DataFrame; a null text counts
as an empty one everywhere.
"""
