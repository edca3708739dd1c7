"""Readers and parsers of the raw formats; each parser takes lines or documents as a DataFrame."""
