"""Readers: delimited text, fixed width, archives, file listings."""
