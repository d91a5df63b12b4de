"""Column functions: file names, dates, safe casts."""
