"""Incremental file streams into staging and final tables."""
