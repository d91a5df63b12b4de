"""Registered queries: every operator over feeds derived from the given tables."""
