"""Batch plans: ingestion modes and the load of a feed."""
