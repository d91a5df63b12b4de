"""feedloom: config-driven file ingestion, data quality and run observability on Spark."""

from feedloom.specs import FeedSpec, FieldSpec, Tolerance, load_specs

__all__ = ["FeedSpec", "FieldSpec", "Tolerance", "load_specs"]
