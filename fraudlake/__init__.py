"""Fraud analytics on Spark: ingest, rule scoring, curated tables, reports and test data."""

from fraudlake.config import FraudConfig

__all__ = ["FraudConfig"]
