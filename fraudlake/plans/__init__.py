"""Whole jobs: day scoring, the report pack, the views over the given tables."""
