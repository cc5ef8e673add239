"""Operators for preparing training data, as Spark jobs; nothing else in the package imports them."""
