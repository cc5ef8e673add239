"""Fixed reference data: channels, merchant categories, cities."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class City(NamedTuple):
    name: str
    lat: float
    lon: float


# The domains of channel and merchant_cat, and the cities' coordinates.
CHANNELS = ("ONLINE", "ATM", "POS")
MERCHANT_CATEGORIES = (
    "GROCERY", "FUEL", "RESTAURANT", "TRAVEL", "ELECTRONICS",
    "PHARMACY", "JEWELLERY", "TRANSFER", "ATM_WITHDRAWAL", "ECOMMERCE",
)
CITIES = (
    City("New Delhi", 28.6139, 77.2090),
    City("Mumbai", 19.0760, 72.8777),
    City("Bangalore", 12.9716, 77.5946),
    City("Kolkata", 22.5726, 88.3639),
    City("Chennai", 13.0827, 80.2707),
    City("Hyderabad", 17.3850, 78.4867),
    City("Ahmedabad", 23.0225, 72.5714),
    City("Pune", 18.5204, 73.8567),
)


def city_table(spark: SparkSession) -> DataFrame:
    """The cities with their index, as a literal table of fixed size."""
    rows = [(i, *c) for i, c in enumerate(CITIES)]
    return spark.createDataFrame(rows, "city_id INT, city STRING, lat DOUBLE, lon DOUBLE")
