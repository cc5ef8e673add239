"""Seed rows: independent draws per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.functions import draws
from fraudlake.sources.reference import CHANNELS, CITIES, MERCHANT_CATEGORIES

# Seed, fraud share, amount ranges, jitter, time range and id ranges.
SEED = 42
FRAUD_SHARE = 0.05
FRAUD_AMOUNT = (300_000, 2_000_000)
USUAL_AMOUNT = (100, 50_000)
JITTER_DEGREES = 0.5
FIRST_SECOND = 1_704_067_200  # 2024-01-01 00:00:00 UTC
SECONDS = 60 * 24 * 365
ACCOUNTS = (10_000, 99_999)
MERCHANTS = (1_000, 9_999)


def seed_rows(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """One event per row of ``ids`` (column ``id``), without transaction_id."""
    row = F.col("id")
    places = F.array(*(F.struct(F.lit(c.lat).alias("lat"), F.lit(c.lon).alias("lon")) for c in CITIES))
    city = F.element_at(places, F.col("_city"))
    drawn = ids.select(
        "id",
        (draws.uniform(row, seed, "fraud") < FRAUD_SHARE).alias("is_fraud"),
        draws.integer(row, seed, "city", 1, len(CITIES)).cast("int").alias("_city"),
    )
    amount = F.when(F.col("is_fraud"), draws.between(row, seed, "amount", *FRAUD_AMOUNT)).otherwise(
        draws.between(row, seed, "amount", *USUAL_AMOUNT)
    )
    seconds = F.lit(FIRST_SECOND) + draws.integer(row, seed, "time", 0, SECONDS)
    lat = city["lat"] + draws.between(row, seed, "lat", -JITTER_DEGREES, JITTER_DEGREES)
    lon = city["lon"] + draws.between(row, seed, "lon", -JITTER_DEGREES, JITTER_DEGREES)
    return drawn.select(
        "id",
        account_id(row, seed).alias("account_id"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("event_timestamp"),
        F.round(amount, 2).alias("amount"),
        merchant_id(row, seed).alias("merchant_id"),
        draws.choice(row, seed, "category", MERCHANT_CATEGORIES).alias("merchant_cat"),
        F.round(lat, 6).alias("location_lat"),
        F.round(lon, 6).alias("location_lon"),
        draws.choice(row, seed, "channel", CHANNELS).alias("channel"),
        "is_fraud",
    )


def account_id(row, seed: int):
    return F.concat(F.lit("ACC"), draws.integer(row, seed, "account", *ACCOUNTS).cast("string"))


def merchant_id(row, seed: int):
    return F.concat(F.lit("MER"), draws.integer(row, seed, "merchant", *MERCHANTS).cast("string"))
