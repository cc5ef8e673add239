"""Known fraud patterns added to generated events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.functions import draws
from fraudlake.sources.reference import CITIES

# The injected amounts, accounts, merchants, times and places.
HIGH_AMOUNTS = (600_000.0, 750_000.0, 1_200_000.0, 900_000.0, 2_000_000.0)
SAMPLE_SEED = 1
VELOCITY_ACCOUNT = "ACC_FRAUD_VEL"
VELOCITY_START = dt.datetime(2024, 6, 15, 14, 0, 0)
VELOCITY_STEP_S = 60
VELOCITY_AMOUNTS = (10_000, 30_000)
GEO_ACCOUNT = "ACC_FRAUD_GEO"
GEO_START = dt.datetime(2024, 7, 1, 10, 0, 0)
GEO_STEP_S = 600

EVENT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_cat", T.StringType()),
        T.StructField("location_lat", T.DoubleType()),
        T.StructField("location_lon", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)


def inject_patterns(events: DataFrame, seed: int = SAMPLE_SEED) -> DataFrame:
    """Raise five sampled rows to high amounts, add a burst of three and a jump of two.

    Input needs the columns of ``EVENT`` and unique transaction ids.
    """
    changed = raise_amounts(events.select(*EVENT.names), seed)
    return changed.unionByName(burst_rows(events, seed)).unionByName(jump_rows(events))


def raise_amounts(events: DataFrame, seed: int) -> DataFrame:
    """Exactly five rows get the high amounts and the label.

    The sample is the five smallest hashes of the id, a top-k; five ids are joined back.
    """
    order = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), "transaction_id"))
    chosen = events.select("transaction_id", order.alias("_order")).orderBy("_order", "transaction_id").limit(len(HIGH_AMOUNTS))
    ids = F.array_sort(F.collect_list(F.struct("_order", "transaction_id")))
    numbered = chosen.agg(ids.alias("_ids")).select(F.posexplode("_ids").alias("_at", "_id"))
    picks = numbered.select(
        F.col("_id.transaction_id").alias("transaction_id"),
        F.element_at(F.array(*(F.lit(a) for a in HIGH_AMOUNTS)), F.col("_at") + 1).alias("_high"),
    )
    return (
        events.join(F.broadcast(picks), "transaction_id", "left")
        .withColumns(
            {
                "amount": F.coalesce("_high", "amount"),
                "is_fraud": F.col("_high").isNotNull() | F.col("is_fraud"),
            }
        )
        .select(*events.columns)
    )


def burst_rows(events: DataFrame, seed: int) -> DataFrame:
    """Three transactions of one account, a minute apart."""
    home = CITIES[0]
    rows = [
        (
            f"{VELOCITY_ACCOUNT}-{i}",
            VELOCITY_ACCOUNT,
            VELOCITY_START + dt.timedelta(seconds=i * VELOCITY_STEP_S),
            None,
            f"MER{7000 + i}",
            "ECOMMERCE",
            home.lat,
            home.lon,
            "ONLINE",
            True,
        )
        for i in range(3)
    ]
    amount = F.round(draws.between(F.col("transaction_id"), seed, "burst", *VELOCITY_AMOUNTS), 2)
    return events.sparkSession.createDataFrame(rows, EVENT).withColumn("amount", amount)


def jump_rows(events: DataFrame) -> DataFrame:
    """Two transactions of one account ten minutes and a thousand kilometres apart."""
    visits = ((CITIES[0], 15_000.0, "MER8001", "RESTAURANT", False), (CITIES[1], 25_000.0, "MER8002", "JEWELLERY", True))
    rows = [
        (
            f"{GEO_ACCOUNT}-{i}",
            GEO_ACCOUNT,
            GEO_START + dt.timedelta(seconds=i * GEO_STEP_S),
            amount,
            merchant,
            category,
            city.lat,
            city.lon,
            "POS",
            label,
        )
        for i, (city, amount, merchant, category, label) in enumerate(visits)
    ]
    return events.sparkSession.createDataFrame(rows, EVENT)
