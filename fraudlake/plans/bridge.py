"""Card transactions derived from the given ``events`` table.

Event time is compressed tenfold so that accounts become active enough for the rules; city,
channel and gaps follow from the event's own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.sources.reference import CHANNELS, CITIES

BASE_SECOND = 1_704_067_200  # 2024-01-01 00:00:00 UTC


EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions without record position and audit time."""
    # an event whose props name no city keeps its row, without a place
    city = "TRY_CAST(GET_JSON_OBJECT(props, '$.k') AS INT)"
    seconds = f"{BASE_SECOND} + (UNIX_MICROS(CAST(ts AS TIMESTAMP)) - {BASE_SECOND}000000) DIV 10000000"
    placed = events(spark, sf_dir).selectExpr(
        "*",
        f"{city} % {len(CITIES)} AS _city",
        f"CAST(TIMESTAMP_SECONDS({seconds}) AS TIMESTAMP_NTZ) AS event_timestamp",
    )
    return placed.selectExpr(
        "CAST(event_id AS STRING) AS transaction_id",
        "CONCAT('ACC', CAST(10000 + user_id AS STRING)) AS account_id",
        "event_timestamp",
        "CASE WHEN event_id % 97 <> 0 THEN ROUND(value * 3000, 2) END AS amount",
        "CONCAT('MER', CAST(1000 + event_id % 9000 AS STRING)) AS merchant_id",
        "UPPER(event_type) AS merchant_cat",
        f"CASE WHEN event_id % 89 <> 0 THEN {_pick([f'{c.lat}D' for c in CITIES], '_city')} END AS location_lat",
        f"CASE WHEN event_id % 89 <> 0 THEN {_pick([f'{c.lon}D' for c in CITIES], '_city')} END AS location_lon",
        f"{_pick([repr(c) for c in CHANNELS], 'CAST(event_id % 3 AS INT)')} AS channel",
        "event_id % 20 = 0 AS is_fraud_label",
        "CAST(CAST(event_timestamp AS DATE) AS STRING) AS dt",
    )


def with_positions(txns: DataFrame) -> DataFrame:
    """Add the record position a six-partition topic would have given."""
    number = F.col("transaction_id").cast("long")
    return txns.withColumns(
        {
            "kafka_partition": (number % 6).cast("int"),
            "kafka_offset": F.call_function("div", number, F.lit(6)),
        }
    )


def _pick(literals: list[str], index: str) -> str:
    return f"ELEMENT_AT(ARRAY({', '.join(literals)}), {index} + 1)"
