"""Schemas of the wire event and of the four tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    name: str
    type: str
    comment: str


class Table(NamedTuple):
    """A table: its columns in order, and which of them are partition columns."""

    name: str
    fields: tuple[Field, ...]
    partitions: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type} COMMENT '{f.comment}'" for f in self.fields)


# Column names and types of the wire event and the tables.
WIRE_EVENT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_cat", T.StringType()),
        T.StructField("location_lat", T.DoubleType()),
        T.StructField("location_lon", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)

KAFKA_RECORD = "key BINARY, value BINARY, partition INT, offset BIGINT"

RAW_TRANSACTIONS = Table(
    name="transactions",
    fields=(
        Field("transaction_id", "STRING", "transaction identifier"),
        Field("account_id", "STRING", "account identifier"),
        Field("event_timestamp", "TIMESTAMP_NTZ", "time of the transaction"),
        Field("amount", "DOUBLE", "amount in INR"),
        Field("merchant_id", "STRING", "merchant identifier"),
        Field("merchant_cat", "STRING", "merchant category"),
        Field("location_lat", "DOUBLE", "latitude"),
        Field("location_lon", "DOUBLE", "longitude"),
        Field("channel", "STRING", "ONLINE, ATM or POS"),
        Field("is_fraud_label", "BOOLEAN", "label of the sender, for validation only"),
        Field("kafka_offset", "BIGINT", "offset in the source partition"),
        Field("kafka_partition", "INT", "source partition"),
        Field("ingested_at", "TIMESTAMP", "time of ingestion"),
        Field("dt", "STRING", "event date, yyyy-MM-dd"),
    ),
    partitions=("dt",),
)

CURATED_TRANSACTIONS = Table(
    name="transactions",
    fields=(
        Field("transaction_id", "STRING", "transaction identifier"),
        Field("account_id", "STRING", "account identifier"),
        Field("event_timestamp", "TIMESTAMP_NTZ", "time of the transaction"),
        Field("amount", "DOUBLE", "amount in INR"),
        Field("merchant_id", "STRING", "merchant identifier"),
        Field("merchant_cat", "STRING", "merchant category"),
        Field("location_lat", "DOUBLE", "latitude"),
        Field("location_lon", "DOUBLE", "longitude"),
        Field("is_fraud", "BOOLEAN", "verdict of the rules"),
        Field("fraud_reasons", "STRING", "comma-separated reason codes"),
        Field("etl_processed_at", "TIMESTAMP", "time of the scoring run"),
        Field("dt", "STRING", "event date, yyyy-MM-dd"),
        Field("channel", "STRING", "ONLINE, ATM or POS"),
    ),
    partitions=("dt", "channel"),
)

FRAUD_ALERTS = Table(
    name="fraud_alerts",
    fields=(
        Field("alert_id", "STRING", "alert identifier"),
        Field("transaction_id", "STRING", "transaction identifier"),
        Field("account_id", "STRING", "account identifier"),
        Field("event_timestamp", "TIMESTAMP_NTZ", "time of the transaction"),
        Field("amount", "DOUBLE", "amount in INR"),
        Field("channel", "STRING", "ONLINE, ATM or POS"),
        Field("fraud_score", "DOUBLE", "score of the transaction, 0 to 1"),
        Field("location_lat", "DOUBLE", "latitude"),
        Field("location_lon", "DOUBLE", "longitude"),
        Field("alerted_at", "TIMESTAMP", "time of the scoring run"),
        Field("dt", "STRING", "event date, yyyy-MM-dd"),
        Field("fraud_reason", "STRING", "HIGH_AMOUNT, VELOCITY or GEO_ANOMALY"),
    ),
    partitions=("dt", "fraud_reason"),
)

FRAUD_SUMMARY = Table(
    name="fraud_summary",
    fields=(
        Field("hour", "INT", "hour of the day, 0 to 23"),
        Field("channel", "STRING", "ONLINE, ATM or POS"),
        Field("total_txn", "BIGINT", "transactions"),
        Field("fraud_txn", "BIGINT", "transactions judged fraud"),
        Field("fraud_amount", "DOUBLE", "amount of these, INR"),
        Field("fraud_rate", "DOUBLE", "share of these, percent"),
        Field("summarized_at", "TIMESTAMP", "time of the scoring run"),
        Field("dt", "STRING", "event date, yyyy-MM-dd"),
    ),
    partitions=("dt",),
)

QUARANTINE = Table(
    name="quarantine",
    fields=(
        Field("key", "BINARY", "record key as received"),
        Field("value", "BINARY", "record value as received"),
        Field("kafka_offset", "BIGINT", "offset in the source partition"),
        Field("kafka_partition", "INT", "source partition"),
        Field("reason", "STRING", "why the record was set aside"),
        Field("ingested_at", "TIMESTAMP", "time of ingestion"),
    ),
    partitions=(),
)
