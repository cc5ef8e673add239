"""From records to the raw table, incrementally and exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fraudlake.functions import day_of, parse_event_time
from fraudlake.schemas import QUARANTINE, RAW_TRANSACTIONS, WIRE_EVENT
from fraudlake.session import delete_path, path_exists, scratch_dir
from fraudlake.sources.lake import Lake
from fraudlake.sources.records import RecordSource, latest, saved_progress


def decode(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Records with the parsed event in ``data`` (all NULL if the value is no JSON object)."""
    return records.select(
        "key",
        "value",
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.from_json(F.col("value").cast("string"), WIRE_EVENT).alias("data"),
        (F.current_timestamp() if ingested_at is None else ingested_at.cast("timestamp")).alias("ingested_at"),
    )


def accepted(decoded: DataFrame, *, nan_to_null: bool = False, allow_fraction: bool = False) -> DataFrame:
    """Raw transactions: the decoded records that have a transaction_id.

    An unreadable time is NULL and puts the row under its date of ingestion. On demand NaN is
    read as NULL, and a time may carry a fraction of a second.
    """

    def number(name: str) -> Column:
        value = F.col(f"data.{name}")
        return (F.when(~F.isnan(value), value) if nan_to_null else value).alias(name)

    return (
        decoded.filter(F.col("data.transaction_id").isNotNull())
        .withColumn("event_timestamp", parse_event_time(F.col("data.timestamp"), allow_fraction=allow_fraction))
        .select(
            "data.transaction_id",
            "data.account_id",
            "event_timestamp",
            number("amount"),
            "data.merchant_id",
            "data.merchant_cat",
            number("location_lat"),
            number("location_lon"),
            "data.channel",
            F.col("data.is_fraud").alias("is_fraud_label"),
            "kafka_offset",
            "kafka_partition",
            "ingested_at",
            day_of(F.col("event_timestamp"), F.col("ingested_at")).alias("dt"),
        )
        .select(*RAW_TRANSACTIONS.columns)
    )


def rejected(decoded: DataFrame) -> DataFrame:
    """Records without a transaction_id, as received, with the reason."""
    text = F.col("value").cast("string")
    reason = (
        F.when(text.isNull() | (F.trim(text) == ""), "EMPTY")
        .when(F.try_parse_json(text).isNull(), "NOT_JSON")
        .otherwise("NO_TRANSACTION_ID")
    )
    return (
        decoded.filter(F.col("data.transaction_id").isNull())
        .withColumn("reason", reason)
        .select(*QUARANTINE.columns)
    )


def parse_records(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    return accepted(decode(records, ingested_at))


def ingest(
    lake: Lake,
    source: RecordSource,
    checkpoint: str,
    *,
    max_per_trigger: int | None = None,
    nan_to_null: bool = False,
    allow_fraction: bool = False,
    ingested_at: Column | None = None,
) -> int:
    """Take in everything the source holds beyond the checkpoint, then stop.

    Returns the number of records read. A backlog is taken in micro-batches of bounded size.
    """
    read = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal read
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        label = f"{stream_id}-{batch_id:08d}"
        with _taken_in(decode(batch, _now() if ingested_at is None else ingested_at)) as (decoded, rows):
            _store(lake, decoded, label, nan_to_null, allow_fraction)
        read += rows

    query = (
        source.stream(lake.spark, max_per_trigger or source.usual_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        # the stream writes in a session of its own; this one may hold an older file listing
        for table in (lake.raw, lake.quarantine):
            lake.spark.catalog.refreshTable(table)
    return read


def ingest_batch(
    lake: Lake,
    source: RecordSource,
    offsets_path: str,
    *,
    nan_to_null: bool = False,
    allow_fraction: bool = False,
    ingested_at: Column | None = None,
) -> int:
    """The same as one batch read, for schedulers that run without a stream.

    Progress is kept as files and saved after the rows are written: next offsets of a topic, or
    the names of the files taken. A run that broke in between is repeated and overwrites what it
    had written: a batch is named after this progress folder and the number of the run. The source is
    read once, and of files only the new ones.
    """
    spark = lake.spark
    saved = saved_progress(spark, offsets_path)
    run = 0 if saved is None else saved.agg(F.max("run")).first()[0] + 1
    records, reached = source.beyond(spark, None if saved is None else latest(saved))
    if records is None:
        return 0
    with _taken_in(decode(records, _now() if ingested_at is None else ingested_at)) as (decoded, read):
        if read:
            _store(lake, decoded, f"{_stream_id(lake, offsets_path)}-{run:08d}", nan_to_null, allow_fraction)
        if reached is None:
            place = {"partition": F.col("kafka_partition"), "offset": F.col("kafka_offset")}
            reached = source.reached(decoded.select(*(c.alias(name) for name, c in place.items())))
        if read or source.format != "kafka":
            reached.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").parquet(offsets_path)
    return read


@contextmanager
def _taken_in(decoded: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """The decoded batch as a table of its own, as long as it is needed, and how many rows it has.

    So the source is read and decoded once, whatever is made of the batch; rows are counted on the way.
    """
    spark = decoded.sparkSession
    path = scratch_dir(spark, "batch")
    counted = Observation()
    decoded.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    try:
        yield spark.read.schema(decoded.schema).parquet(path), counted.get["rows"]
    finally:
        delete_path(spark, path)


def _stream_id(lake: Lake, offsets_path: str) -> str:
    """What tells the batches of this progress folder from all others; made up once and kept."""
    path = f"{offsets_path}-id"
    if not path_exists(lake.spark, path):
        lake.spark.createDataFrame([(uuid.uuid4().hex,)], "id STRING").coalesce(1).write.parquet(path)
    return lake.spark.read.schema("id STRING").parquet(path).first()["id"]


def _now() -> Column:
    """One time for all rows of a batch."""
    return F.lit(datetime.now(timezone.utc))


def _store(lake: Lake, decoded: DataFrame, label: str, nan_to_null: bool, allow_fraction: bool) -> None:
    """Split records into the raw and the quarantine table.

    All that the tables hold under this label is replaced, so a repeated batch leaves each row once.
    """
    good = accepted(decoded, nan_to_null=nan_to_null, allow_fraction=allow_fraction)
    lake.overwrite_batch(lake.raw, good.hint("rebalance", "dt"), label)
    lake.overwrite_batch(lake.quarantine, rejected(decoded).hint("rebalance"), label)
