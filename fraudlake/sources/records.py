"""Keyed records: the topic's format, also as files; payload encoding; offsets."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions.times import EVENT_TIME_FORMAT
from fraudlake.schemas import KAFKA_RECORD
from fraudlake.session import path_exists

POSITION = ["partition", "offset"]
PROGRESS = "partition INT, next_offset BIGINT, file STRING"


@dataclass(frozen=True)
class RecordSource:
    """Where records come from and go to: a Kafka topic, or Parquet files of records."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    partitions: int | None = None

    @classmethod
    def kafka(cls, servers: str, topic: str, partitions: int | None = None, **options: str) -> RecordSource:
        """A topic. Security settings go in ``options`` (``kafka.security.protocol`` ...).

        An explicit start must name every partition of the topic, so a source that goes on from
        saved offsets needs ``partitions`` unless all of them have brought a record.
        """
        return cls("kafka", {"kafka.bootstrap.servers": servers, "topic": topic, **options}, partitions=partitions)

    @classmethod
    def files(cls, path: str) -> RecordSource:
        return cls("parquet", path=path)

    @property
    def usual_batch(self) -> int:
        """Offsets or files of a micro-batch when nothing else is asked for."""
        return 50_000_000 if self.format == "kafka" else 1_000

    def batch(self, spark: SparkSession, starting_offsets: str = "earliest") -> DataFrame:
        """Everything from ``starting_offsets`` to the present end."""
        if self.format != "kafka":
            return spark.read.schema(KAFKA_RECORD).option("recursiveFileLookup", True).format(self.format).load(self.path)
        options = self._subscription() | {"startingOffsets": starting_offsets, "endingOffsets": "latest"}
        return spark.read.format("kafka").options(**options).load()

    def beyond(self, spark: SparkSession, progress: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
        """What is there beyond saved progress: the records, and of files the progress they make.

        A topic is read from the saved offsets on, and a partition without an entry from its start; how far,
        the records tell (``reached``). Of files only those are opened whose names are not saved, whatever
        positions they hold; both are None if there are none.
        """
        if self.format == "kafka":
            offsets = None if progress is None else progress.select("partition", "next_offset")
            return self.batch(spark, starting_offsets(offsets, self.options["topic"], self.partitions)), None
        listed = self.batch(spark).inputFiles()  # a listing, nothing is opened
        files = spark.createDataFrame([(name,) for name in listed], "file STRING")
        if progress is not None:
            files = files.join(progress.select("file"), "file", "left_anti")
        new = sorted(r["file"] for r in files.collect())  # at most the names listed above
        if not new:
            return None, None
        reached = spark.createDataFrame([(None, None, name) for name in new], PROGRESS)
        return spark.read.schema(KAFKA_RECORD).format(self.format).load(new), reached

    def reached(self, records: DataFrame) -> DataFrame:
        """The progress of a topic after these records: the next offset of each partition."""
        return next_offsets(records).withColumn("file", F.lit(None).cast("string"))

    def stream(self, spark: SparkSession, max_per_trigger: int | None = None) -> DataFrame:
        """Records as they come; ``max_per_trigger`` limits a micro-batch, in offsets of a
        topic or in files. A new query starts at the earliest record, later the checkpoint
        decides."""
        if self.format != "kafka":
            reader = spark.readStream.schema(KAFKA_RECORD).option("recursiveFileLookup", True).format(self.format)
            if max_per_trigger:
                reader = reader.option("maxFilesPerTrigger", max_per_trigger)
            return reader.load(self.path)
        reader = spark.readStream.format("kafka").options(**self._subscription(), startingOffsets="earliest")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()

    def write(self, records: DataFrame) -> None:
        """Send records: key and value to a topic, all columns to files."""
        if self.format != "kafka":
            records.write.mode("append").format(self.format).save(self.path)
        else:
            records.select("key", "value").write.format("kafka").options(**self.options).save()

    def _subscription(self) -> dict[str, str]:
        options = {k: v for k, v in self.options.items() if k != "topic"}
        return options | {"subscribe": self.options["topic"]}


def to_payload(events: DataFrame) -> DataFrame:
    """Key and value per event, as bytes; a record position, where known, is kept.

    The value is the whole row as JSON with NULL fields written out and ISO times.
    """
    body = [c for c in events.columns if c not in POSITION]
    if "is_fraud" in body:
        events = events.withColumn("is_fraud", F.coalesce(F.col("is_fraud").cast("boolean"), F.lit(False)))
    key = F.coalesce(F.col("account_id"), F.lit("unknown")) if "account_id" in body else F.lit("unknown")
    formats = {
        "ignoreNullFields": "false",
        "timestampFormat": EVENT_TIME_FORMAT,
        "timestampNTZFormat": EVENT_TIME_FORMAT,
    }
    return events.select(
        F.encode(key, "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*body), formats), "UTF-8").alias("value"),
        *(c for c in POSITION if c in events.columns),
    )


def next_offsets(records: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Per partition the offset to read next.

    A partition that brought nothing keeps its entry in ``previous``, and none moves back.
    """
    reached = records.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))
    if previous is None:
        return reached
    both = previous.select("partition", "next_offset").unionByName(reached)
    return both.groupBy("partition").agg(F.max("next_offset").alias("next_offset"))


def saved_progress(spark: SparkSession, path: str) -> DataFrame | None:
    """Progress saved at ``path`` by all runs (``run``, and offsets or names of files); None before the first."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(f"run INT, {PROGRESS}").parquet(path)


def latest(progress: DataFrame) -> DataFrame:
    """Saved progress of all runs as one: the furthest offset of each partition, every file."""
    return progress.groupBy("partition", "file").agg(F.max("next_offset").alias("next_offset"))


def starting_offsets(offsets: DataFrame | None, topic: str, partitions: int | None = None) -> str:
    """Saved offsets as the JSON a Kafka reader takes; 'earliest' if there are none.

    One entry per partition of the topic, so the text is small. Of ``partitions`` those without
    an entry get -2, which is their start.
    """
    if offsets is None:
        return "earliest"
    saved = {r["partition"]: r["next_offset"] for r in offsets.collect()}
    if not saved:
        return "earliest"
    return json.dumps({topic: {str(p): saved.get(p, -2) for p in sorted({*saved, *range(partitions or 0)})}})


def replay(
    spark: SparkSession,
    source: RecordSource,
    target: RecordSource,
    checkpoint: str,
    *,
    max_per_trigger: int | None = None,
    every_seconds: float | None = None,
) -> None:
    """Send all records of ``source`` on to ``target``, at a limited rate if wanted.

    A micro-batch takes ``max_per_trigger`` offsets or files, one batch every
    ``every_seconds``; without that, batches follow each other at once. The checkpoint makes
    a broken replay go on where it stopped.
    """
    records = source.stream(spark, max_per_trigger)
    if target.format == "kafka":
        writer = records.select("key", "value").writeStream.format("kafka").options(**target.options)
    else:
        writer = records.writeStream.foreachBatch(_folder_per_batch(target))
    writer = writer.option("checkpointLocation", checkpoint)
    if every_seconds is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    query = writer.trigger(processingTime=f"{every_seconds} seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _folder_per_batch(target: RecordSource):
    """Each micro-batch overwrites a folder of its own, so a repeated one leaves no copies."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").format(target.format).save(f"{target.path}/{stream_id}-{batch_id:08d}")

    return write


def stage(records: DataFrame, path: str, rows_per_file: int) -> RecordSource:
    """Records as files of at most ``rows_per_file`` rows: a replay of one file per second
    then sends that many rows per second."""
    records.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return RecordSource.files(path)
