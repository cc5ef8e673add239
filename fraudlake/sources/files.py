"""CSV and JSON files of wire events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.functions import day_of, parse_event_time
from fraudlake.functions.times import EVENT_TIME_FORMAT
from fraudlake.schemas import WIRE_EVENT


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = WIRE_EVENT, *, more: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row, by the header's names in any order.

    Columns of the schema that a file lacks, and values that do not fit their type, are NULL.
    ``more`` keeps the file's other columns, as text; ``schema=None`` takes all columns as text.
    Quotes within quotes are doubled; ``multi_line`` allows line ends within quotes.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)
    found = reader.csv(path)
    if schema is None:
        return found
    named = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    rest = [F.col(f"`{c}`") for c in found.columns if c not in schema.names]
    return found.select(*named, *(rest if more else []))


def write_csv(events: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """With ``rows_per_file`` no file has more rows than that."""
    events.write.mode("overwrite").options(header=True, quote='"', escape='"', maxRecordsPerFile=rows_per_file).csv(path)


def read_json(spark: SparkSession, path: str, *, array: bool = False) -> DataFrame:
    """JSON lines, or with ``array`` files that hold one JSON array each.

    An array file cannot be split; use it for exchange, lines for volume.
    """
    return spark.read.schema(WIRE_EVENT).option("multiLine", array).json(path)


def write_json(events: DataFrame, path: str) -> None:
    events.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def to_wire(txns: DataFrame) -> DataFrame:
    """Raw transactions as wire events: ISO time text, label as ``is_fraud``."""
    return txns.withColumns(
        {
            "timestamp": F.date_format("event_timestamp", EVENT_TIME_FORMAT),
            "is_fraud": F.col("is_fraud_label"),
        }
    ).select(*WIRE_EVENT.names)


def from_wire(events: DataFrame) -> DataFrame:
    """Wire events as raw transactions, without record position and audit time."""
    columns = {
        "event_timestamp": parse_event_time(F.col("timestamp")),
        "is_fraud_label": F.col("is_fraud"),
    }
    return (
        events.withColumns(columns)
        .withColumn("dt", day_of(F.col("event_timestamp"), F.current_timestamp()))
        .drop("timestamp", "is_fraud")
    )
