"""Places of rows in an order, by ranges: no task holds a whole group, and nothing is collected."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.session import written

ROWS_PER_RANGE = 200_000


def in_ranges(df: DataFrame, order: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """df, written, with ``_range``: ranges of the order (ascending, nulls first) numbered upwards, of
    about ``rows_per_range`` rows each, and ``_row``, which tells equal rows apart.

    Rows that are equal in the order are split too: their row numbers are written first and end the
    order. So a range stays bounded whatever share of the rows is equal.

    The driver gets a sample for each partition, so partitions have ROWS_PER_RANGE rows at least. Smaller
    ranges are cut from sorted partitions by place, and their numbers have gaps.
    """
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    partitions = -(-rows.count() // max(rows_per_range, ROWS_PER_RANGE)) or 1
    dealt = rows.repartitionByRange(partitions, *order, "_row")
    if rows_per_range >= ROWS_PER_RANGE:
        return written(dealt.withColumn("_range", F.spark_partition_id().cast("long")), "ranges")
    first = F.shiftleft(F.spark_partition_id().cast("long"), 33)  # what numbers of a partition begin with
    cut = first + F.floor((F.monotonically_increasing_id() - first) / rows_per_range)
    return written(dealt.sortWithinPartitions(*order, "_row").withColumn("_range", cut), "ranges")


def ranked(df: DataFrame, group: list[str], order: list[str], out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """df with ``out``: 0, 1, 2 ... within each group (null is a group) in the order, without gaps.

    Rows are numbered within their range, and a range starts where the group's earlier ranges end.
    Rows that are equal in the order are numbered in the order in which they were written.
    """
    rows = in_ranges(df, [*group, *order], rows_per_range)
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_range", *group)
        .count()
        .select(
            F.col("_range").alias("_s_range"),
            *(F.col(g).alias(f"_s_{g}") for g in group),
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"),
        )
    )
    place = Window.partitionBy("_range", *group).orderBy(*order, "_row")
    same = reduce(and_, (rows[c].eqNullSafe(starts[f"_s_{c.lstrip('_')}"]) for c in ["_range", *group]))
    return (
        rows.withColumn(out, F.row_number().over(place) - 1)
        .join(starts, same)
        .withColumn(out, F.col(out) + F.col("_start"))
        .select(*df.columns, out)
    )


def cumulated(df: DataFrame, order: list[str], value: str, out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """df with ``out``: the sum of ``value`` over all rows up to this one in the order."""
    rows = in_ranges(df, order, rows_per_range)
    earlier = Window.orderBy("_s_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = (
        rows.groupBy(F.col("_range").alias("_s_range"))
        .agg(F.sum(value).alias("_sum"))
        .select("_s_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_range").orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn(out, F.sum(value).over(within))
        .join(starts, F.col("_range") == F.col("_s_range"))
        .withColumn(out, F.col(out) + F.col("_start"))
        .select(*df.columns, out)
    )
