"""What an account did before each transaction: trailing count and previous transaction.

Both come from windows over one account, which Spark evaluates in one task per account. That
is right for ordinary accounts: one shuffle and one sort. The rows of accounts that hold very many
are cut into ranges of bounded size instead, in the order of account, time and ties, so that even one
second of one account may be in several. The ranges are written, so a lost executor cannot shift them.
What a range needs from its neighbours (the last row before it, the counts per second) is brought in
by joins, so the result is the same row for row. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.config import FraudConfig
from fraudlake.functions import epoch_seconds
from fraudlake.operators.ranks import in_ranges
from fraudlake.session import written

COUNT_COLUMN = "txn_count_5min"
# columns of the previous transaction, and what they are taken from
PREVIOUS = {"prev_lat": "location_lat", "prev_lon": "location_lon", "prev_ts": "event_timestamp"}
POSITION = ("kafka_partition", "kafka_offset")
SECONDS_PER_BLOCK = 86_400


def account_history(
    df: DataFrame, cfg: FraudConfig = FraudConfig(), *, trailing: bool = True, previous: bool = True
) -> DataFrame:
    """Add ``txn_count_5min`` and ``prev_lat``, ``prev_lon``, ``prev_ts``.

    The count covers the last ``velocity_window_s`` seconds, both ends included, so rows of
    the same second count each other. The previous row is the one before in the order of
    event time, with transaction_id (and the record position, where known) breaking ties.
    """
    if cfg.exempt_null_accounts:
        named = df.filter(F.col("account_id").isNotNull())
        unnamed = df.filter(F.col("account_id").isNull())
        cfg = replace(cfg, exempt_null_accounts=False)
        return account_history(named, cfg, trailing=trailing, previous=previous).unionByName(
            _without_history(unnamed, trailing, previous)
        )

    keys = ["account_id", "dt"] if cfg.isolate_days else ["account_id"]
    heavy = heavy_groups(df, keys, cfg)
    if heavy is None:
        return _windowed(df, keys, cfg, trailing, previous)

    listed = heavy.select(*(F.col(k).alias(f"_heavy_{k}") for k in keys))
    is_listed = _all_equal((df[k], listed[f"_heavy_{k}"]) for k in keys)
    ordinary, large = df.join(listed, is_listed, "left_anti"), df.join(listed, is_listed, "left_semi")
    return _windowed(ordinary, keys, cfg, trailing, previous).unionByName(
        _ranged(large, keys, cfg, trailing, previous)
    )


def heavy_groups(df: DataFrame, keys: list[str], cfg: FraudConfig) -> DataFrame | None:
    """The groups of more than ``slice_rows`` rows with their ``_rows``; None if there are none.

    Counted with map-side combine over the key columns alone, and kept as a table, so that Spark
    knows its size and broadcasts it only if it is small.
    """
    if cfg.slice_rows is None or df.isStreaming:
        return None
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > cfg.slice_rows)
    if sizes.isEmpty():
        return None
    return written(sizes, "heavy")


def _windowed(df: DataFrame, keys: list[str], cfg: FraudConfig, trailing: bool, previous: bool) -> DataFrame:
    """Plain windows. The order of the first one starts with the order of the second, so
    Spark sorts once."""
    out = df.withColumn("_epoch", epoch_seconds(F.col("event_timestamp")))
    if previous:
        in_order = Window.partitionBy(*keys).orderBy("_epoch", *_tie_order(df))
        out = out.withColumns({name: F.lag(source).over(in_order) for name, source in PREVIOUS.items()})
    if trailing:
        recent = Window.partitionBy(*keys).orderBy("_epoch").rangeBetween(-cfg.velocity_window_s, 0)
        out = out.withColumn(COUNT_COLUMN, F.count("transaction_id").over(recent))
    return out.drop("_epoch")


def _without_history(df: DataFrame, trailing: bool, previous: bool) -> DataFrame:
    if previous:
        df = df.withColumns({name: F.when(F.lit(False), F.col(source)) for name, source in PREVIOUS.items()})
    if trailing:
        df = df.withColumn(COUNT_COLUMN, F.col("transaction_id").isNotNull().cast("long"))
    return df


def _ranged(df: DataFrame, keys: list[str], cfg: FraudConfig, trailing: bool, previous: bool) -> DataFrame:
    """The same columns for large accounts, with no task that holds a whole account, day or second."""
    out = df.withColumn("_epoch", epoch_seconds(F.col("event_timestamp")))
    if trailing:
        counts = _per_second(out, keys, cfg)
        same = _all_equal((out[k], counts[f"_n_{k}"]) for k in (*keys, "_epoch"))
        out = out.join(counts, same).drop(*(f"_n_{k}" for k in (*keys, "_epoch")))
    if previous:
        out = _with_previous(out, keys, ["_epoch", *_tie_order(df)], cfg.slice_rows)
    return out.drop("_epoch")


def _per_second(rows: DataFrame, keys: list[str], cfg: FraudConfig) -> DataFrame:
    """The trailing count of each second of a group that has rows; keys are named ``_n_...``.

    Seconds are cut into blocks of a day, each with the tail of the block before, so a window
    group has a bounded number of rows.
    """
    block_s = max(SECONDS_PER_BLOCK, cfg.velocity_window_s)

    def block(second: Column) -> Column:
        return F.floor(second / block_s)

    blocked = (
        rows.groupBy(*keys, "_epoch")
        .agg(F.count("transaction_id").alias("_n"))
        .withColumn(
            "_block", F.explode(F.array_distinct(F.array(block(F.col("_epoch")), block(F.col("_epoch") + cfg.velocity_window_s))))
        )
    )
    recent = Window.partitionBy(*keys, "_block").orderBy("_epoch").rangeBetween(-cfg.velocity_window_s, 0)
    return (
        blocked.withColumn(COUNT_COLUMN, F.sum("_n").over(recent))
        .filter(F.col("_block").eqNullSafe(block(F.col("_epoch"))))
        .select(*(F.col(k).alias(f"_n_{k}") for k in [*keys, "_epoch"]), COUNT_COLUMN)
    )


def _with_previous(rows: DataFrame, keys: list[str], order: list[str], slice_rows: int) -> DataFrame:
    """Lag inside a range of about ``slice_rows`` rows; its first row of an account takes the account's
    last row of the ranges before. Rows of one second, or without time, are cut like any others."""
    ranged = in_ranges(rows, [*keys, *order], slice_rows)
    order = [*order, "_row"]
    part = [*keys, "_range"]
    place = F.struct(*(F.col(source).alias(name) for name, source in PREVIOUS.items()))
    last_rows = ranged.groupBy(*part).agg(F.max_by(place, F.struct(*order)).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_range")  # a row for each range of the account
    carried = last_rows.select(*(F.col(k).alias(f"_c_{k}") for k in part), F.lag("_last").over(before).alias("_carried"))
    inside = Window.partitionBy(*part).orderBy(*order)
    lagged = ranged.withColumns(
        {name: F.lag(source).over(inside) for name, source in PREVIOUS.items()} | {"_opens": F.row_number().over(inside) == 1}
    )
    same = _all_equal((lagged[k], carried[f"_c_{k}"]) for k in part)
    chosen = {name: F.when(F.col("_opens"), F.col("_carried")[name]).otherwise(F.col(name)) for name in PREVIOUS}
    return lagged.join(carried, same).withColumns(chosen).select(*rows.columns, *PREVIOUS)


def _tie_order(df: DataFrame) -> list[str]:
    return ["event_timestamp", "transaction_id", *(c for c in POSITION if c in df.columns)]


def _all_equal(pairs) -> Column:
    """Conjunction of null-safe equalities: NULL accounts form one group."""
    return reduce(and_, (left.eqNullSafe(right) for left, right in pairs))
