"""Exact token statistics for every context limit from one histogram of encoded lengths.

Documents are counted by length once; suffix sums over the lengths then give, for each length as a
limit, how many documents and tokens lie beyond it and how many tokens are left after truncation.
The sums run in blocks of lengths, so no task holds more than one block or the blocks' totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import whole_text, written
from fraudlake.llm.tokens import RANKS, token_count

LENGTHS_PER_BLOCK = 4096


def token_lengths(docs: DataFrame, ranks_path: str = RANKS, added: bool = False) -> DataFrame:
    """n_tokens of every row; null text has none."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([token_count(t, ranks_path, added) for t in texts], dtype="int64")

    return docs.select(count(whole_text()).alias("n_tokens"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, as a limit: documents and tokens of that length, those longer,
    tokens kept when longer ones are cut to the limit, and the share of documents that fit whole.

    The histogram is read twice and should be a written table.
    """
    blocks = histogram.withColumn("_block", F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK)).withColumn(
        "_tokens", F.col("n_docs") * F.col("n_tokens")
    )
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = (
        blocks.groupBy("_block")
        .agg(F.sum("n_docs").alias("_docs"), F.sum("_tokens").alias("_sum"))
        .select(
            "_block",
            F.coalesce(F.sum("_docs").over(after), F.lit(0)).alias("_docs_after"),
            F.coalesce(F.sum("_sum").over(after), F.lit(0)).alias("_sum_after"),
            F.sum("_docs").over(everything).alias("_all_docs"),
            F.sum("_sum").over(everything).alias("_all_tokens"),
        )
    )
    longer = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    docs_beyond = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("_docs_after")
    tokens_beyond = F.coalesce(F.sum("_tokens").over(longer), F.lit(0)) + F.col("_sum_after")
    return (
        blocks.join(totals, "_block")
        .withColumn("docs_beyond", docs_beyond)
        .withColumn("tokens_beyond", tokens_beyond)
        .select(
            "n_tokens",
            "n_docs",
            "docs_beyond",
            "tokens_beyond",
            (F.col("_all_docs") - F.col("docs_beyond")).alias("docs_within"),
            (F.col("_all_tokens") - F.col("tokens_beyond") + F.col("docs_beyond") * F.col("n_tokens")).alias("truncated_tokens"),
            F.col("_all_tokens").alias("total_tokens"),
            ((F.col("_all_docs") - F.col("docs_beyond")) / F.col("_all_docs")).alias("share_within"),
        )
    )


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of the documents do not exceed."""
    asked = limits.sparkSession.createDataFrame([(float(s),) for s in shares], "share double")
    return (
        limits.join(F.broadcast(asked), F.col("share_within") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )


def token_count_query(docs: DataFrame, added: bool = False) -> DataFrame:
    """context_limits over every row of docs; no row for an empty table. Texts are encoded once."""
    return context_limits(written(length_histogram(token_lengths(docs, added=added)), "histogram"))
