"""Helpers the operators share: written tables, unclashing names, streamed groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.session import written as written

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """From here on, Arrow batches between Spark and Python end at BATCH_BYTES, not only at their 10,000 rows,
    which may be hundreds of megabytes of texts. A longer row is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def by_run(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a stream that is sorted by keys; a group may go on in the next batch.

    Cheaper than a Python call per group by Spark where groups are many and small. Holds one batch
    and one group.
    """
    rest: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        changed = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
        for first, end in zip(changed[:-1], changed[1:], strict=True):
            yield batch.iloc[first:end]
        rest = batch.iloc[changed[-1] :]
    if rest is not None:
        yield rest


def sorted_runs(df: DataFrame, keys: list[str], handle: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """handle applied to every group of keys (non-null) of df, groups of bounded size only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_run(batches, keys):
            out = handle(group)
            if out is not None and len(out):
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
