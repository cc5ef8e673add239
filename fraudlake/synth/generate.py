"""Seed rows, fit, sample, inject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudlake.synth.copula import fit, sample
from fraudlake.synth.patterns import inject_patterns
from fraudlake.synth.seeds import SEED, seed_rows
from fraudlake.synth.stored import StoredModel, sample_stored

SEED_ROWS = 2000
ROWS_PER_TASK = 1_000_000


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 0 .. n-1, a million per task."""
    return spark.range(0, n, 1, max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK)))


def generate(
    spark: SparkSession, n: int, seed: int = SEED, seeds: int = SEED_ROWS, stored: StoredModel | None = None
) -> DataFrame:
    """``n`` sampled events and the five injected ones, from a stored model or from one learnt from seed rows."""
    if stored is not None:
        return inject_patterns(sample_stored(row_ids(spark, n), stored, seed))
    model = fit(seed_rows(row_ids(spark, seeds), seed))
    return inject_patterns(sample(row_ids(spark, n), model, seed))
