"""Documents to packed training sequences: five stages, each a written table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import bounded_batches, fresh, table, written
from fraudlake.llm.decontaminate import clean
from fraudlake.llm.language_id import UNDETERMINED, fit, has_letter, predict
from fraudlake.llm.near_dedup import among, near_duplicates
from fraudlake.llm.packing import place
from fraudlake.llm.pii import mask

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose language is less sure than this is rejected.
LEAST_SURE = 0.5


def in_bounded_batches(stage: Stage) -> Stage:
    """The stage, with texts handed to Python in batches of bounded size."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_bounded_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: null text, text without a letter, and text whose predicted
    language has a score below LEAST_SURE go.

    If no row is labelled and trainable there is no model: all documents with a letter stay.
    """
    model = fit(docs)
    if model is None:
        return docs.filter(has_letter(F.col("text").cast("string")))
    found = fresh(docs, "_found")
    told = (F.col(f"{found}.lang") != UNDETERMINED) & (F.col(f"{found}.score") >= LEAST_SURE)
    return predict(docs, model, found).filter(told).drop(found)


@in_bounded_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest doc_id; of equal or no doc_ids, any one.

    Rows count as documents of their own, whatever their doc_id; those without a word stay.
    """
    row = fresh(docs, "_row")
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    ids = docs.select(F.col(row).alias("doc_id"), F.col("doc_id").alias("own"))
    groups = written(near_duplicates(docs.select(F.col(row).alias("doc_id"), "text")).join(ids, "doc_id"), "groups")
    first = F.struct(F.col("own").isNull().alias("unnamed"), "own", "doc_id")
    stays = groups.groupBy("component_id").agg(F.min(first).alias("first")).select("component_id", F.col("first.doc_id").alias("stays"))
    drop = written(groups.join(stays, "component_id").filter("doc_id <> stays").select(F.col("doc_id").alias(row)), "drop")
    return among(docs, [row], drop, "left_anti").drop(row)


@in_bounded_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


@in_bounded_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return mask(docs)


@in_bounded_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of the context length."""
    return place(docs, added=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", personal_data),
    ("packing", packing),
]

#: Learned models, MinHash, edit distances and token ids have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
