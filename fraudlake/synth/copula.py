"""Gaussian copula over the transaction columns.

Fitting takes three aggregates: approximate quantiles of the numeric columns, counts of the
categories of all columns, and the moments of normal scores. Categories are looked up by joins
with a table of their shares. Sampling is a projection of row ids with such joins.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions import draws, epoch_seconds
from fraudlake.synth.seeds import account_id, merchant_id

NUMERIC = ("event_second", "amount", "location_lat", "location_lon")
CATEGORICAL = ("merchant_cat", "channel", "is_fraud")
STEPS = 200
_NORMAL = NormalDist()


@dataclass(frozen=True)
class CopulaModel:
    quantiles: dict[str, list[float]]  # STEPS + 1 ascending values per numeric column
    null_share: dict[str, float]
    categories: dict[str, list[tuple[str | None, float]]]  # value and share, in value order
    correlation: np.ndarray  # over NUMERIC + CATEGORICAL
    rows: int

    @property
    def cholesky(self) -> np.ndarray:
        return np.linalg.cholesky(self.correlation)


def fit(txns: DataFrame, accuracy: int = 10_000) -> CopulaModel:
    """Learn from rows with event_timestamp, amount, location, merchant_cat, channel, is_fraud."""
    rows = txns.select(
        epoch_seconds(F.col("event_timestamp")).cast("double").alias("event_second"),
        *NUMERIC[1:],
        *(F.col(c).cast("string").alias(c) for c in CATEGORICAL),
    )
    levels = [i / STEPS for i in range(STEPS + 1)]
    stats = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.percentile_approx(c, levels, accuracy).alias(c) for c in NUMERIC),
        *(F.count(c).alias(f"{c}_known") for c in NUMERIC),
    ).first()
    if not stats["rows"]:
        raise ValueError("nothing to learn from")
    quantiles = {c: [float(v) for v in stats[c] or [0.0] * (STEPS + 1)] for c in NUMERIC}
    null_share = {c: 1 - stats[f"{c}_known"] / stats["rows"] for c in NUMERIC}
    categories = _shares(rows, stats["rows"])
    scored = _normal_scores(rows, quantiles, categories)
    return CopulaModel(quantiles, null_share, categories, _correlation(scored), stats["rows"])


def sample(ids: DataFrame, model: CopulaModel, seed: int) -> DataFrame:
    """One event per row of ``ids`` (column ``id``), with a transaction_id."""
    row = F.col("id")
    names = NUMERIC + CATEGORICAL
    independent = [F.col(f"_n{i}") for i in range(len(names))]
    scores = {}
    for i, name in enumerate(names):
        terms = [independent[j] * F.lit(float(w)) for j, w in enumerate(model.cholesky[i, : i + 1]) if w]
        scores[f"_z_{name}"] = sum(terms[1:], terms[0])
    drawn = ids.select("id", *(draws.normal(row, seed, n).alias(f"_n{i}") for i, n in enumerate(names))).withColumns(scores)
    for name in NUMERIC:
        drawn = _bucket(drawn, f"_z_{name}", f"_b_{name}", grid(STEPS))
    for name in CATEGORICAL:
        drawn = _bucket(drawn, f"_z_{name}", f"_b_{name}", category_edges(model.categories[name]))

    def numeric(name: str) -> Column:
        value = _inverse(name, model.quantiles[name])
        if model.null_share[name]:
            value = F.when(draws.uniform(row, seed, f"{name}/known") >= model.null_share[name], value)
        return value

    for name in CATEGORICAL:
        values = [(i, value) for i, (value, _) in enumerate(model.categories[name])]
        named = ids.sparkSession.createDataFrame(values, f"_i_{name} INT, _v_{name} STRING")
        drawn = drawn.join(named, F.col(f"_b_{name}").cast("int") == F.col(f"_i_{name}"), "left")

    return events_of(drawn, seed, numeric, lambda name: F.col(f"_v_{name}"))


def events_of(drawn: DataFrame, seed: int, numeric: Callable[[str], Column], category: Callable[[str], Column]) -> DataFrame:
    """Events of drawn rows (column ``id``), from the values of their numeric and categorical columns."""
    row = F.col("id")
    return drawn.select(
        draws.uuid_of(row, seed).alias("transaction_id"),
        account_id(row, seed).alias("account_id"),
        F.timestamp_seconds(F.floor(numeric("event_second"))).cast("timestamp_ntz").alias("event_timestamp"),
        F.round(numeric("amount"), 2).alias("amount"),
        merchant_id(row, seed).alias("merchant_id"),
        category("merchant_cat").alias("merchant_cat"),
        F.round(numeric("location_lat"), 6).alias("location_lat"),
        F.round(numeric("location_lon"), 6).alias("location_lon"),
        category("channel").alias("channel"),
        category("is_fraud").cast("boolean").alias("is_fraud"),
    )


def _shares(rows: DataFrame, total: int) -> dict[str, list[tuple[str | None, float]]]:
    """Shares of the values of each categorical column, in value order, from one aggregate.

    The model holds them, so columns should be categories: their values have to fit on the driver.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in CATEGORICAL)))
    counts = rows.select(pairs.alias("p")).groupBy("p.name", "p.value").count().collect()
    by_column: dict[str, list] = {c: [] for c in CATEGORICAL}
    for r in counts:
        by_column[r["name"]].append((r["value"], r["count"] / total))
    return {c: sorted(found, key=lambda v: (v[0] is not None, v[0] or "")) for c, found in by_column.items()}


def _normal_scores(rows: DataFrame, quantiles: dict, categories: dict) -> DataFrame:
    """Each value as the normal score of the middle of its quantile step or category."""
    scored = rows
    columns = {}
    for name in NUMERIC:
        edges = sorted(set(quantiles[name][1:-1]))
        # share of rows below each edge: repeated quantiles widen a step
        shares = [(quantiles[name].index(e), STEPS - quantiles[name][::-1].index(e)) for e in edges]
        cuts = [0.0, *((first + last) / 2 / STEPS for first, last in shares), 1.0]
        middles = [_NORMAL.inv_cdf((a + b) / 2) for a, b in itertools.pairwise(cuts)]
        scored = _bucket(scored, name, f"_b_{name}", edges)
        columns[name] = F.coalesce(_lookup(middles, F.col(f"_b_{name}")), F.lit(0.0))
    for name in CATEGORICAL:
        ends = list(itertools.accumulate((share for _, share in categories[name]), initial=0.0))
        middles = [(v, _NORMAL.inv_cdf((a + b) / 2)) for (v, _), a, b in zip(categories[name], ends, ends[1:], strict=False)]
        table = rows.sparkSession.createDataFrame(middles, f"_v_{name} STRING, _m_{name} DOUBLE")
        scored = scored.join(table, F.col(name).eqNullSafe(F.col(f"_v_{name}")), "left")
        columns[name] = F.coalesce(f"_m_{name}", F.lit(0.0))
    return scored.select(*(c.alias(n) for n, c in columns.items()))


def _correlation(scored: DataFrame) -> np.ndarray:
    """Correlation from first and second moments, in one aggregate; 0 with a constant column."""
    names = NUMERIC + CATEGORICAL
    pairs = list(itertools.combinations_with_replacement(range(len(names)), 2))
    means = [F.avg(n).alias(n) for n in names]
    products = [F.avg(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]
    row = scored.agg(*means, *products).first()
    covariance = np.zeros((len(names), len(names)))
    for i, j in pairs:
        covariance[i, j] = covariance[j, i] = row[f"p{i}_{j}"] - row[names[i]] * row[names[j]]
    variance = np.diag(covariance)
    spread = np.sqrt(np.where(variance > 1e-12, variance, np.inf))
    matrix = covariance / np.outer(spread, spread)
    np.fill_diagonal(matrix, 1.0)
    # nearest matrix that has a Cholesky factor
    values, vectors = np.linalg.eigh(matrix)
    fixed = vectors @ np.diag(np.maximum(values, 1e-6)) @ vectors.T
    scale = np.sqrt(np.diag(fixed))
    return fixed / np.outer(scale, scale)


def grid(steps: int) -> list[float]:
    """Normal scores between steps of equal probability."""
    return [_NORMAL.inv_cdf(i / steps) for i in range(1, steps)]


def category_edges(categories: list[tuple[str | None, float]]) -> list[float]:
    """Normal scores between neighbouring categories, strictly ascending."""
    ends = list(itertools.accumulate(share for _, share in categories))[:-1]
    return _ascending([_NORMAL.inv_cdf(min(max(e, 1e-12), 1 - 1e-12)) for e in ends])


def _bucket(df: DataFrame, source: str, target: str, edges: list[float]) -> DataFrame:
    """Index of the interval between ``edges`` a value falls in, by binary search; NULL stays."""
    if not edges:
        return df.withColumn(target, F.when(F.col(source).isNotNull(), 0.0))
    splits = [float("-inf"), *_ascending(edges), float("inf")]
    # "keep" puts NULL and NaN into an extra last bucket
    bucketizer = Bucketizer(splits=splits, inputCol=source, outputCol=target, handleInvalid="keep")
    return bucketizer.transform(df).withColumn(target, F.when(F.col(target) < len(splits) - 1, F.col(target)))


def _ascending(edges: list[float]) -> list[float]:
    """Edges made strictly ascending, as a bucketizer wants them."""
    out: list[float] = []
    for edge in edges:
        out.append(edge if not out or edge > out[-1] else float(np.nextafter(out[-1], np.inf)))
    return out


def _lookup(values: list[float], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), index.cast("int") + 1)


def _inverse(name: str, quantiles: list[float]) -> Column:
    """Value at a normal score: between the two quantiles of its step, by place in the step."""
    index = F.col(f"_b_{name}")
    edges = [-4.0, *grid(STEPS), 4.0]
    low, high = _lookup(edges[:-1], index), _lookup(edges[1:], index)
    place = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(f"_z_{name}") - low) / (high - low)))
    start, end = _lookup(quantiles[:-1], index), _lookup(quantiles[1:], index)
    return start + place * (end - start)
