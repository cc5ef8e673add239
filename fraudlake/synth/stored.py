"""A copula model as tables, and sampling by joins with them.

A model is learnt once, saved in a folder and sampled from as often as wanted, by any cluster. The
folder holds four tables:

- ``steps``: name, low, high (normal scores, low included), start, end: a quantile step of a numeric column,
- ``categories``: name, low, high, value: the scores that stand for a value of a categorical column,
- ``weights``: name, draw, weight: rows of the Cholesky factor,
- ``missing``: name, share: how much of a numeric column is null.

Normal scores are cut into as many cells as a column has intervals, equally likely ones but for a few
percent. An interval is listed under each cell that it touches and a score has one cell, so
each row meets a few intervals in an equality join, however many categories there are.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions import draws
from fraudlake.synth.copula import CATEGORICAL, NUMERIC, CopulaModel, category_edges, events_of, grid

#: Beyond this score a value lies at the end of its outermost step.
FARTHEST = 4.0
TABLES = {
    "steps": "name STRING, low DOUBLE, high DOUBLE, start DOUBLE, end DOUBLE",
    "categories": "name STRING, low DOUBLE, high DOUBLE, value STRING",
    "weights": "name STRING, draw INT, weight DOUBLE",
    "missing": "name STRING, share DOUBLE",
}

#: Correlations of STATED_MODEL that are not 0.
_STATED_PAIRS = {
    ("amount", "is_fraud"): 0.5,
    ("location_lat", "location_lon"): 0.3,
    ("amount", "channel"): -0.2,
    ("event_second", "merchant_cat"): 0.1,
}


def _stated_correlation() -> np.ndarray:
    names = NUMERIC + CATEGORICAL
    pairs = _STATED_PAIRS | {(b, a): r for (a, b), r in _STATED_PAIRS.items()}
    return np.array([[1.0 if a == b else pairs.get((a, b), 0.0) for b in names] for a in names])


#: A model that was not learnt, for use without any data and for tests.
STATED_MODEL = CopulaModel(
    quantiles={
        "event_second": [1_704_067_200.0, 1_704_153_600.0, 1_704_200_000.0, 1_704_326_400.0, 1_704_585_600.0],
        "amount": [100.0, 900.0, 4_000.0, 12_000.0, 30_000.0, 50_000.0, 300_000.0, 2_000_000.0],
        "location_lat": [8.5, 12.9, 13.1, 18.5, 19.1, 22.6, 28.7],
        "location_lon": [72.3, 72.9, 73.9, 77.2, 78.5, 80.3, 88.9],
    },
    null_share={"event_second": 0.0, "amount": 0.02, "location_lat": 0.01, "location_lon": 0.01},
    categories={
        "merchant_cat": [(None, 0.03), ("ELECTRONICS", 0.17), ("FUEL", 0.2), ("GROCERY", 0.35), ("TRAVEL", 0.25)],
        "channel": [("ATM", 0.2), ("ONLINE", 0.45), ("POS", 0.35)],
        "is_fraud": [("false", 0.95), ("true", 0.05)],
    },
    correlation=_stated_correlation(),
    rows=0,
)


@dataclass(frozen=True)
class StoredModel:
    steps: DataFrame
    categories: DataFrame
    weights: DataFrame
    missing: DataFrame


def model_rows(model: CopulaModel) -> dict[str, list[tuple]]:
    """The rows of each table. Scores run from -infinity to infinity without gaps."""
    infinity = float("inf")
    rows: dict[str, list[tuple]] = {t: [] for t in TABLES}
    for name in NUMERIC:
        values = model.quantiles[name]
        scores = itertools.pairwise([-infinity, *grid(len(values) - 1), infinity])
        rows["steps"] += [(name, *z, *v) for z, v in zip(scores, itertools.pairwise(values), strict=True)]
        rows["missing"].append((name, float(model.null_share[name])))
    for name in CATEGORICAL:
        scores = itertools.pairwise([-infinity, *category_edges(model.categories[name]), infinity])
        rows["categories"] += [(name, *z, value) for z, (value, _) in zip(scores, model.categories[name], strict=True)]
    for i, name in enumerate(NUMERIC + CATEGORICAL):
        rows["weights"] += [(name, j, float(model.cholesky[i, j])) for j in range(i + 1)]
    return rows


def save_model(spark: SparkSession, model: CopulaModel, path: str) -> None:
    """Replaces what the folder holds."""
    for table, rows in model_rows(model).items():
        spark.createDataFrame(rows, TABLES[table]).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{table}")


def load_model(spark: SparkSession, path: str) -> StoredModel:
    return StoredModel(*(spark.read.schema(TABLES[t]).parquet(f"{path.rstrip('/')}/{t}") for t in TABLES))


def sample_stored(ids: DataFrame, model: StoredModel, seed: int) -> DataFrame:
    """One event per row of ``ids`` (column ``id``), the one that `sample` draws from the same model.

    Only weights and null shares are literals of the plan: a number for each (pair of) columns.
    """
    row = F.col("id")
    names = NUMERIC + CATEGORICAL
    weights: dict[str, list[tuple[int, float]]] = {n: [] for n in names}
    for r in sorted(model.weights.collect()):
        weights[r["name"]].append((r["draw"], r["weight"]))
    missing = {r["name"]: r["share"] for r in model.missing.collect()}
    if not all(weights.values()):
        raise ValueError("not a whole model")
    scores = {}
    for name in names:
        terms = [F.col(f"_n{j}") * F.lit(w) for j, w in weights[name] if w]
        scores[f"_z_{name}"] = sum(terms[1:], terms[0])
    drawn = ids.select("id", *(draws.normal(row, seed, n).alias(f"_n{i}") for i, n in enumerate(names))).withColumns(scores)
    drawn = drawn.drop(*(f"_n{i}" for i in range(len(names))))
    for name in NUMERIC:
        drawn = _met(drawn, model.steps, name, {c: f"_{c}_{name}" for c in ("low", "high", "start", "end")})
    for name in CATEGORICAL:
        drawn = _met(drawn, model.categories, name, {"value": f"_value_{name}"})

    def numeric(name: str) -> Column:
        low = F.greatest(F.col(f"_low_{name}"), F.lit(-FARTHEST))
        high = F.least(F.col(f"_high_{name}"), F.lit(FARTHEST))
        place = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(f"_z_{name}") - low) / (high - low)))
        value = F.col(f"_start_{name}") + place * (F.col(f"_end_{name}") - F.col(f"_start_{name}"))
        if missing[name]:
            value = F.when(draws.uniform(row, seed, f"{name}/known") >= missing[name], value)
        return value

    return events_of(drawn, seed, numeric, lambda name: F.col(f"_value_{name}"))


def _met(drawn: DataFrame, intervals: DataFrame, name: str, taken: dict[str, str]) -> DataFrame:
    """drawn with columns of the interval of ``name`` that its score lies in."""
    own = intervals.filter(F.col("name") == name)
    cells = own.count()
    if not cells:
        raise ValueError(f"the model knows nothing of {name}")
    low, high = F.col("low"), F.col("high")
    listed = own.select(
        F.explode(F.sequence(_cell(low, cells), _cell(high, cells))).alias("_cell"),
        low.alias("_from"),
        high.alias("_to"),
        *(F.col(c).alias(new) for c, new in taken.items()),
    )
    score = F.col(f"_z_{name}")
    inside = (_cell(score, cells) == F.col("_cell")) & (score >= F.col("_from")) & (score < F.col("_to"))
    return drawn.join(listed, inside).drop("_cell", "_from", "_to")


def _cell(score: Column, cells: int) -> Column:
    """Number of the cell of a score: a logistic curve is close to the normal distribution, and it rises with the score."""
    share = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-1.702) * score))
    return F.least(F.floor(share * cells), F.lit(cells - 1)).cast("int")
