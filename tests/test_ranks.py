import random

import pytest
from pyspark.sql import functions as F

from fraudlake.operators.ranks import cumulated, in_ranges, ranked


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(k, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1, 1, 2, 5])) for k in range(n)]


@pytest.mark.parametrize("rows_per_range", [7, 1000])
def test_places_without_gaps(spark, rows_per_range):
    df = spark.createDataFrame(rows_of(1, 120), "id INT, part STRING, at INT")
    found = ranked(df, ["part"], ["at"], "place", rows_per_range)
    assert found.columns == ["id", "part", "at", "place"]
    got = found.collect()
    assert sorted(r["id"] for r in got) == list(range(120))
    for part in {r["part"] for r in got}:
        own = sorted((r["place"], r["at"] is not None, r["at"] or 0) for r in got if r["part"] == part)
        assert [p for p, *_ in own] == list(range(len(own)))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_equal_rows_are_split(spark):
    df = spark.range(600).select(F.lit(1).alias("x"))
    sizes = [r["count"] for r in in_ranges(df, ["x"], 50).groupBy("_range").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 100
    assert sorted(r["place"] for r in ranked(df, [], ["x"], "place", 50).collect()) == list(range(600))


def test_running_totals(spark):
    rows = [(k, k % 5) for k in range(100)]
    got = cumulated(spark.createDataFrame(rows, "k INT, v INT"), ["k"], "v", "total", 9).collect()
    assert {r["k"]: r["total"] for r in got} == {k: sum(v for _, v in rows[: k + 1]) for k in range(100)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "part STRING, at INT")
    assert ranked(df, ["part"], ["at"], "place").collect() == []
    assert cumulated(df, ["part"], "at", "total").collect() == []


def test_small_ranges_take_no_partition_each(spark):
    """The driver gets a sample for each partition, so there are few of them however small the ranges are."""
    ranged = in_ranges(spark.range(5000).select((F.col("id") * 37 % 5000).alias("x")), ["x"], 20)
    assert len(ranged.inputFiles()) == 1
    rows = ranged.groupBy("_range").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n")).orderBy("_range").collect()
    assert [(r["low"], r["high"], r["n"]) for r in rows] == [(k, k + 19, 20) for k in range(0, 5000, 20)]
