"""Trailing count and previous transaction, against brute force, with and without slices."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fraudlake import FraudConfig
from fraudlake.operators.history import account_history, heavy_groups
from tests.rows import START, frame, txn

COLUMNS = ["txn_count_5min", "prev_lat", "prev_lon", "prev_ts"]


def brute(rows, *, isolate_days=False, window=300):
    """Expected history columns per row, as a sorted list."""
    out = []
    for row in rows:
        group = [r for r in rows if r[1] == row[1] and (not isolate_days or r[10] == row[10])]
        second = _second(row)
        count = sum(second - window <= _second(r) <= second for r in group)
        before = sorted((r for r in group if _order(r) < _order(row)), key=_order)
        prev = before[-1] if before else None
        out.append((row[0], row[1], count, *((prev[6], prev[7], prev[2]) if prev else (None,) * 3)))
    return sorted(out, key=str)


def _second(row):
    return int((row[2] - dt.datetime(1970, 1, 1)).total_seconds() // 1)


def _order(row):
    return (_second(row), row[2], row[0])


def history(spark, rows, **options):
    df = account_history(frame(spark, rows), FraudConfig(**options))
    got = [(r["transaction_id"], r["account_id"], *(r[c] for c in COLUMNS)) for r in df.collect()]
    return sorted(got, key=str)


def skewed_rows(n=400, seed=3):
    """Half of the rows in one account, a fifth without one, crowded seconds, two days."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = rng.choice(["HOT"] * 5 + [None, None] + ["B", "C", "D"])
        second = rng.choice([0, 5, 5, 5, rng.randrange(2000), 43_190 + rng.randrange(30), 50_000])
        place = (rng.choice([10.0, 20.0, None]), rng.choice([70.0, 80.0]))
        rows.append(txn(i, second + rng.choice([0, 0.25, 0.5]), account=account, at=place))
    return rows


@pytest.mark.parametrize("isolate_days", [True, False])
@pytest.mark.parametrize("slice_rows", [None, 7, 40])
def test_slices_give_what_windows_give(spark, isolate_days, slice_rows):
    rows = skewed_rows()
    assert history(spark, rows, isolate_days=isolate_days, slice_rows=slice_rows) == brute(
        rows, isolate_days=isolate_days
    )


def test_all_rows_in_one_second(spark):
    rows = [txn(i, 7, account="HOT", at=(float(i), 1.0)) for i in range(60)]
    assert history(spark, rows, slice_rows=5) == brute(rows)


def test_copies_of_one_record_are_cut_too(spark):
    rows = [txn(1, 7, account="HOT")] * 50 + [txn(2, 9, account="HOT", at=(1.0, 2.0))]
    df = account_history(frame(spark, rows), FraudConfig(slice_rows=8))
    got = df.collect()
    assert len(got) == 51
    copies = [r for r in got if r["transaction_id"] == "t0001"]
    assert {r["txn_count_5min"] for r in copies} == {50}
    assert sum(r["prev_ts"] is None for r in copies) == 1
    last = next(r for r in got if r["transaction_id"] == "t0002")
    assert (last["txn_count_5min"], last["prev_lat"]) == (51, 28.6139)


def test_slices_with_record_positions(spark):
    """Copies of a record at several positions follow each other in the order of positions."""
    from pyspark.sql import functions as F

    rows = [txn(i // 3, (i // 30) * 40, account="HOT", at=(float(i), 0.0)) for i in range(120)]
    df = frame(spark, rows).withColumns(
        {"kafka_partition": F.lit(0), "kafka_offset": F.col("location_lat").cast("long")}
    )
    columns = ["kafka_offset", *COLUMNS]
    plain = account_history(df, FraudConfig(slice_rows=None)).select(columns).collect()
    sliced = account_history(df, FraudConfig(slice_rows=7)).select(columns).collect()
    assert sorted(plain, key=str) == sorted(sliced, key=str)
    assert [r["prev_lat"] for r in sorted(sliced, key=lambda r: r["kafka_offset"])] == [None, *map(float, range(119))]


@pytest.mark.parametrize("second", [lambda i: i // 4, lambda i: 7, lambda i: None])
def test_ranges_hold_a_bounded_number_of_rows(spark, second):
    """An account with all rows is cut into ranges of about slice_rows, even within one second or without time."""
    from fraudlake.operators.ranks import in_ranges

    rows = [(i, "HOT", second(i)) for i in range(2000)]
    ranged = in_ranges(spark.createDataFrame(rows, "id INT, account_id STRING, second INT"), ["account_id", "second"], 100)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 200


def test_heavy_groups_come_from_row_counts(spark):
    rows = [txn(i, i, account=a) for i, a in enumerate("AAAAAABBBBCC")]
    df = frame(spark, rows)
    listed = heavy_groups(df, ["account_id"], FraudConfig(slice_rows=3)).collect()
    assert sorted((r["account_id"], r["_rows"]) for r in listed) == [("A", 6), ("B", 4)]
    assert heavy_groups(df, ["account_id"], FraudConfig(slice_rows=None)) is None
    assert heavy_groups(df, ["account_id"], FraudConfig(slice_rows=6)) is None


def test_default_settings_cut_a_large_account_in_few_bytes(spark):
    """Size on disk does not matter: rows of one account above slice_rows are cut."""
    many = spark.range(600_000).selectExpr("'ONE' AS account_id", "id")
    assert heavy_groups(many, ["account_id"], FraudConfig()).first()["_rows"] == 600_000


def test_many_heavy_accounts(spark):
    rows = [txn(i, i % 50, account=f"A{i % 30}", at=(float(i), 0.0)) for i in range(90)]
    assert history(spark, rows, slice_rows=2) == brute(rows)


def test_no_checkpoint_in_the_plan_of_slots(spark):
    df = account_history(frame(spark, skewed_rows(100)), FraudConfig(slice_rows=7))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "RDD[" not in plan.replace("ExistingRDD[", "") or "Checkpoint" not in plan


def test_rows_without_time(spark):
    rows = [txn(0, 0, account="HOT"), txn(1, 1, account="HOT"), txn(2, 2, account="HOT")]
    rows = [(*r[:2], None, *r[3:]) if r[0] == "t0001" else r for r in rows]
    plain = history(spark, rows, slice_rows=None)
    assert history(spark, rows, slice_rows=1) == plain
    assert [r[2] for r in plain] == [1, 1, 2]


def test_independent_of_partitions_and_row_order(spark):
    rows = skewed_rows(150, seed=5)
    shuffled = rows[::-1]
    random.Random(1).shuffle(shuffled)
    first = account_history(frame(spark, rows).repartition(7)).collect()
    second = account_history(frame(spark, shuffled).coalesce(1)).collect()
    assert sorted(map(str, first)) == sorted(map(str, second))


moments = st.integers(0, 700) | st.sampled_from([0, 300, 301, 86_400 - 43_200, 86_399 - 43_200])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(moments, st.sampled_from(["A", "B", None])), max_size=25), st.sampled_from([None, 2]))
def test_any_history_matches_brute_force(spark, events, slice_rows):
    rows = [txn(i, s, account=a, at=(float(i), 0.0), start=START) for i, (s, a) in enumerate(events)]
    assert history(spark, rows, slice_rows=slice_rows) == brute(rows)
