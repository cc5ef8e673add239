import pytest
from pyspark.sql import functions as F

from fraudlake import FraudConfig
from fraudlake.operators import curate
from fraudlake.plans import bridge, reports
from fraudlake.plans.day import run_day, score_day
from fraudlake.plans.queries import loaded_lake
from fraudlake.sources.lake import Lake, append_by_name, read_evolving
from tests.conftest import SMALL
from tests.rows import MUMBAI, by_id, frame, txn


@pytest.fixture
def lake(spark, folder):
    suffix = folder.rsplit("-", 1)[1]
    made = Lake(spark, folder, f"raw_{suffix}", f"curated_{suffix}")
    made.create()
    yield made
    made.drop()


def load(lake, rows, label="test"):
    """Rows straight into the raw table."""
    df = frame(lake.spark, rows).withColumns(
        {
            "kafka_offset": F.monotonically_increasing_id(),
            "kafka_partition": F.lit(0),
            "ingested_at": F.current_timestamp(),
        }
    )
    lake.overwrite_batch(lake.raw, df, label)


def counts(lake):
    return tuple(lake.read(t).count() for t in (lake.transactions, lake.alerts, lake.summary))


def test_create_twice_and_readiness(lake):
    lake.create()
    assert lake.readiness().filter(~F.col("passed")).isEmpty()
    assert lake.readiness().count() == 12
    assert {r["table_name"] for r in lake.listing().collect()} == {
        "transactions", "quarantine", "fraud_alerts", "fraud_summary",
    }
    described = {r["col_name"] for r in lake.describe(lake.alerts).collect()}
    assert {"alert_id", "fraud_reason", "# Partition Information"} <= described
    lake.spark.sql(f"DROP TABLE {lake.summary}")
    failed = {r["check"] for r in lake.readiness().filter(~F.col("passed")).collect()}
    assert failed == {f"table {lake.summary}", f"columns {lake.summary}"}


def test_day_writes_three_tables_and_repeats(lake):
    load(lake, [txn(0, 0), txn(1, 60, at=MUMBAI), txn(2, 61, amount=6e5, at=MUMBAI, channel="ATM"), txn(3, 86_400)])
    assert run_day(lake, "2024-01-01")
    # the second row jumped; the third is the third within five minutes and of high amount
    assert counts(lake) == (3, 3, 2)
    before = {r["alert_id"] for r in lake.read(lake.alerts).collect()}
    assert run_day(lake, "2024-01-01")
    assert counts(lake) == (3, 3, 2)
    assert {r["alert_id"] for r in lake.read(lake.alerts).collect()} == before
    assert run_day(lake, "2024-01-02")
    assert counts(lake) == (4, 3, 3)


def test_rerun_leaves_no_stale_partition(lake):
    load(lake, [txn(i, i) for i in range(3)])
    run_day(lake, "2024-01-01")
    assert {r["fraud_reason"] for r in lake.read(lake.alerts).collect()} == {"VELOCITY"}
    run_day(lake, "2024-01-01", FraudConfig(velocity_min_count=9))
    assert lake.read(lake.alerts).count() == 0
    assert lake.read(lake.transactions).count() == 3


def test_empty_day_is_left_alone(lake):
    load(lake, [txn(0, 0)])
    run_day(lake, "2024-01-01")
    assert run_day(lake, "2024-02-01") is False
    assert counts(lake) == (1, 0, 1)


def test_day_that_became_empty_is_emptied(lake):
    load(lake, [txn(i, i) for i in range(3)])
    run_day(lake, "2024-01-01")
    lake.truncate(lake.raw)
    assert run_day(lake, "2024-01-01") is False
    assert counts(lake) == (0, 0, 0)


def test_closed_batches_of_a_day_are_folded(lake):
    for n in range(30):
        load(lake, [txn(n, n), txn(100 + n, 86_400 + n)], f"stream-{n:08d}")
    load(lake, [txn(500, 7)], "other-00000000")  # the last of its stream
    assert lake.fold_day("2024-01-01") == 29
    days = [d for _, d in lake._raw_partitions()]
    assert (days.count("2024-01-01"), days.count("2024-01-02")) == (3, 30)
    assert lake.read(lake.raw).count() == 61
    assert lake.fold_day("2024-01-01") == 1
    assert lake.fold_day("2024-01-02") == 29
    assert lake.read(lake.raw).count() == 61
    load(lake, [txn(29, 29), txn(129, 86_429)], "stream-00000029")  # the last batch once more
    load(lake, [txn(30, 30)], "stream-00000030")
    assert lake.fold_day("2024-01-01") == 2
    assert sorted(r[0] for r in lake.read(lake.raw).filter("dt = '2024-01-01'").select("transaction_id").collect()) == sorted(
        [f"t{n:04d}" for n in range(31)] + ["t0500"]
    )


def test_a_broken_fold_is_taken_up(lake, monkeypatch):
    for n in range(4):
        load(lake, [txn(n, n)], f"stream-{n:08d}")
    finish = Lake._finish_folds
    calls = []

    def broken(self):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        finish(self)

    monkeypatch.setattr(Lake, "_finish_folds", broken)
    with pytest.raises(RuntimeError, match="lost"):
        lake.fold_day("2024-01-01")
    monkeypatch.setattr(Lake, "_finish_folds", finish)
    lake.fold_day("2024-01-01")
    assert sorted(r[0] for r in lake.read(lake.raw).select("transaction_id").collect()) == [f"t{n:04d}" for n in range(4)]


def test_writers_follow_new_columns(lake):
    load(lake, [txn(0, 0)])
    for table in (lake.raw, lake.transactions, lake.alerts, lake.summary):
        lake.add_columns(table, "device STRING")
    load(lake, [txn(1, 86_400)], "later")
    assert run_day(lake, "2024-01-01") and run_day(lake, "2024-01-02")
    assert counts(lake)[0] == 2
    assert {r["device"] for r in lake.read(lake.transactions).collect()} == {None}
    more = lake.read(lake.transactions).filter("dt = '2024-01-02'").withColumns({"device": F.lit("d"), "os": F.lit(1)})
    lake.evolve(lake.transactions, more)
    rows = more.collect()
    lake.overwrite_day(lake.transactions, lake.spark.createDataFrame(rows, more.schema), "2024-01-02")
    assert {(r["dt"], r["device"], r["os"]) for r in lake.read(lake.transactions).collect()} == {
        ("2024-01-01", None, None), ("2024-01-02", "d", 1),
    }


def test_stored_score_equals_scored(spark, lake):
    load(lake, [txn(0, 0), txn(1, 60, at=MUMBAI), txn(2, 61, amount=6e5, at=MUMBAI)])
    run_day(lake, "2024-01-01")
    direct = curate.fraud_alerts(score_day(lake.read(lake.raw), "2024-01-01"))
    key = ["transaction_id", "fraud_reason", "fraud_score", "alert_id"]
    assert sorted(lake.read(lake.alerts).select(key).collect()) == sorted(direct.select(key).collect())


def test_day_with_a_rule_of_ones_own(lake):
    from fraudlake.operators.rules import DEFAULT_RULES, Rule

    noon = Rule("NOON", "fraud_flag_noon", lambda cfg: 0.2, lambda cfg: F.hour("event_timestamp") == 12)
    load(lake, [txn(0, 0, amount=6e5), txn(1, 7200)])
    run_day(lake, "2024-01-01", rules=[*DEFAULT_RULES, noon])
    assert by_id(lake.read(lake.transactions), "fraud_reasons") == {"t0000": "HIGH_AMOUNT,NOON", "t0001": ""}
    assert {r["fraud_score"] for r in lake.read(lake.alerts).collect()} == {0.7}


def test_lookback_sees_the_end_of_the_day_before(spark):
    midnight = 12 * 3600
    rows = [txn(0, midnight - 120), txn(1, midnight - 60), txn(2, midnight + 60, at=MUMBAI), txn(9, midnight - 9000)]
    raw = frame(spark, rows)
    alone = by_id(score_day(raw, "2024-01-02"), "fraud_reasons")
    assert alone == {"t0002": ""}
    seen = by_id(score_day(raw, "2024-01-02", FraudConfig(lookback=True)), "fraud_reasons")
    assert seen == {"t0002": "VELOCITY,GEO_ANOMALY"}


def test_lookback_flags_equal_windows_across_days(spark):
    from fraudlake.operators.rules import score_transactions

    raw = bridge.transactions(spark, SMALL)
    want = by_id(score_transactions(raw), "fraud_reasons")
    got = {}
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        got |= by_id(score_day(raw, day, FraudConfig(lookback=True)), "fraud_reasons")
    assert got == want


def test_dedupe_option(spark):
    rows = [txn(0, 0), txn(0, 0), txn(0, 0)]
    assert by_id(score_day(frame(spark, rows), "2024-01-01", FraudConfig(dedupe=True)), "fraud_reasons") == {
        "t0000": ""
    }
    flagged = score_day(frame(spark, rows), "2024-01-01").filter("fraud_flag_velocity").count()
    assert flagged == 3


def test_overwrite_matches_columns_by_name(lake):
    load(lake, [txn(i, i) for i in range(3)])
    day = curate.fraud_alerts(score_day(lake.read(lake.raw), "2024-01-01"))
    lake.overwrite_day(lake.alerts, day.select(*sorted(day.columns)), "2024-01-01")
    row = lake.read(lake.alerts).first()
    assert (row["fraud_reason"], row["account_id"], row["channel"]) == ("VELOCITY", "A", "POS")


def test_day_overwrite_refuses_dynamic_mode(lake):
    lake.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        with pytest.raises(ValueError, match="static"):
            lake.overwrite_day(lake.alerts, lake.read(lake.alerts), "2024-01-01")
    finally:
        lake.spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_truncate_and_drop(lake):
    load(lake, [txn(0, 0)])
    assert lake.read(lake.raw).count() == 1
    lake.truncate(lake.raw)
    assert lake.read(lake.raw).count() == 0
    lake.drop()
    assert not lake.spark.catalog.databaseExists(lake.raw_db)
    lake.drop()


def test_files_of_another_catalog_are_found_again(spark, lake):
    load(lake, [txn(0, 0), txn(1, 86_400)])
    rows = lake.read(lake.raw).count()
    copy = f"{lake.location}-copy"
    lake.read(lake.raw).write.partitionBy("ingest_batch", "dt").parquet(f"{copy}/{lake.raw_db}2/transactions")
    again = Lake(spark, copy, f"{lake.raw_db}2", f"{lake.curated_db}2")
    again.create()
    assert again.read(again.raw).count() == rows == 2
    again.truncate(again.raw)
    assert again.read(again.raw).count() == 0
    again.drop()


def test_new_column_is_null_in_old_rows(lake):
    load(lake, [txn(0, 0)])
    run_day(lake, "2024-01-01")
    lake.add_columns(lake.transactions, "device STRING")
    assert lake.read(lake.transactions).first()["device"] is None


def test_evolving_files(spark, folder):
    spark.range(2).write.parquet(f"{folder}/a")
    spark.range(2, 4).withColumn("x", F.lit("new")).write.parquet(f"{folder}/b")
    df = read_evolving(spark, f"{folder}/a", f"{folder}/b")
    assert {r["id"]: r["x"] for r in df.collect()} == {0: None, 1: None, 2: "new", 3: "new"}
    assert append_by_name(spark.range(1).toDF("id"), df).count() == 5


def test_day_scan_reads_one_partition(spark):
    lake = loaded_lake(spark, SMALL)
    plan = curate.raw_day(lake.read(lake.raw), "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "IsNotNull(transaction_id), IsNotNull(event_timestamp)" in plan
    for report in (reports.channel_rate(lake.read(lake.summary), "2024-01-02"), reports.kpi_day(lake.read(lake.transactions), "2024-01-02")):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in plan
    lake.drop()
