import datetime as dt

from pyspark.sql import functions as F

from fraudlake.plans import reports

SUMMARY = "dt STRING, hour INT, channel STRING, total_txn BIGINT, fraud_txn BIGINT, fraud_amount DOUBLE, fraud_rate DOUBLE"
ALERTS = (
    "alert_id STRING, transaction_id STRING, account_id STRING, event_timestamp TIMESTAMP_NTZ, amount DOUBLE, "
    "channel STRING, fraud_reason STRING, fraud_score DOUBLE, location_lat DOUBLE, location_lon DOUBLE, "
    "alerted_at TIMESTAMP, dt STRING"
)
T0 = dt.datetime(2024, 1, 1)


def summary(spark, rows):
    return spark.createDataFrame(rows, SUMMARY)


def alert(i, account, reason, *, amount=10.0, score=0.5, at=T0, run=T0):
    return (f"x{i}", f"t{i}", account, at, amount, "POS", reason, score, 1.0, 2.0, run, "2024-01-01")


def test_daily_summary_takes_newest_dates_with_data(spark):
    rows = [(f"2024-{m:02d}-{d:02d}", 0, "POS", 10, 1, 5.4, 10.0) for m in (1, 3) for d in range(1, 21)]
    got = reports.daily_summary(summary(spark, rows)).collect()
    assert len(got) == 30
    assert got[0]["txn_date"] == "2024-03-20"
    assert got[-1]["txn_date"] == "2024-01-11"
    assert (got[0]["fraud_rate_pct"], got[0]["fraud_amount_INR"]) == (10.0, 5.0)


def test_rate_is_null_without_transactions(spark):
    df = summary(spark, [("2024-01-01", 0, "POS", 0, 0, 0.0, 0.0)])
    assert reports.daily_summary(df).first()["fraud_rate_pct"] is None
    assert reports.channel_rate(df, "2024-01-01").first()["fraud_rate_pct"] is None


def test_rates_round_half_up(spark):
    df = summary(spark, [("2024-01-01", 0, "POS", 800, 1, 0.0, 0.0)])
    assert reports.daily_summary(df).first()["fraud_rate_pct"] == 0.13


def test_last_days_count_back_from_as_of(spark):
    rows = [(f"2024-01-{d:02d}", 3, "POS", 1, 1, 1.0, 100.0) for d in range(1, 13)]
    got = reports.hourly_heatmap(summary(spark, rows), "2024-01-10").collect()
    assert [r["txn_date"] for r in got] == [f"2024-01-{d:02d}" for d in range(3, 11)]
    assert reports.channel_rate(summary(spark, rows), "2024-01-10").first()["total_txn_count"] == 8
    assert reports.channel_rate(summary(spark, rows)).count() == 0  # as of today


def test_heatmap_rate_is_not_weighted(spark):
    rows = [("2024-01-01", 5, "POS", 100, 100, 0.0, 100.0), ("2024-01-01", 5, "ATM", 1, 0, 0.0, 0.0)]
    got = reports.hourly_heatmap(summary(spark, rows), "2024-01-01").first()
    assert (got["fraud_count"], got["avg_fraud_rate_pct"]) == (100, 50.0)


def test_fraud_type_counts_an_amount_once_per_reason(spark):
    rows = [alert(1, "A", "VELOCITY"), alert(1, "A", "HIGH_AMOUNT"), alert(2, "B", "VELOCITY", amount=None)]
    got = reports.fraud_type(spark.createDataFrame(rows, ALERTS)).collect()
    assert [(r["fraud_type"], r["fraud_cnt"], r["total_amount_INR"]) for r in got] == [
        ("VELOCITY", 2, 10.0),
        ("HIGH_AMOUNT", 1, 10.0),
    ]


def test_top_accounts(spark):
    rows = [alert(i, f"A{i % 12:02d}", "VELOCITY", at=T0 + dt.timedelta(hours=i)) for i in range(24)]
    rows += [alert(99, "A05", "GEO_ANOMALY", amount=None)]
    df = spark.createDataFrame(rows, ALERTS)
    full = reports.top_accounts(df).collect()
    assert [r["account_id"] for r in full] == ["A05", *(f"A{i:02d}" for i in range(10) if i != 5)]
    assert full[0]["fraud_types"] == ["GEO_ANOMALY", "VELOCITY"]
    assert (full[0]["fraud_count"], full[0]["fraud_amount_INR"]) == (3, 20.0)
    assert (full[0]["first_fraud_at"], full[0]["last_fraud_at"]) == (T0, T0 + dt.timedelta(hours=17))
    basic = reports.top_accounts_basic(df).collect()
    assert [tuple(r) for r in basic] == [tuple(r)[:5] for r in full]


def test_latest_alerts_break_ties(spark):
    run2 = T0 + dt.timedelta(days=1)
    rows = [
        alert(1, "A", "VELOCITY", run=T0, at=T0 + dt.timedelta(hours=5)),
        alert(2, "A", "VELOCITY", run=run2),
        alert(3, "A", "VELOCITY", run=run2, at=T0 + dt.timedelta(hours=1)),
        alert(3, "A", "HIGH_AMOUNT", run=run2, at=T0 + dt.timedelta(hours=1)),
    ]
    got = reports.latest_alerts(spark.createDataFrame(rows, ALERTS), newest=3).collect()
    assert [(r["transaction_id"], r["fraud_type"]) for r in got] == [
        ("t3", "HIGH_AMOUNT"),
        ("t3", "VELOCITY"),
        ("t2", "VELOCITY"),
    ]
    assert got[0].asDict().keys() >= {"amount_INR", "latitude", "longitude", "txn_timestamp", "alerted_at"}


def test_kpi(spark):
    df = spark.createDataFrame(
        [("2024-01-02", True, 10.6), ("2024-01-02", False, 5.0), ("2024-01-02", True, None), ("2024-01-01", True, 1.0)],
        "dt STRING, is_fraud BOOLEAN, amount DOUBLE",
    )
    assert tuple(reports.kpi_day(df, "2024-01-02").first()) == ("TODAY", 3, 2, 66.67, 11.0)
    assert tuple(reports.kpi_day(df, "2024-02-01").first()) == ("TODAY", 0, None, None, None)


def test_pack_names(spark):
    alerts = spark.createDataFrame([alert(1, "A", "VELOCITY")], ALERTS)
    txns = alerts.withColumn("is_fraud", F.lit(True))
    pack = reports.run_reports(txns, alerts, summary(spark, [("2024-01-01", 0, "POS", 1, 1, 1.0, 1.0)]), "2024-01-01")
    assert list(pack) == [
        "daily_summary", "channel_rate", "fraud_type", "hourly_heatmap", "top_accounts", "latest_alerts", "kpi_day",
    ]
    assert all(report.count() >= 1 for report in pack.values())
