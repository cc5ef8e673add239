import math

import pytest

from fraudlake import FraudConfig
from fraudlake.operators.rules import (
    add_verdict,
    apply_rules,
    flag_geo_anomaly,
    flag_high_amount,
    flag_velocity,
    score_of_reasons,
    score_transactions,
)
from pyspark.sql import functions as F
from tests.rows import DELHI, MUMBAI, PUNE, by_id, frame, txn


def test_amount_must_exceed_threshold(spark):
    amounts = [500_000.0, 500_000.01, None, math.nan]
    df = frame(spark, [txn(i, i, amount=a) for i, a in enumerate(amounts)])
    assert by_id(flag_high_amount(df), "fraud_flag_high_amount") == {
        "t0000": False, "t0001": True, "t0002": False, "t0003": True,
    }


@pytest.mark.parametrize(
    ("seconds", "counts"),
    [
        ((0, 60, 120), (1, 2, 3)),
        ((0, 300, 300), (1, 3, 3)),
        ((0, 301, 301), (1, 2, 2)),
        ((10.0, 10.9, 311), (2, 2, 1)),
    ],
)
def test_trailing_count(spark, seconds, counts):
    df = frame(spark, [txn(i, s) for i, s in enumerate(seconds)])
    got = by_id(flag_velocity(df), "txn_count_5min", "fraud_flag_velocity")
    assert tuple(v[0] for _, v in sorted(got.items())) == counts
    assert all(flag == (count >= 3) for count, flag in got.values())


def test_rows_without_account_form_one_group(spark):
    df = frame(spark, [txn(i, i, account=None) for i in range(3)])
    assert by_id(flag_velocity(df), "txn_count_5min") == {"t0000": 1, "t0001": 2, "t0002": 3}
    apart = flag_velocity(df, FraudConfig(exempt_null_accounts=True))
    assert set(by_id(apart, "txn_count_5min").values()) == {1}


def test_custom_thresholds(spark):
    df = frame(spark, [txn(0, 0), txn(1, 500)])
    cfg = FraudConfig(velocity_window_s=500, velocity_min_count=2)
    assert by_id(flag_velocity(df, cfg), "fraud_flag_velocity") == {"t0000": False, "t0001": True}


def test_jump_between_cities(spark):
    df = frame(spark, [txn(0, 0, at=DELHI), txn(1, 600, at=MUMBAI)])
    got = by_id(flag_geo_anomaly(df), "geo_distance_km", "time_diff_sec", "fraud_flag_geo_anomaly")
    assert got["t0000"] == (None, None, False)
    assert got["t0001"] == (pytest.approx(1148.0949, abs=1e-4), 600, True)


@pytest.mark.parametrize(("gap", "flag"), [(0, False), (1, True), (1800, True), (1801, False)])
def test_jump_time_window(spark, gap, flag):
    df = frame(spark, [txn(0, 0, at=DELHI), txn(1, gap, at=MUMBAI)])
    assert by_id(flag_geo_anomaly(df), "fraud_flag_geo_anomaly")["t0001"] is flag


def test_same_second_is_no_jump(spark):
    df = frame(spark, [txn(0, 10.0, at=DELHI), txn(1, 10.9, at=MUMBAI)])
    assert by_id(flag_geo_anomaly(df), "time_diff_sec", "fraud_flag_geo_anomaly")["t0001"] == (0, False)


def test_near_city_is_no_jump(spark):
    df = frame(spark, [txn(0, 0, at=MUMBAI), txn(1, 60, at=PUNE)])
    distance, flag = by_id(flag_geo_anomaly(df), "geo_distance_km", "fraud_flag_geo_anomaly")["t0001"]
    assert distance == pytest.approx(120.1523, abs=1e-4)
    assert flag is False


@pytest.mark.parametrize("pair", [((None, 77.0), MUMBAI), (DELHI, (19.0, None)), ((None, None), MUMBAI)])
def test_missing_coordinate(spark, pair):
    df = frame(spark, [txn(0, 0, at=pair[0]), txn(1, 60, at=pair[1])])
    assert by_id(flag_geo_anomaly(df), "geo_distance_km", "fraud_flag_geo_anomaly")["t0001"] == (None, False)


def test_antipodes_are_no_nan(spark):
    df = frame(spark, [txn(0, 0, at=(0.0, 0.0)), txn(1, 60, at=(0.0, 180.0))])
    assert by_id(flag_geo_anomaly(df), "geo_distance_km")["t0001"] == pytest.approx(20015.0868, abs=1e-4)


def test_nan_coordinate_stays_nan_and_counts_as_far(spark):
    df = frame(spark, [txn(0, 0, at=(math.nan, 77.0)), txn(1, 60, at=MUMBAI)])
    distance, flag = by_id(flag_geo_anomaly(df), "geo_distance_km", "fraud_flag_geo_anomaly")["t0001"]
    assert math.isnan(distance)
    assert flag is True


FLAGS = {
    (True, False, False): ("HIGH_AMOUNT", 0.5),
    (False, True, False): ("VELOCITY", 0.4),
    (False, False, True): ("GEO_ANOMALY", 0.6),
    (True, True, False): ("HIGH_AMOUNT,VELOCITY", 0.9),
    (False, True, True): ("VELOCITY,GEO_ANOMALY", 1.0),
    (True, False, True): ("HIGH_AMOUNT,GEO_ANOMALY", 1.0),
    (True, True, True): ("HIGH_AMOUNT,VELOCITY,GEO_ANOMALY", 1.0),
    (False, False, False): ("", 0.0),
}


def test_verdict_and_score_from_reasons(spark):
    columns = "fraud_flag_high_amount BOOLEAN, fraud_flag_velocity BOOLEAN, fraud_flag_geo_anomaly BOOLEAN"
    df = add_verdict(spark.createDataFrame(list(FLAGS), columns))
    for row in df.withColumn("again", score_of_reasons(F.col("fraud_reasons"))).collect():
        reasons, score = FLAGS[tuple(row[:3])]
        assert row["fraud_reasons"] == reasons
        assert row["fraud_score"] == pytest.approx(score)
        assert row["is_fraud"] is (score > 0)
        assert row["again"] == row["fraud_score"]


def test_burst_flags_only_the_third(spark):
    df = frame(spark, [txn(i, i * 60) for i in range(3)])
    assert by_id(score_transactions(df), "fraud_reasons") == {"t0000": "", "t0001": "", "t0002": "VELOCITY"}


def test_rules_add_columns_and_keep_the_others(spark):
    df = frame(spark, [txn(0, 0)])
    added = [c for c in score_transactions(df).columns if c not in df.columns]
    assert added == [
        "txn_count_5min", "geo_distance_km", "time_diff_sec", "fraud_flag_high_amount", "fraud_flag_velocity",
        "fraud_flag_geo_anomaly", "fraud_reasons", "fraud_score", "is_fraud",
    ]
    assert set(df.columns) <= set(score_transactions(df).columns)


def test_rules_work_on_the_six_input_columns(spark):
    needed = ["transaction_id", "account_id", "event_timestamp", "amount", "location_lat", "location_lon"]
    df = frame(spark, [txn(0, 0), txn(1, 10)]).select(*needed)
    zoned = df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    assert by_id(apply_rules(df), "txn_count_5min") == by_id(apply_rules(zoned), "txn_count_5min")


def test_higher_threshold_never_adds_flags(spark):
    from fraudlake.plans import bridge
    from tests.conftest import SMALL

    txns = bridge.transactions(spark, SMALL)
    usual = by_id(score_transactions(txns), "is_fraud")
    strict = by_id(
        score_transactions(txns, FraudConfig(high_amount=8e5, velocity_min_count=4, geo_distance_km=900.0)), "is_fraud"
    )
    assert all(usual[k] for k, v in strict.items() if v)
    assert sum(strict.values()) < sum(usual.values())
