"""Each registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences
from tests.conftest import SMALL

ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, driver.queries()[name], ORACLES[name], SMALL) == []


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [(r["fraud_type"], r["fraud_cnt"]) for r in rows] == [
        ("GEO_ANOMALY", 256),
        ("HIGH_AMOUNT", 24),
        ("VELOCITY", 3),
    ]


def test_known_answers(spark):
    """Counts established beforehand for the smallest tables."""
    from pyspark.sql import functions as F

    scored = driver.queries()["score_transactions"](spark, SMALL)
    row = scored.agg(
        F.count(F.lit(1)),
        F.count_if("fraud_flag_high_amount"),
        F.count_if("fraud_flag_velocity"),
        F.count_if("fraud_flag_geo_anomaly"),
        F.count_if("is_fraud"),
        F.count("geo_distance_km"),
    ).first()
    assert tuple(row) == (1000, 24, 3, 256, 277, 932)
