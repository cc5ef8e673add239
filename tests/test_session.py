import pytest

from fraudlake import session
from tests.conftest import SMALL


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions_for(0, cores=8) == 8
    assert session.shuffle_partitions_for(2**40) == 8192
    assert session.shuffle_partitions_for(100 * 2**40) == 100 * 8192
    assert session.shuffle_partitions_for(session.TARGET_PARTITION_BYTES + 1) == 2


def test_sized_shuffle_is_undone(spark, monkeypatch):
    usual = spark.conf.get(session.SHUFFLE_PARTITIONS)
    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    with session.shuffle_sized_for(rows):
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == usual
    monkeypatch.setattr(session, "TARGET_PARTITION_BYTES", 1000)
    with pytest.raises(RuntimeError), session.shuffle_sized_for(rows):
        assert int(spark.conf.get(session.SHUFFLE_PARTITIONS)) > 50
        raise RuntimeError
    assert spark.conf.get(session.SHUFFLE_PARTITIONS) == usual
    with session.shuffle_sized_for(spark.createDataFrame([(1,)], "a INT")):
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == usual


def test_scratch_folders_are_below_the_shared_one(spark):
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first != second
    assert first.startswith(root)


def test_session_is_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
