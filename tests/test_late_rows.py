import pytest

from fraudlake.config import FraudConfig
from fraudlake.plans.day import run_changed_days
from fraudlake.sources.lake import Lake
from fraudlake.sources.records import RecordSource
from fraudlake.streaming import ingest as ingesting
from tests.test_ingest import event, sent

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


@pytest.fixture
def lake(spark, folder):
    suffix = folder.rsplit("-", 1)[1]
    made = Lake(spark, folder, f"raw_{suffix}", f"curated_{suffix}")
    made.create()
    yield made
    made.drop()


def test_only_changed_days_are_scored(spark, lake, folder):
    source = RecordSource.files(f"{folder}/records")

    def deliver(*days):
        source.write(sent(spark, [event(f"{d}-{k}", timestamp=f"{d}T10:00:00") for k, d in enumerate(days)]))
        ingesting.ingest_batch(lake, source, f"{folder}/o")

    assert run_changed_days(lake) == []
    deliver(*DAYS)
    assert run_changed_days(lake) == list(DAYS)
    assert run_changed_days(lake) == []
    deliver(DAYS[1])
    deliver(DAYS[1])
    assert lake.changed_days() == [DAYS[1]]
    assert run_changed_days(lake, FraudConfig(lookback=True)) == list(DAYS[1:])  # the next day reads the end of it
    assert lake.read(lake.transactions).filter(f"dt = '{DAYS[1]}'").count() == 3
    lake.fold_day(DAYS[1])
    assert lake.changed_days() == []  # the same rows under another name
    deliver("2024-01-09")
    assert run_changed_days(lake, FraudConfig(lookback=True)) == ["2024-01-09"]
