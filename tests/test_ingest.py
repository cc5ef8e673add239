import json
import math

import pytest
from pyspark.sql import functions as F

from fraudlake.sources import files, records
from fraudlake.sources.lake import Lake
from fraudlake.sources.records import RecordSource
from fraudlake.streaming import ingest as ingesting
from tests.rows import frame, txn

RECORD = "key STRING, value STRING, partition INT, offset BIGINT"


def event(number, **changes):
    body = {
        "transaction_id": f"t{number}",
        "account_id": "A",
        "timestamp": "2024-01-01T10:00:00",
        "amount": 5.5,
        "merchant_id": "M",
        "merchant_cat": "C",
        "location_lat": 1.0,
        "location_lon": 2.0,
        "channel": "POS",
        "is_fraud": True,
    } | changes
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def sent(spark, values, first=0):
    rows = [("A", v, i % 2, first + i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, RECORD)
    return df.withColumns({"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")})


@pytest.fixture
def lake(spark, folder):
    suffix = folder.rsplit("-", 1)[1]
    made = Lake(spark, folder, f"raw_{suffix}", f"curated_{suffix}")
    made.create()
    yield made
    made.drop()


def parsed(spark, *values):
    at = F.lit("2024-05-05 01:00:00").cast("timestamp")
    return ingesting.parse_records(sent(spark, values), at).orderBy("kafka_offset").collect()


def test_valid_event(spark):
    (row,) = parsed(spark, event(1))
    assert row["transaction_id"] == "t1"
    assert str(row["event_timestamp"]) == "2024-01-01 10:00:00"
    assert (row["amount"], row["is_fraud_label"], row["dt"]) == (5.5, True, "2024-01-01")
    assert (row["kafka_partition"], row["kafka_offset"]) == (0, 0)


@pytest.mark.parametrize(
    ("changes", "column", "value"),
    [
        ({"amount": "abc"}, "amount", None),
        ({"amount": "7.5"}, "amount", None),
        ({"is_fraud": "true"}, "is_fraud_label", None),
        ({"transaction_id": 5}, "transaction_id", "5"),
        ({"account_id": ...}, "account_id", None),
        ({"timestamp": "2024-01-01 10:00:00"}, "event_timestamp", None),
        ({"timestamp": "2024-01-01T10:00:00.5"}, "event_timestamp", None),
        ({"timestamp": "2024-01-01 10:00:00"}, "dt", "2024-05-05"),
        ({"timestamp": ...}, "dt", "2024-05-05"),
    ],
)
def test_odd_fields(spark, changes, column, value):
    (row,) = parsed(spark, event(1, **changes))
    assert row[column] == value
    assert row["merchant_id"] == "M"


def test_nan_amount(spark):
    value = event(1).replace("5.5", "NaN")
    assert math.isnan(parsed(spark, value)[0]["amount"])
    decoded = ingesting.decode(sent(spark, [value]))
    assert ingesting.accepted(decoded, nan_to_null=True).first()["amount"] is None


def test_fraction_of_a_second_can_be_allowed(spark):
    from fraudlake.functions import parse_event_time

    df = spark.createDataFrame([("2024-01-01T10:00:00.250",), ("2024-01-01T10:00:00",), ("x",)], "t STRING")
    got = [str(r[0]) for r in df.select(parse_event_time(F.col("t"), allow_fraction=True)).collect()]
    assert got == ["2024-01-01 10:00:00.250000", "2024-01-01 10:00:00", "None"]


def test_bad_records_are_set_aside_with_a_reason(spark):
    values = [event(1), "not json", event(2, transaction_id=...), "", None, "[1]"]
    decoded = ingesting.decode(sent(spark, values))
    assert ingesting.accepted(decoded).count() == 1
    got = {r["kafka_offset"]: (r["reason"], r["value"]) for r in ingesting.rejected(decoded).collect()}
    assert got[1] == ("NOT_JSON", bytearray(b"not json"))
    assert got[2][0] == "NO_TRANSACTION_ID"
    assert (got[3][0], got[4][0], got[5][0]) == ("EMPTY", "EMPTY", "NO_TRANSACTION_ID")


def test_two_runs_take_each_record_once(spark, lake, folder):
    source = RecordSource.files(f"{folder}/records")
    source.write(sent(spark, [event(i) for i in range(5)] + ["bad"]))
    assert ingesting.ingest(lake, source, f"{folder}/cp") == 6
    assert ingesting.ingest(lake, source, f"{folder}/cp") == 0
    source.write(sent(spark, [event(i, timestamp="2023-12-31T23:59:59") for i in range(5, 8)], first=6))
    assert ingesting.ingest(lake, source, f"{folder}/cp") == 3
    rows = lake.read(lake.raw).select("transaction_id", "dt").collect()
    assert sorted(r["transaction_id"] for r in rows) == [f"t{i}" for i in range(8)]
    assert sorted(r["dt"] for r in rows) == ["2023-12-31"] * 3 + ["2024-01-01"] * 5
    assert lake.read(lake.quarantine).count() == 1


def test_batch_repeated_after_a_failure_leaves_rows_once(spark, lake, folder, monkeypatch):
    source = RecordSource.files(f"{folder}/records")
    source.write(sent(spark, [event(i) for i in range(5)] + ["bad"]))
    whole = Lake.overwrite_batch

    def broken(self, name, rows, label):
        if name.endswith("quarantine"):
            raise RuntimeError("lost")
        whole(self, name, rows, label)

    monkeypatch.setattr(Lake, "overwrite_batch", broken)
    with pytest.raises(Exception, match="lost"):
        ingesting.ingest(lake, source, f"{folder}/cp")
    assert lake.read(lake.raw).count() == 5
    monkeypatch.setattr(Lake, "overwrite_batch", whole)
    ingesting.ingest(lake, source, f"{folder}/cp")
    assert lake.read(lake.raw).count() == 5
    assert lake.read(lake.quarantine).count() == 1


def test_batch_runs_go_on_from_saved_offsets(spark, lake, folder):
    source = RecordSource.files(f"{folder}/records")
    offsets = f"{folder}/offsets"
    source.write(sent(spark, [event(i) for i in range(5)] + ["bad"]))
    assert ingesting.ingest_batch(lake, source, offsets) == 6
    assert ingesting.ingest_batch(lake, source, offsets) == 0
    source.write(sent(spark, [event(6)], first=6))  # partition 0 only
    assert ingesting.ingest_batch(lake, source, offsets) == 1
    assert ingesting.ingest_batch(lake, source, offsets) == 0
    assert sorted(r[0] for r in lake.read(lake.raw).select("transaction_id").collect()) == [
        "t0", "t1", "t2", "t3", "t4", "t6",
    ]
    assert lake.read(lake.quarantine).count() == 1
    saved = records.saved_progress(spark, offsets)
    assert {r["run"] for r in saved.collect()} == {0, 1}
    assert {r["file"] for r in records.latest(saved).collect()} == set(source.batch(spark).inputFiles())


def test_batch_run_repeated_after_a_failure(spark, lake, folder, monkeypatch):
    source = RecordSource.files(f"{folder}/records")
    offsets = f"{folder}/offsets"
    source.write(sent(spark, [event(i) for i in range(4)]))

    def lost(*args):
        raise RuntimeError("lost")

    store = ingesting._store
    monkeypatch.setattr(ingesting, "_store", lambda *args: (store(*args), lost()))
    with pytest.raises(RuntimeError, match="lost"):
        ingesting.ingest_batch(lake, source, offsets)
    monkeypatch.undo()
    source.write(sent(spark, [event(4)], first=4))
    assert ingesting.ingest_batch(lake, source, offsets) == 5
    assert lake.read(lake.raw).count() == 5


def test_a_retry_after_midnight_leaves_rows_once(spark, lake, folder, monkeypatch):
    """Rows without a readable time go under the day of ingestion, which changes between tries."""
    source = RecordSource.files(f"{folder}/records")
    source.write(sent(spark, [event(i, timestamp="at noon") for i in range(4)]))
    store = ingesting._store

    def lost(*args):
        store(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingesting, "_store", lost)
    with pytest.raises(RuntimeError, match="lost"):
        ingesting.ingest_batch(lake, source, f"{folder}/o", ingested_at=F.lit("2024-05-05 23:59:59").cast("timestamp"))
    monkeypatch.undo()
    ingesting.ingest_batch(lake, source, f"{folder}/o", ingested_at=F.lit("2024-05-06 00:00:09").cast("timestamp"))
    assert [(r["dt"], r["count"]) for r in lake.read(lake.raw).groupBy("dt").count().collect()] == [("2024-05-06", 4)]


def test_two_sources_fill_one_lake(spark, lake, folder):
    for name in "ab":
        source = RecordSource.files(f"{folder}/{name}")
        source.write(sent(spark, [event(f"{name}{i}") for i in range(3)]))
        assert ingesting.ingest_batch(lake, source, f"{folder}/offsets_{name}") == 3
    ids = sorted(r[0] for r in lake.read(lake.raw).select("transaction_id").collect())
    assert ids == ["ta0", "ta1", "ta2", "tb0", "tb1", "tb2"]


def test_records_with_positions_seen_before_are_taken(spark, lake, folder):
    source = RecordSource.files(f"{folder}/records")
    for k in range(2):  # both deliveries count from 0
        source.write(sent(spark, [event(f"{k}-{i}") for i in range(3)]))
        assert ingesting.ingest_batch(lake, source, f"{folder}/o") == 3
    assert lake.read(lake.raw).count() == 6


def test_topic_progress_follows_from_the_records(spark):
    reached = RecordSource.kafka("h:1", "topic").reached(sent(spark, ["a", "b", "c"]))
    assert {(r["partition"], r["next_offset"]) for r in reached.collect()} == {(0, 3), (1, 2)}


def test_only_new_files_are_read(spark, lake, folder):
    source = RecordSource.files(f"{folder}/records")
    for k in range(3):
        before = set(source.batch(spark).inputFiles()) if k else set()
        source.write(sent(spark, [event(f"{k}-{i}") for i in range(3)]))
        saved = records.saved_progress(spark, f"{folder}/o")
        found, reached = source.beyond(spark, None if saved is None else records.latest(saved))
        new = set(source.batch(spark).inputFiles()) - before
        assert set(found.inputFiles()) == {r["file"] for r in reached.collect()} == new
        assert ingesting.ingest_batch(lake, source, f"{folder}/o") == 3
    assert source.beyond(spark, records.latest(records.saved_progress(spark, f"{folder}/o"))) == (None, None)
    assert ingesting.ingest_batch(lake, source, f"{folder}/o") == 0


def test_a_batch_is_read_once(spark, lake, folder):
    """One scan of the records fills both tables; what it was staged in is gone afterwards."""
    source = RecordSource.files(f"{folder}/records")
    source.write(sent(spark, [event(0), "bad"]))
    read = spark.sparkContext.accumulator(0)
    whole = ingesting.decode

    def counting(found, at):
        def each(rows):
            for row in rows:
                read.add(len(row))
                yield row

        return whole(found.mapInPandas(each, found.schema), at)

    ingesting.decode = counting
    try:
        assert ingesting.ingest_batch(lake, source, f"{folder}/o") == 2
    finally:
        ingesting.decode = whole
    assert read.value == 2  # rows, each once
    assert (lake.read(lake.raw).count(), lake.read(lake.quarantine).count()) == (1, 1)


def test_offsets_are_merged(spark):
    first = records.next_offsets(sent(spark, ["a", "b", "c"]))
    only_partition_0 = sent(spark, ["d"], first=7)
    merged = records.next_offsets(only_partition_0, first)
    assert {r["partition"]: r["next_offset"] for r in merged.collect()} == {0: 8, 1: 2}
    assert json.loads(records.starting_offsets(merged, "topic")) == {"topic": {"0": 8, "1": 2}}
    assert json.loads(records.starting_offsets(merged, "topic", 4)) == {"topic": {"0": 8, "1": 2, "2": -2, "3": -2}}
    assert records.starting_offsets(None, "topic") == "earliest"
    assert records.starting_offsets(merged.limit(0), "topic") == "earliest"


def test_payload(spark):
    txns = frame(spark, [txn(1, 0), txn(2, 0, account=None, amount=None)])
    wire = files.to_wire(txns).withColumn("is_fraud", F.lit(None).cast("boolean"))
    got = [(r["key"].decode(), json.loads(r["value"].decode())) for r in records.to_payload(wire).collect()]
    assert [k for k, _ in got] == ["A", "unknown"]
    assert got[0][1]["timestamp"] == "2024-01-01T12:00:00"
    assert got[0][1]["is_fraud"] is False
    assert got[1][1]["amount"] is None
    assert list(got[0][1]) == files.WIRE_EVENT.names


def test_payload_of_typed_times_and_without_account(spark):
    txns = frame(spark, [txn(1, 0)]).drop("account_id")
    row = records.to_payload(txns).first()
    assert row["key"] == b"unknown"
    assert json.loads(row["value"].decode())["event_timestamp"] == "2024-01-01T12:00:00"


def test_replay_at_a_rate(spark, folder):
    made = sent(spark, [event(i) for i in range(20)]).coalesce(1)
    source = records.stage(made, f"{folder}/staged", rows_per_file=5)
    target = RecordSource.files(f"{folder}/topic")
    records.replay(spark, source, target, f"{folder}/cp", max_per_trigger=1, every_seconds=0.2)
    assert sorted(r["offset"] for r in target.batch(spark).collect()) == list(range(20))
    records.replay(spark, source, target, f"{folder}/cp", max_per_trigger=1)
    assert target.batch(spark).count() == 20


def test_csv_and_json_files(spark, folder):
    wire = files.to_wire(frame(spark, [txn(1, 0), txn(2, 5, amount=None, at=(None, 1.5))]))
    want = sorted(map(tuple, wire.collect()), key=str)
    files.write_csv(wire, f"{folder}/csv")
    assert sorted(map(tuple, files.read_csv(spark, f"{folder}/csv").collect()), key=str) == want
    assert dict(files.read_csv(spark, f"{folder}/csv", schema=None).dtypes)["amount"] == "string"
    files.write_json(wire, f"{folder}/json")
    assert sorted(map(tuple, files.read_json(spark, f"{folder}/json").collect()), key=str) == want


def test_csv_goes_by_the_header(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text('amount,account_id,note,transaction_id\n5.5,A,"a ""b"", c",t1\nmuch,B,,t2\n')
    rows = files.read_csv(spark, str(path), more=True).orderBy("transaction_id").collect()
    assert [(r["transaction_id"], r["account_id"], r["amount"], r["channel"]) for r in rows] == [
        ("t1", "A", 5.5, None), ("t2", "B", None, None),
    ]
    assert rows[0]["note"] == 'a "b", c'
    payload = records.to_payload(files.read_csv(spark, str(path), more=True)).collect()
    assert {json.loads(r["value"])["transaction_id"]: json.loads(r["value"])["note"] for r in payload} == {"t1": 'a "b", c', "t2": None}
    assert "note" not in files.read_csv(spark, str(path)).columns


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text("[\n" + ",\n".join(event(i) for i in range(3)) + "\n]")
    assert files.read_json(spark, str(path), array=True).count() == 3
    assert files.from_wire(files.read_json(spark, str(path), array=True)).first()["dt"] == "2024-01-01"


def test_kafka_source_options(spark):
    source = RecordSource.kafka("h:1", "topic", **{"kafka.security.protocol": "SASL_SSL"})
    assert source._subscription() == {
        "kafka.bootstrap.servers": "h:1",
        "kafka.security.protocol": "SASL_SSL",
        "subscribe": "topic",
    }
    assert RecordSource.kafka("h:1", "t", failOnDataLoss="true")._subscription()["failOnDataLoss"] == "true"
