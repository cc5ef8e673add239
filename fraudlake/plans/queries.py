"""The registered queries: each operator over the whole of the given tables.

Every query takes the session and the folder of the tables. Run times that would differ from
run to run are fixed. Reports look at a day in the middle of the data. Tables that a query makes stay in the shared
folder only as long as their rows are needed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.config import FraudConfig
from fraudlake.functions import days_before, haversine_km
from fraudlake.operators import curate
from fraudlake.operators.history import account_history
from fraudlake.operators.ranks import cumulated
from fraudlake.operators.rules import (
    flag_geo_anomaly,
    flag_high_amount,
    flag_velocity,
    score_transactions,
)
from fraudlake.plans import bridge, reports
from fraudlake.plans.day import run_changed_days, run_day
from fraudlake.session import delete_path, scratch_dir, written
from fraudlake.sources import files, records
from fraudlake.sources.lake import INGEST_BATCH, Lake, append_by_name, read_evolving
from fraudlake.sources.records import RecordSource
from fraudlake.sources.reference import CITIES, city_table
from fraudlake.streaming import ingest as ingesting
from fraudlake.synth import STATED_MODEL, fit, inject_patterns, load_model, sample, sample_stored, save_model, seed_rows
from fraudlake.synth.copula import CATEGORICAL, NUMERIC, STEPS
from fraudlake.synth.patterns import EVENT, VELOCITY_ACCOUNT, VELOCITY_AMOUNTS

AS_OF = "2024-01-03"
REPORT_DAY = "2024-01-02"
RUN_AT_TEXT = "2024-01-04 01:00:00"
LATE_RUN_AT_TEXT = "2024-01-05 01:00:00"
DAYS = FraudConfig(isolate_days=True)
SEED = 42

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def run_at():
    return F.lit(RUN_AT_TEXT).cast("timestamp")


def scored(spark: SparkSession, sf_dir: str, cfg: FraudConfig = DAYS, days: int | None = None) -> DataFrame:
    """Scored transactions; with ``days`` only of so many days before the day of the reports, and of that day.

    Days are scored on their own, so the others are left out before anything is read or counted.
    """
    txns = curate.usable(bridge.transactions(spark, sf_dir))
    if days is not None:
        txns = txns.filter(F.col("dt").between(days_before(REPORT_DAY, days), days_before(REPORT_DAY, 0)))
    return score_transactions(txns, cfg)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.fraud_alerts(scored(spark, sf_dir), run_at())


def summary(spark: SparkSession, sf_dir: str, days: int | None = None) -> DataFrame:
    return curate.fraud_summary(scored(spark, sf_dir, days=days), run_at())


def positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.with_positions(bridge.transactions(spark, sf_dir))


def as_records(txns: DataFrame) -> DataFrame:
    """Transactions with a record position as keyed JSON records."""
    placed = {"partition": F.col("kafka_partition"), "offset": F.col("kafka_offset")}
    wire = [F.col(c) for c in files.to_wire(txns).columns]
    events = txns.withColumns(
        placed
        | {
            "timestamp": F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss"),
            "is_fraud": F.col("is_fraud_label"),
        }
    )
    return records.to_payload(events.select(*wire, "partition", "offset"))


def new_lake(spark: SparkSession) -> Lake:
    root = scratch_dir(spark, "lake")
    suffix = root.rsplit("-", 1)[1]
    lake = Lake(spark, root, f"raw_{suffix}", f"curated_{suffix}")
    lake.create()
    return lake


def taken_out(lake: Lake, rows: DataFrame, label: str) -> DataFrame:
    """rows as files of their own, after which the lake they came from is dropped."""
    path = scratch_dir(lake.spark, label)
    rows.write.parquet(path)
    lake.drop()
    delete_path(lake.spark, lake.location)
    return lake.spark.read.schema(rows.schema).parquet(path)


def loaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose raw table holds the transactions, taken in through the record stream."""
    lake = new_lake(spark)
    source = RecordSource.files(f"{lake.location}/records")
    source.write(as_records(positioned(spark, sf_dir)))
    ingesting.ingest(lake, source, f"{lake.location}/checkpoint", ingested_at=run_at())
    return lake


# ---- ingest ---------------------------------------------------------------------------------


@query
def ingest_parse_json(spark, sf_dir):
    parsed = ingesting.parse_records(as_records(positioned(spark, sf_dir)), run_at())
    return parsed.drop("ingested_at")


@query
def ingest_derive_dt(spark, sf_dir):
    """Some events carry a time the format does not match; they go under the ingestion date."""
    sent = as_records(positioned(spark, sf_dir))
    odd = (F.col("offset") * 6 + F.col("partition")) % 71 == 0
    text = F.col("value").cast("string")
    spoilt = F.when(odd, F.regexp_replace(text, r"(\d{4}-\d\d-\d\d)T", "$1 ")).otherwise(text)
    parsed = ingesting.parse_records(sent.withColumn("value", spoilt.cast("binary")), run_at())
    return parsed.select("transaction_id", "event_timestamp", "dt")


@query
def ingest_quarantine(spark, sf_dir):
    """Some records are spoilt in four ways; all of them, and only they, are set aside."""
    sent = as_records(positioned(spark, sf_dir))
    number = F.col("offset") * 6 + F.col("partition")
    value = (
        F.when(number % 53 == 0, F.lit("not json"))
        .when(number % 59 == 0, F.lit('{"account_id":"ACC1"}'))
        .when(number % 61 == 0, F.lit(""))
        .when(number % 67 == 0, F.lit(None))
        .otherwise(F.col("value").cast("string"))
    )
    decoded = ingesting.decode(sent.withColumn("value", value.cast("binary")), run_at())
    return ingesting.rejected(decoded).select(
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("record_value"),
        "kafka_offset",
        "kafka_partition",
        "reason",
    )


@query
def ingest_next_offsets(spark, sf_dir):
    """Offsets after two batches; the second one is merged over the first."""
    sent = positioned(spark, sf_dir).select(
        "dt", F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")
    )
    first = records.next_offsets(sent.filter(F.col("dt") < AS_OF))
    return records.next_offsets(sent.filter(F.col("dt") >= AS_OF), first)


@query
def ingest_available_now(spark, sf_dir):
    """Two deliveries, two runs of the stream over one checkpoint."""
    lake = new_lake(spark)
    source = RecordSource.files(f"{lake.location}/records")
    txns = positioned(spark, sf_dir)
    for delivery in (F.col("dt") < AS_OF, F.col("dt") >= AS_OF):
        source.write(as_records(txns.filter(delivery)))
        ingesting.ingest(lake, source, f"{lake.location}/checkpoint", ingested_at=run_at())
    return taken_out(lake, lake.read(lake.raw).drop("ingested_at", INGEST_BATCH.name), "raw")


@query
def ingest_two_sources(spark, sf_dir):
    """Two sources with offsets of their own fill one lake; record positions repeat between them."""
    lake = new_lake(spark)
    txns = positioned(spark, sf_dir)
    for name, part in (("a", F.col("dt") < AS_OF), ("b", F.col("dt") >= AS_OF)):
        source = RecordSource.files(f"{lake.location}/records_{name}")
        for half in (0, 1):
            source.write(as_records(txns.filter(part & (F.col("kafka_partition") % 2 == half))))
            ingesting.ingest_batch(lake, source, f"{lake.location}/offsets_{name}", ingested_at=run_at())
    return taken_out(lake, lake.read(lake.raw).drop("ingested_at", INGEST_BATCH.name), "raw")


@query
def fold_raw_day(spark, sf_dir):
    """Six deliveries; then the closed batches of each day are folded into one partition."""
    lake = new_lake(spark)
    source = RecordSource.files(f"{lake.location}/records")
    for partition in range(6):
        source.write(as_records(positioned(spark, sf_dir).filter(F.col("kafka_partition") == partition)))
        ingesting.ingest_batch(lake, source, f"{lake.location}/offsets", ingested_at=run_at())
    for day in _day_names(lake):
        lake.fold_day(day)
    return taken_out(lake, lake.read(lake.raw).drop("ingested_at", INGEST_BATCH.name), "raw")


@query
def ingest_batch(spark, sf_dir):
    """Two deliveries, two batch runs with saved offsets; a third run finds nothing."""
    lake = new_lake(spark)
    source = RecordSource.files(f"{lake.location}/records")
    txns = positioned(spark, sf_dir)
    for delivery in (F.col("dt") < AS_OF, F.col("dt") >= AS_OF, F.lit(False)):
        source.write(as_records(txns.filter(delivery)))
        ingesting.ingest_batch(lake, source, f"{lake.location}/offsets", ingested_at=run_at())
    return taken_out(lake, lake.read(lake.raw).drop("ingested_at", INGEST_BATCH.name), "raw")


@query
def kafka_payload(spark, sf_dir):
    """Keys and values as sent, decoded again."""
    sent = as_records(positioned(spark, sf_dir))
    decoded = ingesting.decode(sent, run_at())
    return decoded.select(
        F.col("key").cast("string").alias("record_key"), "kafka_partition", "kafka_offset", "data.*"
    ).withColumnRenamed("timestamp", "event_time")


# ---- files ----------------------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    files.write_csv(files.to_wire(bridge.transactions(spark, sf_dir)), path)
    return files.from_wire(files.read_csv(spark, path))


@query
def csv_by_name(spark, sf_dir):
    """A CSV with columns in another order, quotes and a column of its own, as payload and back."""
    path = scratch_dir(spark, "csv")
    wire = files.to_wire(bridge.transactions(spark, sf_dir)).withColumn("note", F.lit('said "so", once'))
    files.write_csv(wire.select(*sorted(wire.columns, reverse=True)), path)
    payload = records.to_payload(files.read_csv(spark, path, more=True))
    body = F.from_json(F.col("value").cast("string"), "transaction_id STRING, amount DOUBLE, merchant_cat STRING, note STRING")
    return payload.select(F.col("key").cast("string").alias("record_key"), body.alias("b")).select("record_key", "b.*")


@query
def json_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "json")
    files.write_json(files.to_wire(bridge.transactions(spark, sf_dir)), path)
    return files.from_wire(files.read_json(spark, path))


@query
def schema_evolution(spark, sf_dir):
    """Older files lack category and place; a third delivery is appended by name."""
    root = scratch_dir(spark, "evolution")
    txns = bridge.transactions(spark, sf_dir)
    early = ["transaction_id", "account_id", "event_timestamp", "amount", "dt"]
    later = [*early, "merchant_cat", "location_lat", "location_lon"]
    txns.filter("dt = '2024-01-01'").select(*early).write.parquet(f"{root}/v1")
    txns.filter("dt = '2024-01-02'").select(*later).write.parquet(f"{root}/v2")
    stored = read_evolving(spark, f"{root}/v1", f"{root}/v2")
    return append_by_name(stored, txns.filter("dt > '2024-01-02'").select(*later, "channel"))


@query
def schema_evolution_tables(spark, sf_dir):
    """Tables that get a column between two day jobs take the rows of both."""
    lake = loaded_lake(spark, sf_dir)
    for day in _day_names(lake):
        if day == AS_OF:
            for table in (lake.raw, lake.transactions, lake.alerts):
                lake.add_columns(table, "device STRING")
        run_day(lake, day, FraudConfig(), run_at())
    held = lake.read(lake.transactions).select("transaction_id", "dt", "fraud_reasons", "device")
    return taken_out(lake, held, "evolved")


@query
def dim_city_coords(spark, sf_dir):
    """Transactions per city: counted by coordinates first, then named by the eight-row table."""
    counts = (
        bridge.transactions(spark, sf_dir)
        .groupBy("location_lat", "location_lon")
        .agg(F.count(F.lit(1)).alias("txn_count"))
    )
    cities = F.broadcast(city_table(spark))
    here = (F.col("lat") == F.col("location_lat")) & (F.col("lon") == F.col("location_lon"))
    return cities.join(counts, here, "right").select(
        F.coalesce("city_id", F.lit(-1)).alias("city_id"), "city", "location_lat", "location_lon", "txn_count"
    )


# ---- rules ----------------------------------------------------------------------------------


@query
def scan_raw_day(spark, sf_dir):
    return curate.raw_day(bridge.transactions(spark, sf_dir), AS_OF)


@query
def rule_high_amount(spark, sf_dir):
    flagged = flag_high_amount(bridge.transactions(spark, sf_dir))
    return flagged.select("transaction_id", "amount", "fraud_flag_high_amount")


@query
def rule_velocity(spark, sf_dir):
    flagged = flag_velocity(bridge.transactions(spark, sf_dir), DAYS)
    return flagged.select("transaction_id", "txn_count_5min", "fraud_flag_velocity")


@query
def rule_velocity_custom(spark, sf_dir):
    cfg = FraudConfig(isolate_days=True, velocity_window_s=3600, velocity_min_count=2)
    flagged = flag_velocity(bridge.transactions(spark, sf_dir), cfg)
    return flagged.select("transaction_id", "txn_count_5min", "fraud_flag_velocity")


@query
def rule_geo_anomaly(spark, sf_dir):
    flagged = flag_geo_anomaly(bridge.transactions(spark, sf_dir), DAYS)
    return flagged.select(
        "transaction_id",
        F.round("geo_distance_km", 4).alias("geo_distance_km"),
        F.col("time_diff_sec").cast("double").alias("time_diff_sec"),
        "fraud_flag_geo_anomaly",
    )


@query
def velocity_count(spark, sf_dir):
    """Trailing count over all days of an account."""
    counted = account_history(bridge.transactions(spark, sf_dir), previous=False)
    return counted.select("transaction_id", "account_id", "event_timestamp", "txn_count_5min")


@query
def prev_transaction(spark, sf_dir):
    """Place and time of the account's previous transaction, over all days."""
    found = account_history(bridge.transactions(spark, sf_dir), trailing=False)
    return found.select("transaction_id", "prev_lat", "prev_lon", "prev_ts")


@query
def time_since_previous(spark, sf_dir):
    flagged = flag_geo_anomaly(bridge.transactions(spark, sf_dir))
    return flagged.select("transaction_id", F.col("time_diff_sec").cast("double").alias("time_diff_sec"))


@query
def haversine_distance(spark, sf_dir):
    """Distance of each transaction from the first city."""
    home = CITIES[0]
    away = haversine_km(F.lit(home.lat), F.lit(home.lon), F.col("location_lat"), F.col("location_lon"))
    return bridge.transactions(spark, sf_dir).select("transaction_id", F.round(away, 4).alias("distance_km"))


def _comparable(df: DataFrame) -> DataFrame:
    """Distance rounded, since engines differ in the last bit; the nullable integer as double,
    since data frames of other engines have no nullable integer."""
    return df.withColumns(
        {
            "geo_distance_km": F.round("geo_distance_km", 4),
            "time_diff_sec": F.col("time_diff_sec").cast("double"),
        }
    )


@query
def score_transactions_daily(spark, sf_dir):
    return _comparable(scored(spark, sf_dir))


@query
def score_transactions_across_days(spark, sf_dir):
    return _comparable(scored(spark, sf_dir, FraudConfig()))


@query
def score_transactions_hot_account(spark, sf_dir):
    """A third of all rows in one account, and another part without one: scored in slices."""
    number = F.col("transaction_id").cast("long")
    account = F.when(number % 3 == 0, F.lit("ACC_HOT")).when(number % 11 != 0, F.col("account_id"))
    txns = bridge.transactions(spark, sf_dir).withColumn("account_id", account)
    return _comparable(score_transactions(txns, FraudConfig(slice_rows=500)))


@query
def score_transactions_hot_second(spark, sf_dir):
    """A third of all rows in one second of one account, and rows of it without a time: scored in ranges."""
    number = F.col("transaction_id").cast("long")
    hot = {
        "account_id": F.when(number % 3 == 0, F.lit("ACC_HOT")).otherwise(F.col("account_id")),
        "event_timestamp": F.when(number % 39 == 0, F.lit(None))
        .when(number % 3 == 0, F.lit(f"{REPORT_DAY} 10:00:00"))
        .otherwise(F.col("event_timestamp"))
        .cast("timestamp_ntz"),
    }
    return _comparable(score_transactions(bridge.transactions(spark, sf_dir).withColumns(hot), FraudConfig(slice_rows=500)))


@query
def score_transactions_null_accounts_apart(spark, sf_dir):
    """Rows without an account, never compared with each other."""
    number = F.col("transaction_id").cast("long")
    txns = bridge.transactions(spark, sf_dir).withColumn(
        "account_id", F.when(number % 5 != 0, F.col("account_id"))
    )
    return _comparable(score_transactions(txns, FraudConfig(exempt_null_accounts=True)))


@query
def dedupe_transactions(spark, sf_dir):
    """Each transaction sent again a minute later, and some a third time; first copies stay."""
    txns = bridge.transactions(spark, sf_dir)
    again = txns.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 1 MINUTE"))
    third = txns.filter(F.col("is_fraud_label"))
    return curate.keep_first_copy(txns.unionByName(again).unionByName(third))


# ---- curated tables -------------------------------------------------------------------------


@query
def curated_transactions(spark, sf_dir):
    return curate.curated_transactions(scored(spark, sf_dir), run_at()).drop("etl_processed_at")


@query
def fraud_alerts(spark, sf_dir):
    return alerts(spark, sf_dir).drop("alerted_at")


@query
def fraud_summary(spark, sf_dir):
    return summary(spark, sf_dir).drop("summarized_at")


@query
def detection_metrics(spark, sf_dir):
    return curate.detection_metrics(scored(spark, sf_dir))


def _day_names(lake: Lake) -> list[str]:
    """Days of the raw table, from its partitions."""
    return sorted(r["dt"] for r in lake.read(lake.raw).select("dt").distinct().collect())


@query
def rerun_day_idempotent(spark, sf_dir):
    """All days scored under loose thresholds and then again under the usual ones: what the
    tables hold per day and partition must be what one run leaves."""
    lake = loaded_lake(spark, sf_dir)
    loose = FraudConfig(high_amount=1.0, velocity_min_count=1)
    for cfg in (loose, FraudConfig(), FraudConfig()):
        for day in _day_names(lake):
            run_day(lake, day, cfg, run_at())

    def held(table: str, part: str, amount: str) -> DataFrame:
        return (
            lake.read(table)
            .groupBy("dt", F.col(part).alias("part"))
            .agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum(amount), 2).alias("amount"))
            .select(F.lit(table.split(".")[1]).alias("table_name"), "dt", "part", "row_count", "amount")
        )

    parts = [
        held(lake.transactions, "channel", "amount"),
        held(lake.alerts, "fraud_reason", "amount"),
        held(lake.summary, "channel", "fraud_amount"),
    ]
    return taken_out(lake, reduce(DataFrame.unionByName, parts), "held")


@query
def late_rows_rerun(spark, sf_dir):
    """Some rows of one day come after all days were scored: only that day is scored again, at a later time."""
    lake = new_lake(spark)
    source = RecordSource.files(f"{lake.location}/records")
    txns = positioned(spark, sf_dir)
    late = (F.col("dt") == REPORT_DAY) & (F.col("transaction_id").cast("long") % 10 == 0)
    for delivery, at in ((~late, RUN_AT_TEXT), (late, LATE_RUN_AT_TEXT)):
        source.write(as_records(txns.filter(delivery)))
        ingesting.ingest_batch(lake, source, f"{lake.location}/offsets", ingested_at=run_at())
        run_changed_days(lake, FraudConfig(), F.lit(at).cast("timestamp"))
    held = (
        lake.read(lake.transactions)
        .groupBy("dt", "channel", F.date_format("etl_processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("amount"), 2).alias("amount"), F.count_if("is_fraud").alias("fraud_count"))
    )
    return taken_out(lake, held, "late")


# ---- tables ---------------------------------------------------------------------------------


@query
def ddl_bootstrap(spark, sf_dir):
    """Create, load, score, truncate, drop; one row per step and table."""
    lake = loaded_lake(spark, sf_dir)
    for day in _day_names(lake):
        run_day(lake, day, FraudConfig(), run_at())
    counted = [(1, "loaded", t, lake.read(t).count(), True) for t in lake.tables()]
    for table in lake.tables():
        lake.truncate(table)
    counted += [(2, "truncated", t, lake.read(t).count(), True) for t in lake.tables()]
    lake.drop()
    counted += [(3, "dropped", t, 0, spark.catalog.tableExists(t)) for t in lake.tables()]
    suffix = lake.raw_db.removeprefix("raw")
    rows = [(n, step, t.replace(f"{suffix}.", "."), count, exists) for n, step, t, count, exists in counted]
    return spark.createDataFrame(
        rows, "step INT, action STRING, table_name STRING, row_count BIGINT, table_exists BOOLEAN"
    )


@query
def ddl_describe(spark, sf_dir):
    """Columns of all tables as the catalog has them, with the rows the table holds."""
    lake = loaded_lake(spark, sf_dir)
    suffix = lake.raw_db.removeprefix("raw")
    described = []
    for table in lake.tables():
        held = lake.read(table).agg(F.count(F.lit(1)).alias("row_count"))
        described.append(lake.columns(table).withColumn("row_count", held.scalar()))
    named = reduce(DataFrame.unionByName, described).withColumn(
        "table_name", F.regexp_replace("table_name", f"{suffix}\\.", ".")
    )
    return taken_out(lake, named, "described")


@query
def readiness_report(spark, sf_dir):
    """What the tables of a filled lake hold; some records are spoilt and set aside again as copies."""
    lake = new_lake(spark)
    source = RecordSource.files(f"{lake.location}/records")
    sent = as_records(positioned(spark, sf_dir))
    number = F.col("offset") * 6 + F.col("partition")
    source.write(sent)
    source.write(sent.filter(number % 43 == 0).withColumn("value", F.lit("not json").cast("binary")))
    ingesting.ingest_batch(lake, source, f"{lake.location}/offsets", ingested_at=run_at())
    for day in _day_names(lake):
        run_day(lake, day, FraudConfig(), run_at())
    if not lake.readiness().filter(~F.col("passed")).isEmpty():
        raise RuntimeError("tables are not as specified")
    return taken_out(lake, lake.health(), "health")


# ---- reports --------------------------------------------------------------------------------


def curated_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with all days scored and written."""
    lake = loaded_lake(spark, sf_dir)
    for day in _day_names(lake):
        run_day(lake, day, FraudConfig(), run_at())
    return lake


@query
def reports_over_tables(spark, sf_dir):
    """The reports as the job runs them, over written tables: each report's rows as JSON."""
    lake = curated_lake(spark, sf_dir)
    tables = (lake.read(t) for t in (lake.transactions, lake.alerts, lake.summary))
    made = [
        report.drop("alerted_at", "alert_id").select(F.lit(name).alias("report"), F.to_json(F.struct("*")).alias("body"))
        for name, report in reports.run_reports(*tables, as_of=REPORT_DAY).items()
    ]
    counted = reduce(DataFrame.unionByName, made).groupBy("report").agg(F.count(F.lit(1)).alias("row_count"))
    kpi = reports.kpi_day(lake.read(lake.transactions), REPORT_DAY).select(F.lit("kpi_day").alias("report"), "fraud_amount_INR")
    return taken_out(lake, counted.join(kpi, "report", "left"), "reports")


@query
def report_daily_summary(spark, sf_dir):
    return reports.daily_summary(summary(spark, sf_dir))


@query
def report_channel_rate(spark, sf_dir):
    return reports.channel_rate(summary(spark, sf_dir, reports.REPORT_DAYS), REPORT_DAY)


@query
def report_fraud_type(spark, sf_dir):
    return reports.fraud_type(alerts(spark, sf_dir))


@query
def report_hourly_heatmap(spark, sf_dir):
    return reports.hourly_heatmap(summary(spark, sf_dir, reports.REPORT_DAYS), REPORT_DAY)


@query
def report_top_accounts(spark, sf_dir):
    """The set of reasons as text, for comparison across engines."""
    top = reports.top_accounts(alerts(spark, sf_dir))
    return top.withColumn("fraud_types", F.array_join("fraud_types", ","))


@query
def report_top_accounts_basic(spark, sf_dir):
    return reports.top_accounts_basic(alerts(spark, sf_dir))


@query
def report_latest_alerts(spark, sf_dir):
    return reports.latest_alerts(alerts(spark, sf_dir)).drop("alerted_at")


@query
def report_kpi_day(spark, sf_dir):
    return reports.kpi_day(scored(spark, sf_dir, days=0), REPORT_DAY)


# ---- synthetic data -------------------------------------------------------------------------


def _event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.events(spark, sf_dir).select(F.col("event_id").alias("id"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.transactions(spark, sf_dir).withColumn("is_fraud", F.col("is_fraud_label"))


@query
def synth_seed(spark, sf_dir):
    """A seed row for each event."""
    return seed_rows(_event_ids(spark, sf_dir), SEED)


@query
def synth_fit(spark, sf_dir):
    """What the copula learns from the transactions, as rows."""
    model = fit(_labelled(spark, sf_dir))
    rows = [("quantile", c, str(i / STEPS), float(v)) for c in NUMERIC for i, v in enumerate(model.quantiles[c])]
    rows += [("null_share", c, "", float(model.null_share[c])) for c in NUMERIC]
    rows += [("share", c, value, share) for c in CATEGORICAL for value, share in model.categories[c]]
    names = NUMERIC + CATEGORICAL
    rows += [
        ("correlation", names[i], names[j], float(model.correlation[i, j]))
        for i in range(len(names))
        for j in range(i)
    ]
    return spark.createDataFrame(rows, "kind STRING, column_name STRING, at STRING, value DOUBLE")


@query
def synth_category_shares(spark, sf_dir):
    """The part of the fit that is exact: shares of categories and of missing numbers."""
    model = fit(_labelled(spark, sf_dir))
    rows = [(c, value, share) for c in CATEGORICAL for value, share in model.categories[c]]
    rows += [(c, "NULL", model.null_share[c]) for c in ("amount", "location_lat")]
    return spark.createDataFrame(rows, "column_name STRING, value STRING, share DOUBLE").withColumn(
        "share", F.round("share", 10)
    )


@query
def synth_sample(spark, sf_dir):
    """As many events as there are, sampled from a copula of the transactions, with patterns."""
    model = fit(_labelled(spark, sf_dir))
    return inject_patterns(sample(_event_ids(spark, sf_dir), model, SEED))


@query
def synth_sample_from_model(spark, sf_dir):
    """As many events as there are, sampled from a saved model."""
    path = scratch_dir(spark, "model")
    save_model(spark, STATED_MODEL, path)
    return sample_stored(_event_ids(spark, sf_dir), load_model(spark, path), SEED)


@query
def synth_copula_checks(spark, sf_dir):
    """What must hold of a fit and of a sample, each with the number of violations in the data."""
    rows = _labelled(spark, sf_dir).withColumn("is_fraud", F.col("is_fraud").cast("string"))
    model = fit(_labelled(spark, sf_dir))
    amounts = rows.filter("amount IS NOT NULL")
    known = amounts.count()
    levels = [(i / STEPS, float(v)) for i, v in enumerate(model.quantiles["amount"])]
    asked = spark.createDataFrame(levels, "level DOUBLE, at DOUBLE")
    counted = cumulated(amounts.groupBy("amount").count(), ["amount"], "count", "_upto")
    ranks = counted.select(  # a bounded number of levels against the amounts' ranks
        "amount", (F.col("_upto") / known).alias("upto"), ((F.col("_upto") - F.col("count")) / known).alias("below")
    )
    off = asked.join(ranks, F.col("at") == F.col("amount"), "left").filter(
        F.col("upto").isNull() | (F.col("upto") < F.col("level") - 0.02) | (F.col("below") > F.col("level") + 0.02)
    )
    total = rows.count()
    shares = [(c, v, s) for c in CATEGORICAL for v, s in model.categories[c]]
    learned = spark.createDataFrame(shares, "name STRING, value STRING, share DOUBLE")
    counts = reduce(
        DataFrame.unionByName,
        [rows.groupBy(F.col(c).alias("value")).count().select(F.lit(c).alias("name"), "value", "count") for c in CATEGORICAL],
    )
    same = (learned["name"] == counts["name"]) & learned["value"].eqNullSafe(counts["value"])
    differ = learned.join(counts, same, "full").filter(
        ~F.coalesce(F.abs(F.col("share") * total - F.col("count")) < 1e-6, F.lit(False))
    )
    nulls = rows.agg(F.count_if(F.col("amount").isNull()).alias("n")).filter(
        F.abs(F.col("n") - F.lit(model.null_share["amount"]) * total) > 1e-6
    )
    drawn = written(sample(_event_ids(spark, sf_dir), model, SEED), "drawn")  # read by three checks
    low, high = model.quantiles["amount"][0], model.quantiles["amount"][-1]
    wild = int((abs(model.correlation) > 1 + 1e-9).sum())
    missing = _event_ids(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).crossJoin(drawn.agg(F.count(F.lit(1)).alias("m")))
    count = F.count(F.lit(1)).alias("failures")
    found = {
        "quantile rank off by more than 0.02": off.agg(count),
        "share differs": differ.agg(count),
        "null share differs": nulls.agg(count),
        "correlation outside -1..1": spark.range(1).select(F.lit(wild).cast("long").alias("failures")),
        "sample rows missing": missing.select((F.col("n") - F.col("m")).alias("failures")),
        "sample ids repeated": drawn.groupBy("transaction_id").count().filter("count > 1").agg(count),
        "sample values outside the quantiles": drawn.filter(~F.col("amount").between(low - 0.01, high + 0.01)).agg(count),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check_name"), "failures") for name, df in found.items()])


@query
def inject_patterns_into_transactions(spark, sf_dir):
    """Random amounts of the burst are replaced by the middle of their range."""
    injected = inject_patterns(_labelled(spark, sf_dir).select(*EVENT.names))
    low, high = VELOCITY_AMOUNTS
    in_burst = (F.col("account_id") == VELOCITY_ACCOUNT) & F.col("amount").between(low, high)
    return injected.withColumn("amount", F.when(in_burst, (low + high) / 2).otherwise(F.col("amount")))


# the names the inventory uses for these three
QUERIES["score_transactions"] = QUERIES.pop("score_transactions_daily")
QUERIES["inject_patterns"] = QUERIES.pop("inject_patterns_into_transactions")
