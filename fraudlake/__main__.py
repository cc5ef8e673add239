"""Jobs on the command line: ``python -m fraudlake <job> --help``."""

from __future__ import annotations

import argparse
import logging
import re
import sys
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.config import FraudConfig
from fraudlake.functions import parse_event_time
from fraudlake.functions.times import EVENT_TIME_FORMAT
from fraudlake.plans.day import run_changed_days, run_day
from fraudlake.plans.reports import run_reports
from fraudlake.session import build_session, scratch_dir
from fraudlake.sources import files, records
from fraudlake.sources.lake import Lake
from fraudlake.sources.records import RecordSource
from fraudlake.streaming.ingest import ingest, ingest_batch
from fraudlake.synth import fit, generate, load_model, save_model

log = logging.getLogger("fraudlake")

CONSOLE_ROWS = 1000
ROWS_PER_FILE = 1_000_000


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = spark or build_session(f"fraudlake-{args.job}")
    return args.run(spark, args)


def _bootstrap(spark: SparkSession, args) -> int:
    lake = _lake(spark, args)
    lake.listing().show(truncate=False)
    return 0


def _learn(spark: SparkSession, args) -> int:
    read = files.read_json if args.format == "json" else files.read_csv
    events = read(spark, args.input)
    model = fit(events.withColumn("event_timestamp", parse_event_time(F.col("timestamp"))))
    save_model(spark, model, args.model)
    log.info("learnt from %d events", model.rows)
    return 0


def _generate(spark: SparkSession, args) -> int:
    stored = load_model(spark, args.model) if args.model else None
    events = wire_events(generate(spark, args.rows, args.seed, stored=stored))
    (files.write_json if args.format == "json" else files.write_csv)(events, args.output)
    stored = files.read_json(spark, args.output) if args.format == "json" else files.read_csv(spark, args.output)
    total, fraud = stored.agg(F.count(F.lit(1)), F.count_if("is_fraud")).first()
    log.info("%d events written, %d labelled fraud (%.1f %%)", total, fraud, 100 * fraud / total)
    return 0


def _produce(spark: SparkSession, args) -> int:
    """Events of a CSV with all their columns, or generated ones."""
    events = files.read_csv(spark, args.input, more=True) if args.input else wire_events(generate(spark, args.rows, args.seed))
    payload = records.to_payload(events)
    target = _records(args)
    if not args.rate:
        target.write(_with_position(payload, target))
        return 0
    root = scratch_dir(spark, "produce")
    staged = records.stage(_with_position(payload, target), f"{root}/staged", args.rate)
    records.replay(spark, staged, target, f"{root}/checkpoint", max_per_trigger=1, every_seconds=1)
    return 0


def _ingest(spark: SparkSession, args) -> int:
    lake = _lake(spark, args)
    options = {"nan_to_null": args.nan_to_null, "allow_fraction": args.allow_fraction}
    if args.checkpoint:
        read = ingest(lake, _records(args), args.checkpoint, max_per_trigger=args.max_per_trigger, **options)
    else:
        read = ingest_batch(lake, _records(args), args.offsets, **options)
    log.info("%d records read", read)
    return 0


def _day(spark: SparkSession, args) -> int:
    dt = args.dt or str(spark.range(1).select(F.date_sub(F.current_date(), 1)).first()[0])
    date.fromisoformat(dt)
    cfg = FraudConfig(
        high_amount=args.high_amount,
        velocity_window_s=args.velocity_window,
        velocity_min_count=args.velocity_count,
        geo_distance_km=args.geo_distance,
        geo_window_s=args.geo_window,
        lookback=args.lookback,
        dedupe=args.dedupe,
        exempt_null_accounts=args.exempt_null_accounts,
    )
    if args.changed:
        log.info("days scored: %s", ", ".join(run_changed_days(_lake(spark, args), cfg)) or "none")
    else:
        run_day(_lake(spark, args), dt, cfg)
    return 0


def _report(spark: SparkSession, args) -> int:
    lake = _lake(spark, args)
    if args.file:
        for number, statement in enumerate(statements(Path(args.file).read_text()), 1):
            _put_out(spark.sql(statement), f"statement_{number}", args.output)
        return 0
    tables = (lake.read(t) for t in (lake.transactions, lake.alerts, lake.summary))
    for name, report in run_reports(*tables, as_of=args.as_of).items():
        if args.name in (None, name):
            _put_out(report, name, args.output)
    return 0


def statements(sql: str) -> list[str]:
    """The statements of a text; each but the last ends in a semicolon at the end of a line."""
    return [s for s in (part.strip() for part in re.split(r";[ \t]*(?:--[^\n]*)?(?:\n|$)", sql)) if re.sub(r"--[^\n]*", "", s).strip()]


def _put_out(report: DataFrame, name: str, output: str | None) -> None:
    """All rows to a folder of CSV below ``output``, in files of bounded size; or the first on the console."""
    if output:
        flat = [F.to_json(c).alias(c) if kind.startswith(("array", "map", "struct")) else F.col(c) for c, kind in report.dtypes]
        files.write_csv(report.select(*flat), f"{output}/{name}", ROWS_PER_FILE)
        return
    print(name)
    first = report.take(CONSOLE_ROWS + 1)
    spark = report.sparkSession
    spark.createDataFrame(first[:CONSOLE_ROWS], report.schema).show(max(1, CONSOLE_ROWS), truncate=False)
    if len(first) > CONSOLE_ROWS:
        print(f"{report.count() - CONSOLE_ROWS} more rows; --output writes all")


def _fold(spark: SparkSession, args) -> int:
    log.info("%d partitions folded", _lake(spark, args).fold_day(args.dt))
    return 0


def _check(spark: SparkSession, args) -> int:
    checks = Lake(spark, args.lake, args.raw_db, args.curated_db).readiness()
    checks.show(CONSOLE_ROWS, truncate=False)  # a few for each table
    return 0 if checks.filter(~F.col("passed")).isEmpty() else 1


def wire_events(events: DataFrame) -> DataFrame:
    """Generated events with their time as ISO text."""
    return events.withColumn("timestamp", F.date_format("event_timestamp", EVENT_TIME_FORMAT)).select(
        *files.WIRE_EVENT.names
    )


def _with_position(payload: DataFrame, target: RecordSource) -> DataFrame:
    """Files of records need a position, which a topic would assign itself."""
    if target.format == "kafka":
        return payload
    return payload.withColumns(
        {"partition": F.spark_partition_id(), "offset": F.monotonically_increasing_id()}
    )


def _lake(spark: SparkSession, args) -> Lake:
    lake = Lake(spark, args.lake, args.raw_db, args.curated_db)
    lake.create()
    return lake


def _records(args) -> RecordSource:
    if args.records:
        return RecordSource.files(args.records)
    if not (args.servers and args.topic):
        raise SystemExit("give --records, or --servers and --topic")
    return RecordSource.kafka(args.servers, args.topic, args.partitions, **dict(o.split("=", 1) for o in args.option))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fraudlake")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, run, summary: str, *groups) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=summary)
        for group in groups:
            group(sub)
        sub.set_defaults(run=run)
        return sub

    def lake(sub):
        sub.add_argument("--lake", required=True, help="folder of the tables")
        sub.add_argument("--raw-db", default="raw")
        sub.add_argument("--curated-db", default="curated")

    def record_store(sub):
        sub.add_argument("--records", help="folder with files of records")
        sub.add_argument("--servers", help="Kafka bootstrap servers")
        sub.add_argument("--topic")
        sub.add_argument("--partitions", type=int, help="partitions of the topic")
        sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="further Kafka option")

    job("bootstrap", _bootstrap, "create databases and tables", lake)
    sub = job("learn", _learn, "learn a model from events and save it")
    sub.add_argument("--input", required=True, help="folder or file of events")
    sub.add_argument("--format", choices=("csv", "json"), default="csv")
    sub.add_argument("--model", required=True, help="folder to save it in")

    sub = job("generate", _generate, "write synthetic events")
    sub.add_argument("--model", help="folder of a saved model, instead of one learnt from seed rows")
    sub.add_argument("--rows", type=int, default=10_000)
    sub.add_argument("--output", required=True)
    sub.add_argument("--format", choices=("csv", "json"), default="csv")
    sub.add_argument("--seed", type=int, default=42)

    sub = job("produce", _produce, "send events as records", record_store)
    given = sub.add_mutually_exclusive_group(required=True)
    given.add_argument("--input", help="CSV of events")
    given.add_argument("--rows", type=int, help="generate this many")
    sub.add_argument("--rate", type=int, default=100, help="records per second, 0 for no limit")
    sub.add_argument("--seed", type=int, default=42)

    sub = job("ingest", _ingest, "take in new records", lake, record_store)
    progress = sub.add_mutually_exclusive_group(required=True)
    progress.add_argument("--checkpoint", help="checkpoint folder; reads as a stream")
    progress.add_argument("--offsets", help="folder of saved offsets; reads as one batch")
    sub.add_argument("--max-per-trigger", type=int)
    sub.add_argument("--nan-to-null", action="store_true")
    sub.add_argument("--allow-fraction", action="store_true", help="accept fractions of a second")

    usual = FraudConfig()
    sub = job("day", _day, "score one day", lake)
    sub.add_argument("--dt", help="yyyy-MM-dd, default yesterday")
    sub.add_argument("--changed", action="store_true", help="all days that got rows since they were scored, instead of one")
    sub.add_argument("--high-amount", type=float, default=usual.high_amount)
    sub.add_argument("--velocity-window", type=int, default=usual.velocity_window_s)
    sub.add_argument("--velocity-count", type=int, default=usual.velocity_min_count)
    sub.add_argument("--geo-distance", type=float, default=usual.geo_distance_km)
    sub.add_argument("--geo-window", type=int, default=usual.geo_window_s)
    sub.add_argument("--lookback", action="store_true")
    sub.add_argument("--dedupe", action="store_true")
    sub.add_argument("--exempt-null-accounts", action="store_true")

    sub = job("report", _report, "print the reports", lake)
    sub.add_argument("--as-of", help="yyyy-MM-dd, default today")
    sub.add_argument("--name", help="one report only")
    sub.add_argument("--file", help="SQL statements of your own instead of the reports")
    sub.add_argument("--output", help="folder to write to as CSV, instead of the console")

    sub = job("fold", _fold, "put the closed ingest batches of a day into one partition", lake)
    sub.add_argument("--dt", required=True)

    job("check", _check, "check databases and tables", lake)
    return parser


if __name__ == "__main__":
    sys.exit(main())
