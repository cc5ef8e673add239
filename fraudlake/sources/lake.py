"""The raw and curated tables in the session catalog."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.schemas import CURATED_TRANSACTIONS, FRAUD_ALERTS, FRAUD_SUMMARY, QUARANTINE, RAW_TRANSACTIONS, Field, Table
from fraudlake.session import delete_path, path_exists, scratch_dir

# Which run of the ingest stream wrote a row: "<stream>-<number>". As the first partition column
# it makes the append of a batch an overwrite of all that this batch ever wrote, hence repeatable.
INGEST_BATCH = Field("ingest_batch", "STRING", "stream and micro-batch that wrote the row")
FOLDED = "folded-"

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    location: str
    raw_db: str = "raw"
    curated_db: str = "curated"

    def tables(self) -> dict[str, Table]:
        raw = RAW_TRANSACTIONS._replace(
            fields=(*RAW_TRANSACTIONS.fields, INGEST_BATCH), partitions=(INGEST_BATCH.name, "dt")
        )
        quarantine = QUARANTINE._replace(fields=(*QUARANTINE.fields, INGEST_BATCH), partitions=(INGEST_BATCH.name,))
        return {
            f"{self.raw_db}.transactions": raw,
            f"{self.raw_db}.quarantine": quarantine,
            f"{self.curated_db}.transactions": CURATED_TRANSACTIONS,
            f"{self.curated_db}.fraud_alerts": FRAUD_ALERTS,
            f"{self.curated_db}.fraud_summary": FRAUD_SUMMARY,
        }

    @property
    def raw(self) -> str:
        return f"{self.raw_db}.transactions"

    @property
    def quarantine(self) -> str:
        return f"{self.raw_db}.quarantine"

    @property
    def transactions(self) -> str:
        return f"{self.curated_db}.transactions"

    @property
    def alerts(self) -> str:
        return f"{self.curated_db}.fraud_alerts"

    @property
    def summary(self) -> str:
        return f"{self.curated_db}.fraud_summary"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(table)

    def create(self) -> None:
        """Databases and tables, if missing. Files left by another catalog become an external
        table with the partitions found there; otherwise tables are managed."""
        for db, comment in ((self.raw_db, "events as received"), (self.curated_db, "scored and aggregated")):
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {db} COMMENT '{comment}' LOCATION '{self.location}/{db}'"
            )
        for name, table in self.tables().items():
            if self.spark.catalog.tableExists(name):
                continue
            path = f"{self.location}/{name.replace('.', '/')}"
            existing = path_exists(self.spark, path)
            self.spark.sql(
                f"CREATE TABLE {name} ({table.ddl}) USING parquet "
                f"PARTITIONED BY ({', '.join(table.partitions)}) "
                + (f"LOCATION '{path}' " if existing else "")
                + "TBLPROPERTIES ('parquet.compression' = 'snappy')"
            )
            if existing:
                self.spark.catalog.recoverPartitions(name)

    def overwrite_day(self, name: str, day: DataFrame, dt: str) -> None:
        """Replace everything the table holds for ``dt`` by ``day``, even if that is empty."""
        self._overwrite(name, day, dt)

    def overwrite_batch(self, name: str, rows: DataFrame, label: str) -> None:
        """Replace everything the table holds of the ingest batch ``label``, under any day."""
        self._overwrite(name, rows, label)

    def _overwrite(self, name: str, rows: DataFrame, value: str) -> None:
        """Replace what the table holds where its first partition column is ``value``.

        That is a static partition, so partitions of an earlier run that the new rows do not
        touch go too. Columns are matched by name against the catalog; one that the rows lack is
        NULL, so a table may have got columns since.
        """
        spark = rows.sparkSession  # a stream has a session of its own
        found = spark.catalog.listColumns(name)
        static, *dynamic = self.tables()[name].partitions
        columns = [c for c in found if not c.isPartition] + [c for c in found if c.name in dynamic]
        given = {c.lower() for c in rows.columns}
        aligned = _static_overwrite(rows).select(
            *(F.col(c.name) if c.name.lower() in given else F.lit(None).cast(c.dataType).alias(c.name) for c in columns)
        )
        partition = ", ".join([f"{static} = '{value}'", *dynamic])
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({partition}) SELECT * FROM {{rows}}", rows=aligned)

    def evolve(self, name: str, rows: DataFrame) -> None:
        """Add to the table, at its end, the columns that only the rows have."""
        known = {c.lower() for c in self.spark.table(name).columns}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.lower() not in known]
        if new:
            self.add_columns(name, ", ".join(new))

    def fold_day(self, dt: str) -> int:
        """Put the rows that closed batches left under ``dt`` into one partition; how many there were.

        A batch is closed once its stream has a later one, since only the last one may be
        repeated. What is folded is noted down first: a broken run is taken up by the next one,
        which must come before anything reads the day.
        """
        self._finish_folds()
        batches = [batch for batch, day in self._raw_partitions() if day == dt]
        newest: dict[str, str] = {}
        for batch, _ in self._raw_partitions():
            stream, number = batch.rsplit("-", 1)
            newest[stream] = max(number, newest.get(stream, ""))
        closed = [b for b in batches if b.startswith(FOLDED) or b.rsplit("-", 1)[1] < newest[b.rsplit("-", 1)[0]]]
        if len(closed) < 2:
            return len(closed)
        target = FOLDED + hashlib.sha256(",".join([dt, *sorted(closed)]).encode()).hexdigest()[:16]
        noted = self.spark.createDataFrame([(target, b, dt) for b in closed], "target STRING, batch STRING, dt STRING")
        noted.coalesce(1).write.mode("overwrite").parquet(f"{self._folds}/{target}")
        rows = self.read(self.raw).filter((F.col("dt") == dt) & F.col(INGEST_BATCH.name).isin(closed))
        staged = scratch_dir(self.spark, "fold")  # a table cannot be read and overwritten at once
        rows.hint("rebalance").write.parquet(staged)
        self.overwrite_batch(self.raw, self.spark.read.schema(rows.schema).parquet(staged), target)
        delete_path(self.spark, staged)
        self._finish_folds()
        built = {b for b, day in self._built() if day == dt}
        if built.issuperset(closed):  # the same rows under another name
            self.note_built(dt, sorted(built.difference(closed) | {target}))
        return len(closed)

    def batches_of(self, dt: str) -> list[str]:
        """Ingest batches that have rows of the day."""
        return sorted(batch for batch, day in self._raw_partitions() if day == dt)

    def note_built(self, dt: str, batches: list[str]) -> None:
        """Note down which batches the curated tables hold of the day."""
        rows = self.spark.createDataFrame([(b,) for b in batches], "batch STRING")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self._builds}/dt={dt}")

    def changed_days(self) -> list[str]:
        """Days whose batches are not those the curated tables were built from: new days, and days with late rows."""
        return sorted({day for _, day in set(self._raw_partitions()) ^ self._built()})

    @property
    def _builds(self) -> str:
        return f"{self.location}/_built_{self.curated_db}"

    def _built(self) -> set[tuple[str, str]]:
        if not path_exists(self.spark, self._builds):
            return set()
        noted = self.spark.read.schema("batch STRING, dt STRING").parquet(self._builds)
        return {(r["batch"], r["dt"]) for r in noted.collect()}

    @property
    def _folds(self) -> str:
        return f"{self.location}/_folds_{self.raw_db}"

    def _raw_partitions(self) -> list[tuple[str, str]]:
        """Batch and day of each partition of the raw table, from the catalog."""
        specs = [r[0].split("/") for r in self.spark.sql(f"SHOW PARTITIONS {self.raw}").collect()]
        return [(batch.split("=", 1)[1], day.split("=", 1)[1]) for batch, day in specs]

    def _finish_folds(self) -> None:
        """Drop what has been folded; forget folds that were not written."""
        if not path_exists(self.spark, self._folds):
            return
        there = set(self._raw_partitions())
        noted = self.spark.read.option("recursiveFileLookup", True).parquet(self._folds).collect()
        gone = [(r["batch"], r["dt"]) for r in noted if (r["target"], r["dt"]) in there and (r["batch"], r["dt"]) in there]
        if gone:
            external = self.spark.catalog.getTable(self.raw).tableType == "EXTERNAL"
            specs = ", ".join(f"PARTITION ({INGEST_BATCH.name} = '{b}', dt = '{d}')" for b, d in gone)
            self.spark.sql(f"ALTER TABLE {self.raw} DROP IF EXISTS {specs}")
            for batch, day in gone if external else ():  # of these Spark leaves the files
                delete_path(self.spark, f"{self.location}/{self.raw.replace('.', '/')}/{INGEST_BATCH.name}={batch}/dt={day}")
        delete_path(self.spark, self._folds)

    def truncate(self, name: str) -> None:
        """Remove all rows. Spark refuses TRUNCATE on external tables, so these are overwritten
        by nothing."""
        if self.spark.catalog.getTable(name).tableType == "EXTERNAL":
            nothing = self.spark.createDataFrame([], self.spark.table(name).schema)
            _static_overwrite(nothing).write.insertInto(name, overwrite=True)
        else:
            self.spark.sql(f"TRUNCATE TABLE {name}")

    def drop(self) -> None:
        """Drop the tables and then the databases, which must be empty."""
        for name in self.tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for db in (self.raw_db, self.curated_db):
            self.spark.sql(f"DROP DATABASE IF EXISTS {db}")

    def listing(self) -> DataFrame:
        """Databases and their tables."""
        dbs = self.spark.sql("SHOW DATABASES").filter(F.col("namespace").isin(self.raw_db, self.curated_db))
        shown = [
            self.spark.sql(f"SHOW TABLES IN {db}").select("namespace", F.col("tableName").alias("table_name"))
            for db in (self.raw_db, self.curated_db)
        ]
        return dbs.join(shown[0].unionByName(shown[1]), "namespace", "left")

    def describe(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE FORMATTED {name}")

    def columns(self, name: str) -> DataFrame:
        """Name, type and partition role of each column as the catalog has them."""
        found = self.spark.catalog.listColumns(name)
        rows = [(name, i, c.name, c.dataType, c.isPartition) for i, c in enumerate(found)]
        return self.spark.createDataFrame(
            rows, "table_name STRING, position INT, column_name STRING, data_type STRING, is_partition BOOLEAN"
        )

    def readiness(self) -> DataFrame:
        """One row per check: databases and tables exist, specified columns are there."""
        catalog = self.spark.catalog
        checks = [(f"database {db}", catalog.databaseExists(db)) for db in (self.raw_db, self.curated_db)]
        for name, table in self.tables().items():
            exists = catalog.tableExists(name)
            checks.append((f"table {name}", exists))
            found = {c.name: c.dataType for c in catalog.listColumns(name)} if exists else {}
            wanted = {f.name: f.type.lower() for f in table.fields}
            checks.append((f"columns {name}", wanted.items() <= found.items()))
        return self.spark.createDataFrame(checks, "check STRING, passed BOOLEAN")

    def add_columns(self, name: str, columns: str) -> None:
        """Schema evolution of a table: new columns, NULL in old rows."""
        self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        self.spark.catalog.refreshTable(name)

    def health(self) -> DataFrame:
        """What the tables hold, one row for each check: name, value, and whether it is as it should be."""
        raw, alerts, summary = (self.read(t) for t in (self.raw, self.alerts, self.summary))
        scored = self.read(self.transactions)
        one = F.count(F.lit(1))
        checks = [
            ("raw rows", raw.agg(one.alias("value")), F.col("value") > 0),
            ("raw rows without an id", raw.filter("transaction_id IS NULL").agg(one.alias("value")), F.col("value") == 0),
            ("records set aside", self.read(self.quarantine).agg(one.alias("value")), F.lit(True)),
            (
                "scored days without a summary",
                scored.select("dt").distinct().join(summary, "dt", "left_anti").agg(one.alias("value")),
                F.col("value") == 0,
            ),
            (
                "alerts without a transaction",
                alerts.join(scored, ["dt", "transaction_id"], "left_anti").agg(one.alias("value")),
                F.col("value") == 0,
            ),
            (
                "transactions missing in the summary",
                scored.agg(one.alias("n")).crossJoin(summary.agg(F.coalesce(F.sum("total_txn"), F.lit(0)).alias("m"))).select(
                    (F.col("n") - F.col("m")).alias("value")
                ),  # one row each
                F.col("value") == 0,
            ),
        ]
        rows = [df.select(F.lit(name).alias("check_name"), "value", passed.alias("passed")) for name, df, passed in checks]
        return reduce(DataFrame.unionByName, rows)


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose columns grew over time, with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def append_by_name(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; a column that one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def _static_overwrite(day: DataFrame) -> DataFrame:
    mode = day.sparkSession.conf.get(OVERWRITE_MODE)
    if mode.lower() != "static":
        raise ValueError("a day is replaced in static partition overwrite mode")
    return day
