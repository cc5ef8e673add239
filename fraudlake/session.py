"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# what a byte of compressed columns becomes as shuffled rows, roughly
ROW_EXPANSION = 4
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
UNKNOWN_BYTES = 2**60


def shuffle_partitions_for(input_bytes: int, cores: int = 1) -> int:
    """Enough shuffle partitions for ~128 MB each, one per core at least."""
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, from file sizes where df reads files; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def shuffle_sized_for(df: DataFrame) -> Iterator[None]:
    """Within the block, as many shuffle partitions as the input needs, if that is more than
    the session is set to. AQE merges what turns out small."""
    conf = df.sparkSession.conf
    usual = conf.get(SHUFFLE_PARTITIONS)
    size = estimated_bytes(df)
    if size < UNKNOWN_BYTES:
        conf.set(SHUFFLE_PARTITIONS, str(max(int(usual), shuffle_partitions_for(size * ROW_EXPANSION))))
    try:
        yield
    finally:
        conf.set(SHUFFLE_PARTITIONS, usual)


def build_session(
    app_name: str = "fraudlake",
    *,
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the jobs rely on.

    Event time is zone-less, so the session zone is fixed to UTC. AQE starts from many
    shuffle partitions and coalesces them to the advisory size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES))
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # call sites for error messages cost small queries more than they take to run
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config(
            SHUFFLE_PARTITIONS, str(shuffle_partitions_for(input_bytes * ROW_EXPANSION))
        ).config("spark.sql.files.maxPartitionBytes", str(TARGET_PARTITION_BYTES))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="fraudlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here, and lost executors lose none of it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
