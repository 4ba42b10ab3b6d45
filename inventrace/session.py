"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture costs more than building the plan itself for wide projections.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(
    master: str | None = None, shuffle_partitions: int | None = None, app: str = "inventrace", scratch_dir: str | None = None
) -> SparkSession:
    """A session with the settings above. On a cluster only ``scratch_dir`` may be set, to a folder that all machines share."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if scratch_dir:
        builder = builder.config("spark.checkpoint.dir", scratch_dir)
    return builder.getOrCreate()


def scratch_base(spark: SparkSession) -> str | None:
    """The shared folder that the session names, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``.

    There is no default: on a cluster each machine would write to its own disk, and reads would miss rows.
    """
    base = scratch_base(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


PARTITION_BYTES = 128 * 1024 * 1024


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, exactly: int | None = None) -> Iterator[int]:
    """Inside, shuffles start with partitions of about 128 MB of input, or with ``exactly`` so many; yields their number.

    AQE merges partitions that turn out small but never adds any, so a fixed ``spark.sql.shuffle.partitions``
    would give a large table partitions that do not fit in memory. The session's own number is the minimum, and
    the session has its own setting back afterwards.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = exactly or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // PARTITION_BYTES))
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def fixed_rows(spark: SparkSession, rows: list[tuple[str, ...]], columns: str) -> DataFrame:
    """A small constant relation of strings, known to the optimizer without running a job."""

    def quoted(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")

