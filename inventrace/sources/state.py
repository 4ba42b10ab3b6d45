"""Stored state and change history as Parquet tables.

A state version is what one run left. Its manifest names the folders it consists of: a whole copy of the table, and after it the changes of later
runs, each cut into the same buckets by key. Reading takes the latest row of each key. So a run writes what changed, not the table,
and the join of the next snapshot with the state needs no shuffle of the state. A version counts once its manifest is committed.
Versions of stores without manifests are folders ``v=<run id>`` that count once their ``_SUCCESS`` exists; they are taken over at the next run.

History and quarantine have one directory per service and run; re-running a run replaces its own, also with nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inventrace.operators.upsert import CONTROL
from inventrace.sources.landed import bytes_at
from inventrace.sources.manifest import UNRECORDED, Manifest, ManifestLog, RunExpired
from inventrace.sources.manifest import hadoop_path as _fs
from inventrace.specs.model import ResourceSpec

HISTORY_COLUMNS = (
    "service_type string, resource_id string, field_name string, old_value string, new_value string, "
    "changed_by string, account_id string, region string, run_id string"
)

QUARANTINE_COLUMNS = "service string, run_id string, dataset string, account_id string, content string, origin string"
LINEAGE_COLUMNS = "service string, run_id string, origin string, dataset string, account_id string, event_id string, content string"

#: Where version tables are registered while a run reads or writes them; other catalogs may not know buckets.
_CATALOG = "spark_catalog.default"
#: Change folders on a whole copy, and their bytes against its, from which the next run writes a whole copy again.
MOST_CHANGES, MOST_CHANGED = 8, 0.5


class StateStore:
    """State tables, history and audit events below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def log(self, table: str) -> ManifestLog:
        return ManifestLog(self.spark, f"{self.root}/manifests/{table}")

    def versions(self, table: str) -> list[str]:
        log = self.log(table)
        if log.exists():
            return log.runs(kept_only=True)
        target, fs = _fs(self.spark, f"{self.root}/state/{table}")
        if not fs.exists(target):
            return []
        found = [s.getPath() for s in fs.listStatus(target) if s.getPath().getName().startswith("v=")]
        jvm = self.spark.sparkContext._jvm
        done = [p for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(p.getName()[2:] for p in done)

    def version_path(self, table: str, version: str) -> str:
        return f"{self.root}/state/{table}/v={version}"

    def adopt(self, spec: ResourceSpec) -> None:
        """Manifests for a table that has none yet; versions of the earlier layout stay as they are."""
        log = self.log(spec.table)
        if log.exists():
            return
        earlier, parent = self.versions(spec.table), UNRECORDED
        log.start()
        for version in earlier:
            log.commit(Manifest(version, parent, (f"v={version}",), columns=spec.columns))
            parent = version

    def parent_of(self, spec: ResourceSpec, run_id: str) -> str | None:
        """The version that a run starts from: that of its first try, or for a new run the latest earlier one."""
        log, kept = self.log(spec.table), self.versions(spec.table)
        known = log.read(run_id)
        if known is not None:
            parent = known.parent
        else:
            parent = max((v for v in kept if v < run_id), default=None)
            if parent is None and kept and log.read(kept[0]).parent is not None:
                raise RunExpired(f"{spec.table}: no version before {run_id} is kept")
        if parent is not None and parent not in kept:
            raise RunExpired(f"{spec.table}: run {run_id} started from version {parent or 'of an unknown run'}, which is not kept")
        return parent

    def read(self, spec: ResourceSpec, before: str | None = None) -> DataFrame:
        """Latest committed state (of a run before ``before``)."""
        versions = [v for v in self.versions(spec.table) if before is None or v < before]
        return self.read_version(spec, versions[-1] if versions else None)

    def read_version(self, spec: ResourceSpec, version: str | None) -> DataFrame:
        """The rows of one version, key columns first; without one, no rows."""
        schema = f"{spec.columns}, last_updated timestamp_ntz"
        if version is None:
            return self.spark.createDataFrame([], schema)
        manifest = self.log(spec.table).read(version)
        if manifest is None or len(manifest.parts) == 1:
            path = self.version_path(spec.table, version) if manifest is None else f"{self.root}/state/{spec.table}/{manifest.parts[0]}"
            return self.spark.read.schema(schema).parquet(path)
        out = None
        for nth, part in enumerate(manifest.parts):
            rows = self.spark.read.schema(f"{schema}, _action string").parquet(f"{self.root}/state/{spec.table}/{part}").withColumn("_part", F.lit(nth))
            out = rows if out is None else out.unionByName(rows)
        return latest_rows(spec, out)

    @contextmanager
    def clustered(self, spec: ResourceSpec, manifest: Manifest) -> Iterator[DataFrame]:
        """The rows of a version as Spark reads a bucketed table: already dealt out by key, so joins on the key do not shuffle them.

        Inside, the version is a table of the session's catalog over its folders.
        """
        name = f"{_CATALOG}.inventrace_{uuid.uuid4().hex}"
        columns = self.spark.createDataFrame([], f"{spec.columns}, last_updated timestamp_ntz, _action string").schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        key = ", ".join(f"`{k}`" for k in spec.key)
        base = f"{self.root}/state/{spec.table}"
        parts = " ".join(f"PARTITION (_part={nth}) LOCATION '{_quoted(f'{base}/{part}')}'" for nth, part in enumerate(manifest.parts))
        self.spark.sql(
            f"CREATE TABLE {name} ({ddl}, _part int) USING parquet PARTITIONED BY (_part) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {manifest.buckets} BUCKETS LOCATION '{_quoted(base)}'"
        )
        try:
            self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
            rows = self.spark.table(name)
            # a whole copy alone has each key once
            yield latest_rows(spec, rows) if len(manifest.parts) > 1 else rows.select(*spec.column_names, "last_updated")
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # external: the folders stay

    def write(self, spec: ResourceSpec, compared: DataFrame, version: str) -> DataFrame:
        """Write a whole compared frame as a version without manifest and read it back: state, history and counters all come from it."""
        path = self.version_path(spec.table, version)
        compared.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(compared.schema).parquet(path)

    def write_part(self, spec: ResourceSpec, compared: DataFrame, run_id: str, buckets: int, whole: bool, deal: bool = False) -> tuple[str, DataFrame]:
        """(folder, its rows): what a run adds to the table, one file per bucket, or with ``whole`` all rows.

        Otherwise rows that only the state has are left out, and rows that were seen again unchanged are their key and last_updated.
        The compared frame is dealt out by key already; ``deal`` deals it to another number of buckets.
        """
        rows = compared
        if not whole:
            keep = F.col("_action") != "touch"
            slim = [F.col(c) if c in spec.key else F.when(keep, F.col(c)).alias(c) for c in spec.column_names]
            rows = compared.where(F.col("_action") != "carry").select(*slim, "last_updated", *CONTROL)
        if deal:
            rows = rows.repartition(buckets, *spec.key)
        part = f"v={run_id}~{uuid.uuid4().hex[:12]}"
        path, name = f"{self.root}/state/{spec.table}/{part}", f"{_CATALOG}.inventrace_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(buckets, *spec.key).sortBy(*spec.key).option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return part, self.spark.read.schema(_plain(rows.schema)).parquet(path)

    def part_bytes(self, spec: ResourceSpec, manifest: Manifest | None) -> list[int]:
        """Size of each folder of a version."""
        return [bytes_at(self.spark, f"{self.root}/state/{spec.table}/{p}") for p in manifest.parts] if manifest else []

    def expire(self, spec: ResourceSpec, keep: int = 2, protected: Iterable[str | None] = ()) -> list[str]:
        """Give up committed versions older than the newest ``keep``, but for the protected ones; returns which.

        Folders that no kept version needs are deleted, those of tries that were never committed among them.
        """
        log = self.log(spec.table)
        stay = set(protected)
        old = [v for v in self.versions(spec.table)[: -max(keep, 1)] if v not in stay]
        if not log.exists():
            for version in old:
                target, fs = _fs(self.spark, self.version_path(spec.table, version))
                fs.delete(target, True)
            return old
        for version in old:
            log.expire(version)
        needed = {p for v in self.versions(spec.table) for p in log.read(v).parts}
        target, fs = _fs(self.spark, f"{self.root}/state/{spec.table}")
        for status in fs.listStatus(target) if fs.exists(target) else []:
            if status.getPath().getName() not in needed:
                fs.delete(status.getPath(), True)
        return old

    def append_history(self, rows: DataFrame, service_type: str, run_id: str) -> None:
        """Replace the history of one resource kind and run. All rows are of that kind."""
        path = f"{self.root}/changes_history/service_type={service_type}/run_id={run_id}"
        rows.drop("service_type").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def quarantine(self, rows: DataFrame, service: str, run_id: str) -> DataFrame:
        """Replace the rejected rows (dataset, account_id, content, and origin if a replay rejects them) of one service and run; returns them as stored."""
        path = f"{self.root}/quarantine/service={service}/run_id={run_id}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def rejecting_runs(self, service: str) -> list[str]:
        """The runs and replays that have a quarantine folder of a service."""
        target, fs = _fs(self.spark, f"{self.root}/quarantine/service={service}")
        names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
        return sorted(n[len("run_id=") :] for n in names if n.startswith("run_id="))

    def write_lineage(self, rows: DataFrame, service: str, run_id: str) -> None:
        """Replace what one replay took in: origin, dataset, account_id, event_id, content."""
        path = f"{self.root}/replayed/service={service}/run_id={run_id}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def replayed(self) -> DataFrame:
        """All rows that replays took in, with their service, replay and the run that rejected them."""
        path = f"{self.root}/replayed"
        target, fs = _fs(self.spark, path)
        if not fs.exists(target):
            return self.spark.createDataFrame([], LINEAGE_COLUMNS)
        return self.spark.read.schema(LINEAGE_COLUMNS).parquet(path)

    def rejected(self) -> DataFrame:
        """All rejected rows with their service and run."""
        path = f"{self.root}/quarantine"
        target, fs = _fs(self.spark, path)
        if not fs.exists(target):
            return self.spark.createDataFrame([], QUARANTINE_COLUMNS)
        return self.spark.read.schema(QUARANTINE_COLUMNS).parquet(path)

    def history(self) -> DataFrame:
        path = f"{self.root}/changes_history"
        target, fs = _fs(self.spark, path)
        if not fs.exists(target):
            return self.spark.createDataFrame([], HISTORY_COLUMNS)
        return self.spark.read.schema(HISTORY_COLUMNS).parquet(path)

    def resource_history(self, service_type: str) -> DataFrame:
        """History of one resource kind; the filter prunes to its partitions."""
        return self.history().where(F.col("service_type") == service_type)


def latest_rows(spec: ResourceSpec, parts: DataFrame) -> DataFrame:
    """One row per key from a whole copy and later changes (column ``_part`` rises): its last full row, its last last_updated."""
    rest = [c for c in spec.column_names if c not in spec.key]
    full = F.when(F.col("_action") != "touch", F.col("_part"))
    rows = parts.groupBy(*spec.key).agg(F.max_by(F.struct(F.lit(0).alias("_"), *rest), full).alias("_row"), F.max("last_updated").alias("last_updated"))
    return rows.select(*[F.col(c) if c in spec.key else F.col(f"_row.{c}").alias(c) for c in spec.column_names], "last_updated")


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _plain(schema: StructType) -> str:
    """The schema without nullability, which files do not have."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_jdbc_state(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """State kept in a database, read in parallel ranges of ``column``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.options(
        partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    ).load()


def merge_statement(spec: ResourceSpec, target: str, source: str) -> str:
    """MERGE for catalogs with row-level updates; plain Parquet tables do not accept it."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in spec.key)
    columns = [*spec.column_names, "last_updated"]
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns if c not in spec.key)
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {source} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )
