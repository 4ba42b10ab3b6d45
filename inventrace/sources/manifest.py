"""What each run of a table did: its parent version, the files it read, the folders its version consists of, its counts.

One small JSON file per try, ``<folder>/<run id>.<try>.<kept|expired>.json``. A file appears by one rename, which fails if it is
there already, so a run is either committed whole or not at all, and two runs that commit the same try do not overwrite each other. The latest try of a run counts.
A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

KEPT, EXPIRED = "kept", "expired"
#: Parent of a version that an earlier layout left without a record.
UNRECORDED = ""


class RunExpired(ValueError):
    """A run cannot be repeated, or filled in, because the version it starts from is not kept any more."""


@dataclass(frozen=True)
class Manifest:
    """``parts`` are the folders of the version, oldest first; ``buckets`` into how many key buckets they are cut (None: not at all).

    ``inputs`` are landed files relative to the landing folder. ``events_as_of`` is up to which created_at the run could see
    audit events, ``latest_as_of`` the entry of the latest-event table. ``parent`` is the run whose version it started from: None for a first run.
    """

    run_id: str
    parent: str | None
    parts: tuple[str, ...] = ()
    buckets: int | None = None
    columns: str = ""
    inputs: tuple[str, ...] = ()
    counts: dict[str, int] = field(default_factory=dict)
    events_as_of: str | None = None
    latest_as_of: str | None = None
    tries: int = 0
    expired: bool = False


def hadoop_path(spark: SparkSession, path: str):
    """(Path, its FileSystem)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class ManifestLog:
    """The manifests of one table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def exists(self) -> bool:
        target, fs = hadoop_path(self.spark, self.folder)
        return fs.exists(target)

    def start(self) -> None:
        """From here on only manifests say which versions there are."""
        target, fs = hadoop_path(self.spark, self.folder)
        fs.mkdirs(target)

    def _latest(self) -> dict[str, tuple[int, str]]:
        """(try, status) of each run, from the file names alone."""
        target, fs = hadoop_path(self.spark, self.folder)
        if not fs.exists(target):
            return {}
        found: dict[str, tuple[int, str]] = {}
        for status in fs.listStatus(target):
            name = status.getPath().getName()
            if name.endswith(".json") and not name.startswith("."):
                run_id, nth, kind, _ = name.rsplit(".", 3)
                found[run_id] = max(found.get(run_id, (-1, "")), (int(nth), kind))
        return found

    def runs(self, kept_only: bool = False) -> list[str]:
        return sorted(r for r, (_, kind) in self._latest().items() if not kept_only or kind == KEPT)

    def read(self, run_id: str) -> Manifest | None:
        """The latest try of a run, expired or not."""
        latest = self._latest().get(run_id)
        if latest is None:
            return None
        target, fs = hadoop_path(self.spark, f"{self.folder}/{run_id}.{latest[0]:06d}.{latest[1]}.json")
        stream = fs.open(target)
        try:
            data = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(**{k: tuple(v) if isinstance(v, list) else v for k, v in data.items()})

    def commit(self, manifest: Manifest) -> Manifest:
        """Make a try of a run the one that counts."""
        nth = self._latest().get(manifest.run_id, (-1, ""))[0] + 1
        done = replace(manifest, tries=nth)
        kind = EXPIRED if done.expired else KEPT
        final, fs = hadoop_path(self.spark, f"{self.folder}/{done.run_id}.{nth:06d}.{kind}.json")
        draft, _ = hadoop_path(self.spark, f"{self.folder}/.{done.run_id}.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(asdict(done)).encode()))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"another writer committed run {done.run_id} at the same time")
        return done

    def expire(self, run_id: str) -> None:
        """Note that the folders of a run's version may be gone; what it read and counted stays known."""
        old = self.read(run_id)
        if old is not None and not old.expired:
            self.commit(replace(old, parts=(), expired=True))
