"""Landed snapshot documents: one JSON line per page, with the account and region it came from.

Layout: ``<root>/<service>/<dataset>/dt=<date>/*.json``, each line
``{"account_id", "account_name", "region", "page", "doc": {...}}``; ``page`` numbers the pages of one answer and may be missing. The date partition prunes to one run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inventrace.specs.model import Raw, ResourceSpec

ENVELOPE = "account_id string, account_name string, region string, page int"


def read_dataset(spark: SparkSession, path: str, doc: str, run_date: str | None = None, files: Iterable[str] | None = None) -> DataFrame:
    """Pages of one dataset; lines that are not valid JSON become rows with a null ``doc``.

    ``files`` names the files to read (below ``path``); without it all of ``run_date``, or of every date, are read.
    """
    schema = f"{ENVELOPE}, doc struct<{doc}>, _corrupt string, dt string"
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt")
    if files is not None:
        names = [f"{path}/{f}" for f in files]
        return reader.option("basePath", path).json(names) if names else spark.createDataFrame([], schema)
    df = reader.json(path)
    return df.where(F.col("dt") == run_date) if run_date else df


def list_files(spark: SparkSession, path: str, dates: Iterable[str]) -> list[str]:
    """The landed files of some dates, relative to the dataset's folder, sorted. A landed file is never written again."""
    folders = [f"{path}/dt={d}" for d in dates]
    there = [f for f in folders if path_exists(spark, f)]
    if not there:
        return []
    found = [unquote(f) for f in spark.read.text(there).inputFiles()]
    return sorted(f[f.rindex("/dt=") + 1 :] for f in found)


def list_raw(spark: SparkSession, root: str, spec: ResourceSpec, run_date: str) -> list[str]:
    """The landed files of one run of a resource, relative to the landing folder."""
    out = []
    for name in spec.raw:
        folder = f"{root.rstrip('/')}/{spec.service}/{name}"
        if name not in spec.optional_raw and not path_exists(spark, folder):
            raise FileNotFoundError(f"no landed files at {folder}")
        out += [f"{spec.service}/{name}/{f}" for f in list_files(spark, folder, [run_date])]
    return out


def read_raw(spark: SparkSession, root: str, spec: ResourceSpec, run_date: str | None = None, files: Iterable[str] | None = None) -> Raw:
    """All datasets of a resource that are landed; optional ones may be missing. ``files`` are those of :func:`list_raw`."""
    raw = {}
    for name, doc in spec.raw.items():
        path = f"{root.rstrip('/')}/{spec.service}/{name}"
        own = None if files is None else [f.split("/", 2)[2] for f in files if f.startswith(f"{spec.service}/{name}/")]
        if name in spec.optional_raw and (not own if own is not None else not path_exists(spark, path)):
            continue
        raw[name] = read_dataset(spark, path, doc, run_date, own)
    return raw


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def bytes_at(spark: SparkSession, pattern: str) -> int:
    """Total size of the files below the paths that match a glob; 0 when there are none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target) or []
    return sum(fs.getContentSummary(status.getPath()).getLength() for status in found)


def parse_pages(df: DataFrame, doc: str, text: str = "doc") -> DataFrame:
    """Pages whose document is still JSON text, parsed with the dataset's schema."""
    return df.withColumn("doc", F.from_json(F.col(text), f"struct<{doc}>"))


def items(pages: DataFrame, path: str) -> DataFrame:
    """page -> list -> item: provenance columns and ``d``, one row per list element.

    A dotted path walks nested lists (``Reservations.Instances``); without a path the page is the item.
    """
    out = pages.select("account_id", "account_name", "region", F.col("doc").alias("d"))
    for step in path.split(".") if path else []:
        out = out.select("account_id", "account_name", "region", F.explode(F.col("d")[step]).alias("d"))
    return out


def by_key(
    pages: DataFrame, key: Column, name: str, lists: Mapping[str, Column] | None = None, first: Mapping[str, Column] | None = None
) -> DataFrame:
    """Details that may come in several pages, one row per account, region and key (as ``name``).

    ``lists`` are joined in page order, of ``first`` the first page that has a value counts. Without page numbers the
    order is that of the pages' content, so that reruns agree. A key's pages are as many as the service cut its answer into.
    """
    lists, first = lists or {}, first or {}
    page = F.col("page") if "page" in pages.columns else F.lit(None).cast("int")
    content = F.struct(page.alias("page"), F.to_json(F.struct("doc")).alias("text"), *[c.alias(n) for n, c in {**lists, **first}.items()])
    rows = pages.where(F.col("doc").isNotNull()).select("account_id", "region", key.alias(name), content.alias("_page"))
    grouped = rows.groupBy("account_id", "region", name).agg(F.collect_list("_page").alias("_pages"))
    ordered = F.array_sort("_pages", _earlier_page)
    joined = [F.flatten(_present(n)).alias(n) for n in lists]
    picked = [F.get(_present(n), F.lit(0)).alias(n) for n in first]
    return grouped.withColumn("_ordered", ordered).select("account_id", "region", name, *joined, *picked)


def _present(name: str) -> Column:
    """The values that the ordered pages have of one column."""
    return F.filter(F.transform("_ordered", lambda p: p[name]), lambda x: x.isNotNull())


def _earlier_page(a: Column, b: Column) -> Column:
    x, y = F.coalesce(a["page"], F.lit(0)), F.coalesce(b["page"], F.lit(0))
    less = (x < y) | ((x == y) & (a["text"] < b["text"]))
    more = (x > y) | ((x == y) & (a["text"] > b["text"]))
    return F.when(less, -1).when(more, 1).otherwise(0)


def corrupt_lines(pages: DataFrame) -> DataFrame:
    """(account_id, content) of landed lines that are no valid pages. ``pages`` comes from :func:`read_dataset`."""
    return pages.where(F.col("_corrupt").isNotNull()).select("account_id", F.col("_corrupt").alias("content"))


def split_invalid(df: DataFrame, required: str, corrupt: str | None = None, key: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows are malformed, lack their id or a part of their key, and go to quarantine."""
    bad: Column = F.col(required).isNull() | (F.col(required).cast("string") == "")
    for part in key:
        bad = bad | F.col(part).isNull()
    if corrupt:
        bad = bad | F.col(corrupt).isNotNull()
    return df.where(~bad), df.where(bad)
