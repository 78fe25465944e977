"""Tables that are replaced as a whole or bucket by bucket, without a moment in which they are missing.

A table folder holds one folder per write and, in ``_versions``, one small
manifest per version that names the folders the version consists of. A write
goes to a folder of its own; a version begins with the rename of its manifest,
and readers take the newest manifest. So a failed write leaves the table as it
was, readers keep the version they planned with, and a table may be rewritten
from itself. Old versions stay until ``remove_old_versions``.

Bucketed tables deal their rows by a hash of the key over a fixed number of
buckets, a folder each. A merge rewrites the buckets that new rows fall into;
the manifest carries the others over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockpond.session import hadoop_path, stage
from stockpond.sources.sinks import WriteReport, write_table

MANIFESTS = "_versions"
BUCKET = "_bucket"
_WHOLE = "all"


class ConcurrentWriteError(RuntimeError):
    """Another writer committed the version this one wanted to commit."""


@dataclass(frozen=True)
class Version:
    """A state of a table: its folders by bucket (or one folder), and the schema of its rows."""

    number: int
    folders: Mapping[str, str]
    schema: StructType
    buckets: int = 0
    key: str = ""

    def paths(self, root: str, only: Sequence[str] | None = None) -> list[str]:
        names = self.folders if only is None else [b for b in only if b in self.folders]
        return [f"{root}/{self.folders[b]}" for b in names]


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, fs = hadoop_path(spark, f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def _load(spark: SparkSession, root: str, number: int) -> Version:
    path, fs = hadoop_path(spark, f"{root}/{MANIFESTS}/{number:012d}.json")
    stream = fs.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, found["folders"], StructType.fromJson(found["schema"]), found["buckets"], found["key"])


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest version, or None where the folder is no table of this kind."""
    root = path.rstrip("/")
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else None


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version, or an older one that has not been removed."""
    root = path.rstrip("/")
    version = current_version(spark, root) if number is None else _load(spark, root, number)
    if version is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    return _rows(spark, root, version)


def _rows(spark: SparkSession, root: str, version: Version, only: Sequence[str] | None = None) -> DataFrame:
    paths = version.paths(root, only)
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def _commit(spark: SparkSession, root: str, before: Version | None, version: Version) -> None:
    """One rename that fails if the manifest is already there."""
    folder, fs = hadoop_path(spark, f"{root}/{MANIFESTS}")
    fs.mkdirs(folder)
    text = json.dumps({"folders": dict(version.folders), "schema": version.schema.jsonValue(),
                       "buckets": version.buckets, "key": version.key})
    draft, _ = hadoop_path(spark, f"{root}/{MANIFESTS}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target, _ = hadoop_path(spark, f"{root}/{MANIFESTS}/{version.number:012d}.json")
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    no_options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        if _numbers(spark, root)[-1:] != ([before.number] if before else []):
            raise ConcurrentWriteError(f"{root} has a newer version than the one this write began with")
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(target), no_options)
        except Exception as error:
            if fs.exists(target):
                raise ConcurrentWriteError(f"version {version.number} of {root} was written by another writer") from error
            raise
    finally:
        fs.delete(draft, False)


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = True,
    metrics: Mapping[str, Column] | None = None,
) -> WriteReport:
    """Make ``df`` the next version of the table; ``df`` may read the version before."""
    spark, root = df.sparkSession, path.rstrip("/")
    before = current_version(spark, root)
    folder = f"write-{uuid.uuid4().hex}"
    written = write_table(df, f"{root}/{folder}", partition_by=partition_by, gather=gather, metrics=metrics)
    number = before.number + 1 if before else 1
    _commit(spark, root, before, Version(number, {_WHOLE: folder}, df.schema))
    return WriteReport(f"{root}/{folder}", written.rows, written.metrics)


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key; null keys have one, too."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, root: str, key: str, buckets: int, gather: bool) -> tuple[WriteReport, dict[str, str]]:
    folder = f"write-{uuid.uuid4().hex}"
    written = write_table(df.withColumn(BUCKET, bucket_of(key, buckets)), f"{root}/{folder}", partition_by=[BUCKET], gather=gather)
    path, fs = hadoop_path(df.sparkSession, f"{root}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return written, {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}


def replace_buckets(df: DataFrame, path: str, key: str, buckets: int, gather: bool = True) -> WriteReport:
    """Make ``df`` the next version of a table in ``buckets`` buckets of ``key``.

    ``gather=False`` leaves out the shuffle that brings a bucket together, for
    rows that come out of a shuffle: each task then writes a file per bucket.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    before = current_version(spark, root)
    written, folders = _write_buckets(df, root, key, buckets, gather)
    number = before.number + 1 if before else 1
    _commit(spark, root, before, Version(number, folders, df.schema, buckets, key))
    return written


def merge_buckets(
    path: str, arrivals: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], gather: bool = True
) -> WriteReport:
    """Merge rows into a bucketed table: ``merge(existing rows of their buckets, arrivals)`` replaces these buckets.

    ``merge`` must keep rows in the bucket of their key, as it does if it
    decides key by key. The report counts the rows of the rewritten buckets;
    ``gather`` is as in ``replace_buckets``.
    """
    spark, root = arrivals.sparkSession, path.rstrip("/")
    before = current_version(spark, root)
    if before is None or not before.buckets:
        raise ValueError(f"{path} is no bucketed table")
    arrivals = stage(arrivals, "arrivals")  # read for its buckets, and again for its rows
    touched = [str(r[0]) for r in arrivals.select(bucket_of(before.key, before.buckets)).distinct().collect()]
    merged = merge(_rows(spark, root, before, touched), arrivals)
    written, folders = _write_buckets(merged, root, before.key, before.buckets, gather)
    if not set(folders) <= set(touched):
        raise ValueError("the merge moved rows to other buckets")
    kept = {b: f for b, f in before.folders.items() if b not in touched}
    _commit(spark, root, before, Version(before.number + 1, {**kept, **folders}, merged.schema, before.buckets, before.key))
    return written


def locate(spark: SparkSession, path: str) -> str:
    """Where a path below a table's folder lies in the table's newest version; other paths stay as they are."""
    parts = path.rstrip("/").split("/")
    for cut in range(len(parts) - 1, max(0, len(parts) - 4), -1):
        root = "/".join(parts[:cut])
        version = current_version(spark, root) if root else None
        if version and not version.buckets:
            return "/".join([root, version.folders[_WHOLE], *parts[cut:]])
    return path


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions and what failed writes left; returns how many folders went.

    To be run while nobody writes: a folder that is being written belongs to no
    version yet. Readers of removed versions fail.
    """
    if keep < 1:
        raise ValueError("the newest version has to stay")
    root = path.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return 0
    used = {f for n in numbers[-keep:] for f in _load(spark, root, n).folders.values()}
    folder, fs = hadoop_path(spark, root)
    for number in numbers[:-keep]:
        fs.delete(hadoop_path(spark, f"{root}/{MANIFESTS}/{number:012d}.json")[0], False)
    removed = 0
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith("write-"):
            continue
        if not any(f == name or f.startswith(f"{name}/") for f in used):
            fs.delete(status.getPath(), True)
            removed += 1
            continue
        if name in used:
            continue
        for part in fs.listStatus(status.getPath()):  # buckets that later writes replaced
            if part.isDirectory() and f"{name}/{part.getPath().getName()}" not in used:
                fs.delete(part.getPath(), True)
                removed += 1
    return removed
