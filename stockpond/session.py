"""Spark session defaults and the shared scratch folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}

_local_fallback: dict[str, str] = {}
_prepared: set[str] = set()
_scopes: list[list[str]] = []


def build_session(app_name: str = "stockpond", master: str | None = None, **extra: str) -> SparkSession:
    """Session with UTC, adaptive execution and dynamic partition overwrite.

    Shuffle partitions are left to the cluster and to adaptive coalescing;
    pass ``extra`` (dots written as double underscores) to override anything.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in {**DEFAULT_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_fallback.setdefault(context.applicationId, tempfile.mkdtemp(prefix="stockpond-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call uses, removed when the application ends."""
    root = f"{shared_folder(spark)}/stockpond-{spark.sparkContext.applicationId}"
    if root not in _prepared:
        path, fs = hadoop_path(spark, root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _prepared.add(root)
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the staged tables of a step as soon as the step is done.

    Only for steps whose results are written before the scope ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for staged in _scopes.pop():
            path, fs = hadoop_path(spark, staged)
            fs.delete(path, True)


def input_bytes(spark: SparkSession, tables: Sequence[DataFrame]) -> int:
    """Bytes of the files that the given scans read, after pruning; what has no known size counts as nothing."""
    unknown = spark._jsparkSession.sessionState().conf().defaultSizeInBytes()
    sizes = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables]
    return sum(size for size in sizes if size < unknown)


@contextmanager
def shuffle_sizing(
    spark: SparkSession, tables: Sequence[DataFrame], growth: int = 4, task_bytes: int = 128 << 20
) -> Iterator[int]:
    """Shuffle partitions to fit the stored tables that a step reads, for the jobs it starts; yields their number.

    Stored files grow about ``growth`` times when they are decoded, and a task
    should take ``task_bytes`` of that, so a step over 1 TB gets about 32,000
    partitions instead of a fixed number. The number set for the session is the
    least, and adaptive execution joins partitions that turn out small. Jobs that
    other threads of this session plan meanwhile get the same number.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    number = max(int(before), -(-input_bytes(spark, tables) * growth // task_bytes))
    spark.conf.set(name, number)
    try:
        yield number
    finally:
        spark.conf.set(name, before)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop ``Path`` and its ``FileSystem`` for a location on any storage."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of the jobs started here as each ends, not when the driver happens to collect garbage.

    For jobs whose result is written: a plan that is run again makes its shuffles anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    The result no longer depends on the plan that made it, so it stays the
    same however often it is read and whichever executors are lost, and its
    file sizes give the planner true statistics. The shuffles that made it are
    removed at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
