"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stockpond.contracts import source_table
from stockpond.session import hadoop_path
from stockpond.sources.versions import current_version, locate, read_version

CORRUPT_COLUMN = "_corrupt_record"


def read_raw(
    spark: SparkSession,
    table: str,
    path: str,
    file_format: str = "csv",
    multi_line: bool = False,
    keep_corrupt: bool = False,
    match_pattern: bool = False,
    header: bool = True,
) -> DataFrame:
    """Raw files of a source table with its all-string contract.

    A CSV header that does not match the contract is an error instead of a
    silent swap of columns. ``multi_line`` allows line breaks inside quotes
    but stops Spark from splitting files. ``keep_corrupt`` adds the text of
    malformed records, and leaves the header unchecked because no header names
    that column; ``match_pattern`` reads only files named like the table.
    Without ``header`` the first line of a CSV file is a record like the others.
    """
    contract = source_table(table)
    schema = contract.schema
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", header).option("enforceSchema", False).option("escape", '"')
    if file_format in ("csv", "json") and multi_line:
        reader = reader.option("multiLine", True)
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        if file_format == "csv":  # the extra column is in no header
            reader = reader.option("enforceSchema", True)
    if match_pattern:
        reader = reader.option("pathGlobFilter", contract.file_pattern)
    return reader.schema(schema).load(path)


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = True,
) -> DataFrame:
    """CSV files with a given schema, with inferred types, or as plain text columns."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def read_layer(spark: SparkSession, path: str, ingestion_date: str | None = None, merge_schema: bool = False) -> DataFrame:
    """Table of a layer: the newest version, or plain Parquet files; with a date, only one ingestion partition.

    The folder of that partition is read by its name, so a table of many days
    is not listed. A day without a folder has no rows. An empty date means the
    whole table.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    if not ingestion_date:
        return reader.parquet(path) if current_version(spark, path) is None else read_version(spark, path)
    wanted = F.col("_ingestion_date") == F.lit(ingestion_date).cast("date")
    if current_version(spark, path) is not None:
        return read_version(spark, path).where(wanted)
    day = f"{path.rstrip('/')}/_ingestion_date={ingestion_date}"
    if not path_exists(spark, day):
        return reader.parquet(path).where(wanted)
    return reader.option("basePath", path).parquet(day).where(wanted)


def spread_rows(df: DataFrame, from_bytes: int = 2 << 20) -> DataFrame:
    """Share out rows of a scan that has fewer tasks than there are cores.

    A compressed text file or a Parquet file with one row group cannot be
    split, so all work up to the next shuffle would run in one task. Large
    scans have tasks enough and small ones are not worth it; both stay as they
    are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < from_bytes or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path; paths inside a versioned table mean its newest version."""
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath) or fs.exists(hadoop_path(spark, locate(spark, path))[0])


def is_empty_source(df: DataFrame) -> bool:
    """True when there is no row; stops at the first one found."""
    return df.isEmpty()
