"""Catalog registration, so that layer tables can be queried by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from stockpond.sources.versions import BUCKET, current_version


def _name(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(
    spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = (), merge_schema: bool = False
) -> DataFrame:
    """Register Parquet files, or the newest version of a table, as an external table and return it.

    Partitions are discovered; the buckets of a bucketed table become
    partitions, each at the place of its folder. Later versions have to be
    registered again. A table of that name is defined anew, which
    takes up changed columns and leaves the files alone. ``merge_schema``
    unites the schemas of all files instead of taking that of one, at the cost
    of reading every file footer.
    """
    version, root = current_version(spark, path), path.rstrip("/")
    if version is None:
        schema = spark.read.option("mergeSchema", merge_schema).parquet(path).schema
    else:
        schema = version.schema
        path = root if version.buckets else version.paths(root)[0]
        if version.buckets:
            schema, partition_by = StructType([*schema.fields, StructField(BUCKET, IntegerType())]), [BUCKET]
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    partitioning = f"PARTITIONED BY ({', '.join(map(_name, partition_by))})" if partition_by else ""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "MANAGED":
        raise ValueError(f"{name} is a managed table; registering would delete its data")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioning} LOCATION {_text(path)}")
    if version is not None and version.buckets:
        places = " ".join(f"PARTITION ({_name(BUCKET)} = {int(bucket)}) LOCATION {_text(f'{root}/{folder}')}"
                          for bucket, folder in version.folders.items())
        if places:
            spark.sql(f"ALTER TABLE {name} ADD {places}")
    elif partition_by:
        refresh_partitions(spark, name)
    return spark.table(name)


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Pick up partitions written since the table was registered."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
