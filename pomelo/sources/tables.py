"""Table scans: day partition, full/projected, latest partition, snapshots.

All readers return lazy DataFrames; the ``stat_date`` predicates land in
``PartitionFilters`` on partitioned tables (or ``PushedFilters`` on plain
parquet), and the latest-partition lookup is a scalar subquery, so nothing
but one number ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.functions.dates import partition_value

PARTITION_COL = "stat_date"


def day_partition(df: DataFrame, date: str, col: str = PARTITION_COL) -> DataFrame:
    """``select * from T where stat_date = D`` (partition pruned)."""
    return df.where(F.col(col) == F.lit(date))


def latest_partition_value(df: DataFrame, col: str = PARTITION_COL) -> Column:
    """The newest partition value as a scalar subquery (int)."""
    return df.select(F.max(F.col(col).cast("int"))).scalar()


def latest_partition_value_from_catalog(spark: SparkSession, table: str) -> Column:
    """S3 / P22 for a partitioned catalog table: ``SHOW PARTITIONS`` text
    ``stat_date=20171105`` -> int -> max, still a scalar subquery."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    return parts.select(F.max(partition_value(parts.columns[0]))).scalar()


def latest_partition(df: DataFrame, col: str = PARTITION_COL,
                     latest: Column | None = None) -> DataFrame:
    """Rows of the newest partition only."""
    latest = latest if latest is not None else latest_partition_value(df, col)
    return df.where(F.col(col).cast("int") == latest)


def distinct_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct (key, value) rows; a null value is a value like any other.

    The rows are hashed by both columns, so copies and hot keys spread, and a
    following join on ``key`` has an exchange of its own on both sides, which
    AQE can split where a key is hot."""
    return df.select(key, value).distinct()


def snapshot_pair(df: DataFrame, key: str, value: str, new_date: str, old_date: str,
                  col: str = PARTITION_COL) -> tuple[DataFrame, DataFrame]:
    """Two fixed snapshots with per-snapshot renames of ``value``.

    Each side is reduced to distinct (key, value) rows, so copies of a row
    cannot multiply in a join of the two snapshots."""
    a = distinct_per_key(day_partition(df, new_date, col).select(key, F.col(value).alias(f"{value}_new")),
                         key, f"{value}_new")
    b = distinct_per_key(day_partition(df, old_date, col).select(key, F.col(value).alias(f"{value}_old")),
                         key, f"{value}_old")
    return a, b


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small in-memory list as a DataFrame (parameter lists only)."""
    return spark.createDataFrame(rows, schema)
