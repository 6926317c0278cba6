"""Catalog table writers (K1-K6; K9 is in ``publish``) and the delimited text format.

Writes go through ``INSERT OVERWRITE ... PARTITION (stat_date = 'D')`` /
``INSERT OVERWRITE`` / ``INSERT INTO`` on datasource tables, so

* a day overwrite replaces that day only and leaves other days alone (K4);
* rerunning a day is idempotent;
* file output is committed per task by Spark's output committer, so a lost
  executor's half-written files never become visible.

Table locations are explicit (``LOCATION``); on a cluster they must be in
shared storage, e.g. under ``session.scratch_path``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PARTITION_COL = "stat_date"
HIVE_SEP = "\u0001"


@contextmanager
def _view(df: DataFrame) -> Iterator[str]:
    """A temporary view of ``df`` for one statement."""
    name = f"pomelo_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def _q(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def _ensure_location(spark: SparkSession, location: str) -> None:
    """Create the table folder (on whatever file system it names) so that
    ``CREATE TABLE ... LOCATION`` finds it; best effort."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(conf).mkdirs(path)
    except Exception:  # noqa: BLE001 - remote sessions: let CREATE TABLE handle it
        pass


def create_partitioned_table(spark: SparkSession, name: str, columns_ddl: str, location: str,
                             fmt: str = "parquet", partition_col: str = PARTITION_COL,
                             bucket_by: str | None = None, buckets: int = 0) -> None:
    """K1: ``CREATE TABLE IF NOT EXISTS ... PARTITIONED BY (stat_date)``.

    ``bucket_by``/``buckets`` add ``CLUSTERED BY (col) INTO n BUCKETS``: a
    later join or aggregation on that column reads the table already
    hash-partitioned and does not shuffle it again."""
    _ensure_location(spark, location)
    clustered = f" CLUSTERED BY ({bucket_by}) INTO {buckets} BUCKETS" if bucket_by and buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}, {partition_col} STRING) "
              f"USING {fmt} PARTITIONED BY ({partition_col}){clustered} LOCATION '{_q(location)}'")


def create_table(spark: SparkSession, name: str, columns_ddl: str, location: str,
                 fmt: str = "parquet", partitioned_by: tuple[str, ...] = ()) -> None:
    """K2: ``CREATE TABLE IF NOT EXISTS``, unpartitioned unless columns of it are named."""
    _ensure_location(spark, location)
    by = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {fmt}{by} LOCATION '{_q(location)}'")


def create_text_table(spark: SparkSession, name: str, columns_ddl: str, location: str,
                      null_format: str = "", sep: str = HIVE_SEP,
                      partition_col: str | None = None) -> None:
    """Delimited text table whose NULL is written as ``null_format``.

    With ``null_format=''`` empty strings and NULLs both read back as NULL,
    as with a ``serialization.null.format=''`` table."""
    part = f", {partition_col} STRING" if partition_col else ""
    by = f" PARTITIONED BY ({partition_col})" if partition_col else ""
    _ensure_location(spark, location)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}{part}) USING csv "
              f"OPTIONS (sep '{_q(sep)}', nullValue '{_q(null_format)}', emptyValue '{_q(null_format)}', "
              f"quote '', escape '') {by} LOCATION '{_q(location)}'")


def overwrite_partition(spark: SparkSession, df: DataFrame, name: str, date: str,
                        partition_col: str = PARTITION_COL, bucket_by: str | None = None, buckets: int = 0,
                        run: dict[str, str] | None = None) -> None:
    """K4: replace one day partition with ``df``, columns matched by name.

    ``run`` names further partition columns and their values.  For a bucketed table the rows are dealt out by bucket first, so that each
    bucket is one file whatever the number of tasks before."""
    if bucket_by and buckets:
        df = df.repartition(buckets, bucket_by)
    parts = {partition_col: date, **(run or {})}
    with _view(df.drop(*parts)) as view:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({', '.join(f"{c} = '{_q(v)}'" for c, v in parts.items())}) BY NAME "
                  f"SELECT * FROM {view}")


def overwrite_table(spark: SparkSession, df: DataFrame, name: str) -> None:
    """K5: replace the whole table (the "latest" table), columns matched by name."""
    with _view(df) as view:
        spark.sql(f"INSERT OVERWRITE TABLE {name} BY NAME SELECT * FROM {view}")


def append_day(spark: SparkSession, df: DataFrame, name: str, date: str, partition_col: str = PARTITION_COL) -> None:
    """K6, keyed by run date: add a run's rows to a table partitioned by run date.

    A new day is added and the other days stay, as with ``append``; a rerun
    of a day puts its rows in place of the earlier run's instead of beside
    them, in one commit."""
    overwrite_partition(spark, df, name, date, partition_col)


def append(spark: SparkSession, df: DataFrame, name: str) -> None:
    """K6: ``INSERT INTO``, columns matched by name."""
    with _view(df) as view:
        spark.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {view}")


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = HIVE_SEP,
                   null_format: str = "\\N") -> DataFrame:
    """Read a delimited text table directly from files (Hive default
    separator U+0001 and null marker ``\\N``)."""
    return (spark.read.schema(schema).option("sep", sep).option("nullValue", null_format)
            .option("quote", "").option("escape", "").csv(path))
