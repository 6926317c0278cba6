"""K9: staged publish of a run's three sinks, switched together by a manifest.

Spark's catalog tables have no transaction over several tables.  So a run
never writes where readers look.  Each sink is a table partitioned by run,
which only this module writes, and a view of the sink's own name, which
readers use; the view shows the run that the manifest names:

* ``predictions``: per day the day's current run (K4),
* ``latest``: the run published last (K5),
* ``metrics``: per day the day's current run's record (K4).

A publish stages the three sinks under a new run id, checks that the staged
copies agree, and then adds one row to the manifest.  That single append is
the switch: before it every reader of every sink sees the old run, after it
the new one.  A job that dies between the sinks leaves staged partitions that
no view shows; the next publish of the day drops them, with the runs that it
replaced before (the run now shown stays until the next publish, for readers
that are under way).  There is one publisher of a day at a time.

The views read only the partitions of the runs they show: ``latest`` by a
scalar subquery, the others by a join with the manifest, one row per day,
which prunes partitions at run time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.session import delete_folder
from pomelo.sinks import tables as SK

DAY, RUN = SK.PARTITION_COL, "run_id"


@dataclass(frozen=True)
class Published:
    """The sinks of one kind of run: view names, and the shared folder their tables are in."""

    root: str
    predictions: str
    latest: str
    metrics: str

    @property
    def manifest(self) -> str:
        return f"{self.latest}_manifest"

    def runs(self, view: str) -> str:
        """The table behind a view, partitioned by day and run."""
        return f"{view}_runs"

    def loc(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def create(spark: SparkSession, p: Published, prediction_columns: str, metric_columns: str) -> None:
    """Tables, manifest and views, where they are not there yet."""
    SK.create_table(spark, p.manifest, f"{RUN} STRING, {DAY} STRING, seq BIGINT", p.loc(p.manifest))
    for view, columns in ((p.predictions, prediction_columns), (p.latest, prediction_columns), (p.metrics, metric_columns)):
        table = p.runs(view)
        SK.create_table(spark, table, f"{columns}, {DAY} STRING, {RUN} STRING", p.loc(table), partitioned_by=(DAY, RUN))
        shown = ", ".join(c.name for c in spark.catalog.listColumns(table) if c.name not in (DAY, RUN))
        if view == p.latest:
            spark.sql(f"CREATE VIEW IF NOT EXISTS {view} AS SELECT {shown} FROM {table} "
                      f"WHERE {RUN} = (SELECT max_by({RUN}, seq) FROM {p.manifest})")
        else:
            spark.sql(f"CREATE VIEW IF NOT EXISTS {view} AS SELECT {shown}, {DAY} FROM {table} JOIN "
                      f"(SELECT {DAY}, max_by({RUN}, seq) AS {RUN} FROM {p.manifest} GROUP BY {DAY}) m USING ({DAY}, {RUN})")


def current_run(spark: SparkSession, p: Published, date: str) -> str | None:
    """The run that is shown for a day."""
    rows = spark.table(p.manifest).where(F.col(DAY) == date).agg(F.max_by(RUN, "seq").alias("r")).first()
    return rows.r


def stage(spark: SparkSession, df: DataFrame, p: Published, view: str, date: str, run: str) -> DataFrame:
    """Write one sink of a run where no view shows it; the rows written."""
    table = p.runs(view)
    SK.overwrite_partition(spark, df, table, date, run={RUN: run})
    return spark.table(table).where((F.col(DAY) == date) & (F.col(RUN) == run)).drop(DAY, RUN)


def switch(spark: SparkSession, p: Published, date: str, run: str) -> None:
    """Name the run in the manifest: one row, one commit."""
    last = spark.table(p.manifest).agg(F.max("seq").alias("s")).first().s
    row = spark.createDataFrame([(run, date, 1 + (last or 0))], f"{RUN} string, {DAY} string, seq long").coalesce(1)
    SK.append(spark, row, p.manifest)


def sweep(spark: SparkSession, p: Published, date: str) -> list[str]:
    """Drop the staged and replaced runs of a day, files included; the runs dropped."""
    shown, dropped = current_run(spark, p, date), set()
    for view in (p.predictions, p.latest, p.metrics):
        table = p.runs(view)
        parts = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({DAY} = '{date}')").collect()     # one row a run
        for run in {r.partition.rsplit(f"{RUN}=", 1)[1] for r in parts} - {shown}:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY} = '{date}', {RUN} = '{run}')")
            delete_folder(spark, f"{p.loc(table)}/{DAY}={date}/{RUN}={run}")
            dropped.add(run)
    return sorted(dropped)


def publish(spark: SparkSession, merged: DataFrame, record: DataFrame, date: str, p: Published) -> str:
    """Stage the three sinks of a run, then switch; the run's id.

    ``merged`` is computed once, into the day's predictions; the latest table
    is filled from those, so both hold the same rows even if something
    upstream were recomputed."""
    sweep(spark, p, date)
    run = uuid.uuid4().hex
    day = stage(spark, merged, p, p.predictions, date, run)
    latest = stage(spark, day, p, p.latest, date, run)
    stage(spark, record, p, p.metrics, date, run)
    if day.count() != latest.count():
        raise RuntimeError(f"staged sinks of run {run} differ")
    switch(spark, p, date, run)
    return run
