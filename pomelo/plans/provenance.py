"""Which job wrote which table on which run date.

Every job that writes a table notes it in a log table, one partition per run
date, job and table, so that a rerun replaces its own note.  A job that reads
what another one writes asks the log; where the note is missing it fails and
names the job to run, instead of quietly computing the input by another
definition.  ``derive_missing`` (command line: ``--derive-missing``) allows
that on purpose; the note of the reading job then says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.sinks import tables as SK

COLUMNS = "n_rows BIGINT, derived STRING, run_date STRING, job STRING, table_name STRING"
KEYS = ("run_date", "job", "table_name")


class MissingInput(RuntimeError):
    """A table that another job has to write first."""


def note(spark: SparkSession, log: str, location: str, date: str, job: str, table: str,
         rows: DataFrame, derived: tuple[str, ...] = ()) -> None:
    """Record that ``job`` wrote ``rows`` (read back) to ``table`` on ``date``; ``derived``: inputs it had to derive."""
    SK.create_table(spark, log, COLUMNS, location, partitioned_by=KEYS)
    line = rows.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(",".join(derived)).alias("derived"))
    SK.overwrite_partition(spark, line, log, date, "run_date", run={"job": job, "table_name": table})


def written(spark: SparkSession, log: str, date: str, job: str, table: str) -> bool:
    """Whether ``job`` has noted ``table`` for ``date``."""
    if not (spark.catalog.tableExists(log) and spark.catalog.tableExists(table)):
        return False
    return bool(spark.table(log).where((F.col("run_date") == date) & (F.col("job") == job)
                                       & (F.col("table_name") == table)).limit(1).count())


def require(spark: SparkSession, log: str, date: str, job: str, table: str, derive_missing: bool) -> bool:
    """Whether the written table is to be read; fails where it is missing and may not be derived."""
    if written(spark, log, date, job, table):
        return True
    if derive_missing:
        return False
    raise MissingInput(f"{table} has no rows of run date {date}: run job '{job}' first, or allow deriving it (--derive-missing)")
