"""What the operators share: table reads, worker imports, shared checkpoints."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from pomelo.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Rows of an Arrow batch: texts reach 100 KB and more, so the default of
# 10,000 rows could take a gigabyte in one Python worker.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and keep Arrow batches small.

    On a cluster whose executors do not see the repository, ship it with
    ``--py-files``; a path that does not exist there is ignored.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep) if env.get("PYTHONPATH") else []
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
