"""Session helpers: builder defaults, bounded broadcast, shared scratch space."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

# A side is broadcast only when its size, rows times estimated row width, stays below this.
MAX_BROADCAST_BYTES = 256 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pomelo", extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join) on and the UI off."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")   # files go when nothing refers to them
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("POMELO_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a run on this one
    machine may do without: it gets a private folder.  On a cluster an unset
    folder is an error, since a machine's own folder is not shared."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="pomelo-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/pomelo-tables/{name}-{uuid.uuid4().hex[:12]}"


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder of the run's own, on whatever file system it is; whether it was there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def row_width(schema: StructType) -> int:
    """Bytes of a row, estimated: strings and arrays at 64."""
    return 16 + sum(64 if isinstance(f.dataType, (StringType, ArrayType, StructType)) else 8 for f in schema.fields)


def bounded_broadcast(df: DataFrame, row_bound: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if its size is known to be small enough.

    ``row_bound`` is for frames whose plan has that limit (a top-K, one row
    per range).  Without it the rows are counted, no further than the limit
    allows.  Beyond the limit the join is left to the planner and AQE."""
    most = (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes) // row_width(df.schema)
    if row_bound is None:
        row_bound = df.limit(most + 1).count()
    return F.broadcast(df) if row_bound <= most else df
