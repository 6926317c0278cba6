"""Sink queries: write with the K-operators into fresh tables, read back.

Each call creates its tables under a fresh folder of the shared checkpoint
location (``session.scratch_path``) with unique names, runs the writes, and
returns the table read back as a lazy DataFrame.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.operators import features as FE
from pomelo.operators import merge as MG
from pomelo.plans.chain import Chain
from pomelo.session import scratch_path
from pomelo.sinks import publish as PB
from pomelo.sinks import tables as SK

OLD_DAY = "20171027"


def _name(base: str) -> str:
    return f"pomelo_{base}_{uuid.uuid4().hex[:10]}"


def partition_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K4: item table with two days; the run day is written twice
    (first a part, then the whole index), the other day must survive."""
    c = Chain.from_testdata(spark, sf_dir)
    name = _name("items")
    SK.create_partitioned_table(spark, name, "code STRING, name STRING, column_index BIGINT",
                                scratch_path(spark, name))
    dim = FE.dimension_rows(c.item_index)
    SK.overwrite_partition(spark, dim, name, OLD_DAY)
    SK.overwrite_partition(spark, dim.where(F.col("column_index") < 100), name, c.p.run_date)
    SK.overwrite_partition(spark, dim, name, c.p.run_date)
    return spark.table(name)


def table_overwrite_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + K5 + K6: overwrite twice (the second replaces the first), then
    append the agreed rows."""
    c = Chain.from_testdata(spark, sf_dir)
    name = _name("labels")
    SK.create_table(spark, name, "entity_id STRING, label INT", scratch_path(spark, name))
    SK.overwrite_table(spark, c.known_labels.where(F.col("label") == 1), name)
    SK.overwrite_table(spark, c.known_labels, name)
    SK.append(spark, MG.agreed_rows(c.device_labels, c.branch_labels), name)
    return spark.table(name)


def null_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + S8: trusted rows (some classes NULL) through a delimited text
    table with ``''`` as the NULL format, read back from the files."""
    c = Chain.from_testdata(spark, sf_dir)
    name = _name("truth_text")
    loc = scratch_path(spark, name)
    SK.create_text_table(spark, name, "entity_id STRING, class_name STRING", loc,
                         null_format="", partition_col="stat_date")
    truth = c.inp.truth_full.select("entity_id", "class_name", "stat_date")
    for day in ("20170711", "20171105"):
        SK.overwrite_partition(spark, truth.where(F.col("stat_date") == day), name, day)
    return spark.table(name).select("entity_id", "class_name", "stat_date")


def publish_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: publish an earlier day, the day, and the day again; every row that
    the three sinks then show of it, as (sink, key, class_name, value)."""
    c = Chain.from_testdata(spark, sf_dir, materialize=True)
    p = PB.Published(scratch_path(spark, "publish"), _name("pred"), _name("latest"), _name("metrics"))
    record = c.run_record
    PB.create(spark, p, "entity_id STRING, class_name STRING", ", ".join(f"{x} DOUBLE" for x in record.columns))
    # an earlier day, an earlier run of the day, and one that never gets to the switch must not show
    PB.publish(spark, c.known_plus_predicted, record, OLD_DAY, p)
    PB.publish(spark, c.known_plus_predicted, record, c.p.run_date, p)
    PB.stage(spark, c.known_plus_predicted, p, p.latest, c.p.run_date, "abandoned")
    PB.publish(spark, c.merged, record, c.p.run_date, p)
    none = F.lit(None)
    day = spark.table(p.predictions).where(F.col("stat_date") == c.p.run_date)
    written = spark.table(p.metrics).where(F.col("stat_date") == c.p.run_date)
    names = record.columns
    values = written.select(F.explode(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value"))
                                                for n in names])).alias("m"))
    rows = [df.select(F.lit(tag).alias("sink"), F.col("entity_id").alias("key"), "class_name",
                      none.cast("double").alias("value")) for tag, df in (("prediction_day", day), ("latest", spark.table(p.latest)))]
    return rows[0].unionByName(rows[1]).unionByName(values.select(
        F.lit("metrics").alias("sink"), "m.key", none.cast("string").alias("class_name"),
        F.round("m.value", 6).alias("value")))


def latest_partition_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S4 + P22: the trusted source as a partitioned table; its newest
    partition is found by the partition names and read alone."""
    c = Chain.from_testdata(spark, sf_dir)
    name = _name("truth")
    SK.create_partitioned_table(spark, name, "entity_id STRING, class_name STRING", scratch_path(spark, name))
    truth = c.inp.truth_full.select("entity_id", "class_name", "stat_date")
    for day in ("20170711", "20171105"):
        SK.overwrite_partition(spark, truth.where(F.col("stat_date") == day), name, day)
    inputs = dataclasses.replace(c.inp, truth_full=spark.table(name), truth_table=name)
    latest = Chain(spark, inputs, c.p).truth_latest
    return latest.select("entity_id", F.col("class_name").alias("class_trusted"))
