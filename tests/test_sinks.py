"""Sink semantics: day overwrite leaves other days, reruns are idempotent."""

import os
import uuid

import pytest


from pomelo.session import scratch_path
from pomelo.sinks import publish as PB
from pomelo.sinks import tables as SK


def _name():
    return f"t_{uuid.uuid4().hex[:8]}"


def test_partition_overwrite_keeps_other_days_and_is_idempotent(spark):
    name = _name()
    SK.create_partitioned_table(spark, name, "k STRING, v INT", scratch_path(spark, name))
    a = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    b = spark.createDataFrame([("c", 3)], "k string, v int")
    SK.overwrite_partition(spark, a, name, "20171027")
    SK.overwrite_partition(spark, b, name, "20171028")
    SK.overwrite_partition(spark, b, name, "20171028")  # rerun of the same day
    got = sorted(tuple(r) for r in spark.table(name).collect())
    assert got == [("a", 1, "20171027"), ("b", 2, "20171027"), ("c", 3, "20171028")]
    # create-if-absent does not wipe data
    SK.create_partitioned_table(spark, name, "k STRING, v INT", scratch_path(spark, name))
    assert spark.table(name).count() == 3


def test_overwrite_then_append(spark):
    name = _name()
    SK.create_table(spark, name, "k STRING", scratch_path(spark, name))
    SK.overwrite_table(spark, spark.createDataFrame([("x",)], "k string"), name)
    SK.overwrite_table(spark, spark.createDataFrame([("y",)], "k string"), name)
    SK.append(spark, spark.createDataFrame([("z",)], "k string"), name)
    assert sorted(r.k for r in spark.table(name).collect()) == ["y", "z"]


def test_text_table_empty_string_and_null_read_back_as_null(spark):
    name = _name()
    loc = scratch_path(spark, name)
    SK.create_text_table(spark, name, "k STRING, v STRING", loc, null_format="")
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "x")], "k string, v string")
    SK.overwrite_table(spark, df, name)
    got = sorted((r.k, r.v) for r in spark.table(name).collect())
    assert got == [("a", None), ("b", None), ("c", "x")]
    raw = SK.read_delimited(spark, loc, "k string, v string", null_format="")
    assert sorted((r.k, r.v) for r in raw.collect()) == got


def _published(spark):
    p = PB.Published(scratch_path(spark, "publish"), _name(), _name(), _name())
    PB.create(spark, p, "entity_id STRING, class_name STRING", "m DOUBLE")
    return p


def _rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "entity_id string, class_name string")


def _shown(spark, p):
    return [sorted(map(tuple, spark.table(v).collect())) for v in (p.predictions, p.latest, p.metrics)]


def test_publish_shows_three_sinks(spark):
    p = _published(spark)
    assert _shown(spark, p) == [[], [], []]
    old, new = _rows(spark, ("a", "pos")), _rows(spark, ("a", "pos"), ("b", "neg"))
    record = spark.createDataFrame([(0.5,)], "m double")
    PB.publish(spark, old, record, "20171027", p)
    for _ in range(2):                       # a rerun replaces
        PB.publish(spark, new, record, "20171028", p)
        assert _shown(spark, p) == [[("a", "pos", "20171027"), ("a", "pos", "20171028"), ("b", "neg", "20171028")],
                                    [("a", "pos"), ("b", "neg")], [(0.5, "20171027"), (0.5, "20171028")]]
    PB.create(spark, p, "entity_id STRING, class_name STRING", "m DOUBLE")      # create-if-absent leaves everything
    assert spark.table(p.latest).count() == 2


@pytest.mark.parametrize("after", [1, 2, 3])
def test_a_publish_that_dies_between_the_sinks_shows_nothing(spark, monkeypatch, after):
    p = _published(spark)
    record = spark.createDataFrame([(0.5,)], "m double")
    PB.publish(spark, _rows(spark, ("a", "pos")), record, "20171028", p)
    before, calls = _shown(spark, p), []
    staged = PB.stage

    def dying(*args):
        calls.append(args)
        out = staged(*args)
        if len(calls) == after:
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(PB, "stage", dying)
    new = _rows(spark, ("a", "neg"), ("b", "neg"))
    with pytest.raises(RuntimeError, match="lost"):
        PB.publish(spark, new, spark.createDataFrame([(0.9,)], "m double"), "20171028", p)
    assert _shown(spark, p) == before
    monkeypatch.setattr(PB, "stage", staged)
    run = PB.publish(spark, new, spark.createDataFrame([(0.9,)], "m double"), "20171028", p)
    assert _shown(spark, p) == [[("a", "neg", "20171028"), ("b", "neg", "20171028")], [("a", "neg"), ("b", "neg")], [(0.9, "20171028")]]
    assert PB.current_run(spark, p, "20171028") == run
    # the dead run's files are gone; the replaced run stays until the next publish
    assert len(spark.sql(f"SHOW PARTITIONS {p.runs(p.predictions)}").collect()) == 2
    assert len(PB.sweep(spark, p, "20171028")) == 1 and _shown(spark, p)[1] == [("a", "neg"), ("b", "neg")]
    loc = p.loc(p.runs(p.predictions)).removeprefix("file:")
    assert [x for x in os.listdir(loc + "/stat_date=20171028") if not x.startswith(".")] == [f"run_id={run}"]


def test_views_read_only_the_shown_runs(spark):
    p = _published(spark)
    record = spark.createDataFrame([(0.5,)], "m double")
    for day in ("20171027", "20171028", "20171028"):
        PB.publish(spark, _rows(spark, ("a", "pos")), record, day, p)
    plan = spark.table(p.latest)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "Subquery" in plan


def test_append_keyed_by_day(spark):
    name = _name()
    SK.create_table(spark, name, "v INT, day STRING", scratch_path(spark, name), partitioned_by=("day",))
    for day, v in (("1", 10), ("2", 20), ("2", 21)):
        SK.append_day(spark, spark.createDataFrame([(v,)], "v int"), name, day, "day")
    assert sorted(map(tuple, spark.table(name).collect())) == [(10, "1"), (21, "2")]


def test_read_hive_default_text_files(spark):
    loc = scratch_path(spark, "hive_text")
    path = loc[len("file:"):] if loc.startswith("file:") else loc
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0"), "w", encoding="utf-8") as f:
        f.write("a\u00011\nb\u0001\\N\n")
    df = SK.read_delimited(spark, loc, "k string, v int")
    assert sorted((r.k, r.v) for r in df.collect()) == [("a", 1), ("b", None)]


def test_columns_are_matched_by_name_and_views_are_dropped(spark):
    name = _name()
    SK.create_table(spark, name, "a STRING, b STRING", scratch_path(spark, name))
    SK.overwrite_table(spark, spark.createDataFrame([("B", "A")], "b string, a string"), name)
    SK.append(spark, spark.createDataFrame([("B2", "A2")], "b string, a string"), name)
    assert sorted(map(tuple, spark.table(name).select("a", "b").collect())) == [("A", "B"), ("A2", "B2")]
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("pomelo_src_")]


def test_a_bucket_is_one_file(spark):
    name = _name()
    SK.create_partitioned_table(spark, name, "k STRING, v INT", scratch_path(spark, name), bucket_by="k", buckets=4)
    rows = spark.range(2000).selectExpr("cast(id as string) as k", "cast(id as int) as v").repartition(13)
    SK.overwrite_partition(spark, rows, name, "20171028", bucket_by="k", buckets=4)
    assert len(spark.table(name).inputFiles()) <= 4
    assert spark.table(name).count() == 2000


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace
    from pomelo.session import ensure_checkpoint_dir
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        session = SimpleNamespace(sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
                                  conf=SimpleNamespace(get=lambda k, d: d))
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(session)
