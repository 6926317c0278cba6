"""Plan shape of every registered query: what must (not) appear at scale."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from pomelo.operators import labels as LB
from pomelo.plans.chain import Chain
from pomelo.plans.queries import QUERIES
from pomelo.sources.tables import day_partition

# the vectors of a fit pass through a function on whole Arrow arrays (M1), whose plan node ends in this number;
# functions called row by row have others
FITS = {"lr_fit_predict", "lr_fit_intercept"}
ON_ARRAYS = 250


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_nested_loop_or_python(spark, name, monkeypatch):
    """Of the query's own plan and of every plan that is run or cut off before it."""
    plans = []
    own = type(spark.range(1))

    def seen(self, *args, **kwargs):
        plans.append(plan_text(self))
        return kept(self, *args, **kwargs)

    kept = own.checkpoint
    monkeypatch.setattr(own, "checkpoint", seen)
    plans.append(plan_text(QUERIES[name](spark, SF_SMALL)))
    for text in plans:
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
        for node in ("BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", *(["ArrowEvalPython"] * (name not in FITS))):
            assert node not in text
        kinds = re.findall(r"^\(\d+\) ArrowEvalPython.*?, (\d+)\n\n", text, re.M | re.S)
        assert set(kinds) <= {str(ON_ARRAYS)} and len(kinds) == len(re.findall(r"^\(\d+\) ArrowEvalPython", text, re.M))


@pytest.mark.parametrize("name", ["train_set", "predict_set", "set_cardinality_report"])
def test_sets_neither_sort_nor_aggregate_the_feature_strings(spark, name):
    """Hash aggregates over numbers, and a hash join that the feature rows stream past."""
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "SortAggregate" not in text and "SortMergeJoin" not in text and "ShuffledHashJoin" in text
    assert not [x for x in re.findall(r"^\(\d+\) Sort(?: \[.*\])?$[\s\S]*?^Input[^\n]*", text, re.M) if "feature" in x]


def test_sets_over_a_bucketed_feature_table_do_not_shuffle_it(spark):
    from pomelo.operators import sets as ST
    from pomelo.session import scratch_path
    from pomelo.sinks import tables as SK
    name = "bucketed_features"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    SK.create_partitioned_table(spark, name, "entity_id STRING, feature STRING", scratch_path(spark, name), bucket_by="entity_id", buckets=8)
    c = Chain.from_testdata(spark, SF_SMALL)
    SK.overwrite_partition(spark, c.features, name, "D", bucket_by="entity_id", buckets=8)
    written = spark.table(name).where("stat_date = 'D'").select("entity_id", "feature")
    counts = ST.tag_counts(c.set_labels, written)
    assert sorted(map(tuple, ST.tagged_sets(counts, written).collect())) == sorted(map(tuple, c.tagged.collect()))
    train = ST.train_rows(ST.tagged_sets(counts, written))
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, c.train.collect()))
    text = plan_text(train)
    assert not [x for x in re.findall(r"^\(\d+\) Exchange$[\s\S]*?^Arguments", text, re.M) if "feature" in x]


def test_override_merge_aggregates_by_hash(spark):
    from pomelo import params as P
    from pomelo.operators import merge as MG
    rows = spark.range(10).selectExpr("cast(id as string) as entity_id", "if(id % 2 = 0, 'pos', 'neg') as class_name")
    text = plan_text(MG.override_merge(rows, rows, P.ClassNames()))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_distribution_has_no_window_over_all_values(spark):
    text = plan_text(QUERIES["bucket_distribution"](spark, SF_SMALL))
    assert "Window" not in text and "Subquery" in text


def test_hot_user_join_is_split(spark, tmp_path):
    """A user with half of all devices; the join deals its rows out anew."""
    (spark.range(40_000).selectExpr("concat('d', id) as entity_id", "if(id % 2 = 0, 7L, id) as user_id", "'D' as stat_date")
     .repartition(8).write.parquet(str(tmp_path / "d")))
    (spark.range(40_000).selectExpr("id as user_id", "cast(1 + id % 2 as int) as label_code", "'D' as stat_date")
     .write.parquet(str(tmp_path / "u")))
    devices, users = (spark.read.parquet(str(tmp_path / x)) for x in "du")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        one = LB.user_device_labels(users, devices, "D")
        assert len(one.collect()) == 40_000
        both = LB.two_branch_labels(users, devices, "D")
        assert len(both.collect()) == 40_000
        for df in (one, both):
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_feature_join_broadcasts_only_the_bounded_index(spark):
    c = Chain.from_testdata(spark, SF_SMALL)
    text = plan_text(c.features)
    assert "BroadcastHashJoin" in text
    # the behaviour side is never broadcast: every broadcast has <= K rows by construction
    assert "TakeOrderedAndProject" in text or "limit" in text.lower()


@pytest.mark.parametrize("name", ["hard_auc_accuracy", "score_linear"])
def test_kept_run_steps_build_behavior_and_top_k_once(spark, name, monkeypatch):
    """Over all plans that are run for the query: one builds the behaviour, one counts and ranks the items."""
    plans = []
    own = type(spark.range(1))
    kept = own.checkpoint

    def seen(self, *args, **kwargs):
        plans.append(plan_text(self))
        return kept(self, *args, **kwargs)

    monkeypatch.setattr(own, "checkpoint", seen)
    plans.append(plan_text(QUERIES[name](spark, SF_SMALL)))
    assert sum("partial_collect_list(token" in x for x in plans) == 1
    assert sum("install_num" in x and "TakeOrderedAndProject" in x for x in plans) == 1


def test_tokens_are_taken_apart_once(spark, tmp_path):
    """neither a filter nor a column after the explode splits again, and none before it does."""
    from pomelo.operators import tokens as TK
    spark.range(10).selectExpr("concat('d', id) as entity_id", "'111:1 x 112:2: 113:' as feature").write.parquet(str(tmp_path / "b"))
    tokens = TK.explode_behavior(spark.read.parquet(str(tmp_path / "b"))).select("entity_id", "item_code")
    assert sorted({r.item_code for r in tokens.collect()}) == ["111", "112"]
    text = plan_text(tokens)
    assert text.count("transform(split(") == 1 and not re.findall(r"^Condition .*split\(", text, re.M)


def test_scan_prunes_columns_and_pushes_filters(spark, tmp_path):
    c = Chain.from_testdata(spark, SF_SMALL)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan_text(c.truth_latest)
    plain, days = str(tmp_path / "plain"), str(tmp_path / "days")
    c.inp.behavior.write.parquet(plain)
    c.inp.behavior.write.partitionBy("stat_date").parquet(days)
    text = plan_text(day_partition(spark.read.parquet(plain), c.p.run_date).select("entity_id"))
    assert f"EqualTo(stat_date,{c.p.run_date})" in text and "ReadSchema: struct<entity_id:string,stat_date:string>" in text
    text = plan_text(day_partition(spark.read.parquet(days), c.p.run_date).select("entity_id"))
    assert "PartitionFilters: [isnotnull(stat_date" in text and "ReadSchema: struct<entity_id:string>" in text


def test_latest_partition_is_a_scalar_subquery(spark):
    c = Chain.from_testdata(spark, SF_SMALL)
    assert "Subquery" in plan_text(c.truth_latest)
