"""The daily run end to end: all jobs, fitted model, tables written."""

import uuid

from pyspark.sql import functions as F

from compare import assert_same
from conftest import SF_SMALL, duck_for
from pomelo import params as P
from pomelo.plans import jobs as J
from pomelo.plans.oracle import statement
from pomelo.session import scratch_path
from pomelo.sinks import tables as SK
from pomelo.sources import fixtures as FX
from pomelo.sources.tables import latest_partition_value_from_catalog


D = "20171028"
LEFT_ONLY = """SELECT entity_id, CASE WHEN label = 1 THEN 'pos' ELSE 'neg' END AS class_name FROM device_labels
    WHERE entity_id NOT IN (SELECT entity_id FROM branch_labels)"""


def same(table, sql, *pieces):
    """A written table holds the rows of a statement over the oracle's pieces."""
    assert_same(table, duck_for(SF_SMALL), statement(sql, *pieces))


def test_daily_run(spark):
    tag = uuid.uuid4().hex[:6]
    t = J.TableNames(root=scratch_path(spark, "run"), **{
        f: f"{getattr(J.TableNames, f)}_{tag}" for f in
        ("items", "features", "known_labels", "known_labels_twin", "decoded", "truth_part",
         "predictions", "latest", "metrics", "accuracy", "log")})
    params = P.RunParams(top_k=1000, feature_buckets=8)
    chain = J.FittedChain(spark, FX.load_inputs(spark, SF_SMALL), params)

    J.feature_build(spark, chain, t)
    assert spark.table(t.features).where(F.col("stat_date") == "20171028").count() > 0
    bal = J.label_build(spark, chain, t).collect()[0]
    assert bal.n == bal.n_pos + bal.n_neg > 0
    dist = J.decode_build(spark, chain, t).collect()
    assert abs(sum(r.share for r in dist) - 1.0) < 1e-5
    for _ in range(2):      # a second run of the day changes nothing
        rep = J.agreement(spark, chain, t).collect()[0]
        assert rep.n_both == rep.n_match + rep.n_mismatch
        same(spark.table(t.known_labels_twin), """
            SELECT entity_id, label FROM two_branch
            UNION SELECT a.entity_id, a.label FROM device_labels a JOIN branch_labels b USING (entity_id)
            WHERE a.label = b.label""", "two_branch", "device_labels", "branch_labels")
        same(spark.table(t.truth_part), LEFT_ONLY, "device_labels", "branch_labels")
    same(spark.table(t.items), f"SELECT code, name, column_index, '{D}' AS stat_date FROM dim", "dim")
    same(spark.table(t.features), f"SELECT entity_id, feature, '{D}' AS stat_date FROM features", "features")
    same(spark.table(t.known_labels), "SELECT entity_id, label FROM known_labels", "known_labels")
    same(spark.table(t.decoded), "SELECT user_id, age_range, class_name FROM decoded", "decoded")

    rec = J.train_publish(spark, chain, t).collect()
    # the training job read the bucketed feature table back: grouping it by
    # entity (as J9 does) needs no exchange
    feats = spark.table(t.features).where(F.col("stat_date") == "20171028")
    plan = feats.groupBy("entity_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert feats.count() == chain.features.count()
    assert len(rec) == 1
    r = rec[0]
    assert r.default_threshold == 0.5 and 0.0 <= r.select_threshold <= 1.0
    assert spark.table(t.predictions).count() == r.merged_pos + r.merged_neg
    assert r.merged_pos + r.merged_neg >= r.pred_pos + r.pred_neg > 0
    assert spark.table(t.latest).count() == r.merged_pos + r.merged_neg
    J.validation(spark, chain, t)
    acc = J.validation(spark, chain, t).collect()       # a rerun of the day gives one row
    assert len(acc) == 1 and acc[0].date == "20171028"
    # both truth accuracies against the written latest table and the written partial truth
    latest = dict(map(tuple, spark.table(t.latest).select("entity_id", "class_name").collect()))
    for got, truth in ((acc[0].accuracy_full, chain.truth_latest), (acc[0].accuracy_part, spark.table(t.truth_part))):
        pairs = [(x.class_name, latest[x.entity_id]) for x in truth.collect() if x.class_name and latest.get(x.entity_id)]
        assert pairs and abs(got - sum(a == b for a, b in pairs) / len(pairs)) < 1e-12
    # a second run of the same day replaces, never duplicates
    J.train_publish(spark, chain, t)
    assert spark.table(t.latest).count() == r.merged_pos + r.merged_neg
    assert spark.table(t.metrics).count() == 1
    log = {(x.job, x.table_name): (x.n_rows, x.derived) for x in spark.table(t.log).where(F.col("run_date") == D).collect()}
    assert log["label", t.known_labels] == (spark.table(t.known_labels).count(), "")
    assert log["train", t.latest] == (spark.table(t.latest).count(), "") and log["validation", t.accuracy] == (1, "")
    assert len(log) == 8


def test_a_job_without_its_inputs_fails_or_says_what_it_derived(spark):
    import pytest
    from pomelo.plans import daily
    from pomelo.plans.provenance import MissingInput
    tag = uuid.uuid4().hex[:6]
    t = J.TableNames(root=scratch_path(spark, "alone"), **{
        f: f"{getattr(J.TableNames, f)}_{tag}" for f in
        ("items", "features", "known_labels", "known_labels_twin", "decoded", "truth_part",
         "predictions", "latest", "metrics", "accuracy", "log")})
    params = P.RunParams(top_k=1000, feature_buckets=4)
    inputs = FX.load_inputs(spark, SF_SMALL)
    chain = J.FittedChain(spark, inputs, params, J.MD.lbfgs_estimator(max_iter=5))
    with pytest.raises(MissingInput, match="'feature'"):
        J.train_publish(spark, chain, t)
    J.feature_build(spark, chain, t)
    with pytest.raises(MissingInput, match="'label'"):
        J.train_publish(spark, chain, t)
    J.label_build(spark, chain, t)
    with pytest.raises(MissingInput, match="'agreement'"):
        J.train_publish(spark, chain, t)
    with pytest.raises(MissingInput, match="'train'"):
        J.validation(spark, chain, t, derive_missing=True)      # predictions cannot be derived
    # tables of another run date do not count
    other = J.FittedChain(spark, inputs, P.RunParams(run_date="20171029", top_k=1000), J.MD.lbfgs_estimator(max_iter=5))
    with pytest.raises(MissingInput, match="'feature'"):
        J.train_publish(spark, other, t)
    J.train_publish(spark, chain, t, derive_missing=True)
    J.validation(spark, chain, t, derive_missing=True)
    log = {x.table_name: x.derived for x in spark.table(t.log).collect()}
    assert log[t.latest] == t.truth_part and log[t.accuracy] == t.truth_part and log[t.features] == ""
    root = scratch_path(spark, "cli")
    with pytest.raises(MissingInput):
        daily.main(["--date", "20180101", "--out-root", root, "--sf-dir", SF_SMALL, "--jobs", "train"])


def test_latest_partition_from_catalog(spark):
    name = f"parts_{uuid.uuid4().hex[:6]}"
    SK.create_partitioned_table(spark, name, "k STRING", scratch_path(spark, name))
    for d in ("20170711", "20171105", "20170910"):
        SK.overwrite_partition(spark, spark.createDataFrame([(d,)], "k string"), name, d)
    v = spark.range(1).select(latest_partition_value_from_catalog(spark, name).alias("v")).collect()[0].v
    assert v == 20171105


def test_ml_variant_and_drift_jobs(spark):
    params = P.RunParams(top_k=1000)
    inputs = FX.load_inputs(spark, SF_SMALL)
    chain = J.FittedChain.ml_variant(spark, inputs, params)
    best = chain.best.collect()
    assert len(best) == 1 and 0.0 < best[0].threshold < 1.0 and 0.0 < best[0].f1 <= 1.0
    assert chain.model.intercept != 0.0
    row = J.drift(spark, chain, J.TableNames(root=""), ["7", "42", "137", "3"]).collect()[0]
    assert row.n_changed_new > 0 and row.n_hit_new + row.n_hit_old > 0


def test_daily_command_line_reads_catalog_tables(spark):
    import json
    import dataclasses
    from pomelo.plans import daily
    inputs = FX.load_inputs(spark, SF_SMALL)
    names = {}
    for f in dataclasses.fields(FX.Inputs):
        if f.name != "truth_table":
            view = f"in_{f.name}_{uuid.uuid4().hex[:6]}"
            getattr(inputs, f.name).createOrReplaceTempView(view)
            names[f.name] = view
    truth = f"in_truth_{uuid.uuid4().hex[:6]}"
    SK.create_partitioned_table(spark, truth, "entity_id STRING, class_name STRING", scratch_path(spark, truth))
    for day in ("20170711", "20171105"):
        SK.overwrite_partition(spark, inputs.truth_full.where(F.col("stat_date") == day), truth, day)
    names["truth_full"] = truth
    got = daily.inputs_from_catalog(spark, names)
    twin = daily.inputs_from_catalog(spark, {k: v for k, v in names.items() if k != "device_user_twin"}).device_user_twin
    assert sorted(map(tuple, twin.collect())) == sorted(map(tuple, inputs.device_user.collect()))
    assert got.truth_table == truth and daily.inputs_from_catalog(spark, {**names, "truth_full": names["users"]}).truth_table is None
    root = scratch_path(spark, "daily")
    daily.main(["--date", "20171028", "--agreement-date", "20170711", "--out-root", root, "--top-k", "1000",
                "--feature-buckets", "4", "--inputs", json.dumps(names), "--jobs", "label,decode,agreement"])
    t = J.TableNames(root=root)
    assert spark.table(t.known_labels).count() > 0
    assert spark.table(t.decoded).count() > 0
    assert spark.table(t.truth_part).count() > 0
    daily.main(["--date", "20171028", "--snapshot-old", "20170910", "--drift-items", "7,42", "--out-root", root,
                "--inputs", json.dumps(names), "--jobs", "drift"])
