"""Model invariants (the fit itself has no SQL oracle)."""

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pomelo.operators import metrics as MT
from pomelo.operators import model as MD
from pomelo.operators import sets as ST
from pomelo.plans.chain import Chain


def test_hash_split_is_stable_and_near_fraction(spark):
    c = Chain.from_testdata(spark, SF_SMALL)
    a = {r.entity_id: r.split for r in c.split.collect()}
    b = {r.entity_id: r.split for r in ST.hash_split(c.train.repartition(3), 1234, 0.8).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.7 < share < 0.9


def test_transform_equals_weight_table_scoring(spark):
    c = Chain.from_testdata(spark, SF_SMALL)
    train = c.split.where(F.col("split") == "train")
    model = MD.fit(train, c.p.top_k, MD.lbfgs_estimator(max_iter=20))
    by_model = {r.entity_id: r.score for r in MD.score_with_model(model, c.predict, c.p.top_k, 0.5).collect()}
    w = MD.weight_table(spark, model)
    by_table = {r.entity_id: r.score for r in
                MD.score_with_weights(c.predict, w, 0.5).collect()}
    assert set(by_model) == set(by_table) and by_model
    assert max(abs(by_model[k] - by_table[k]) for k in by_model) < 1e-9


def test_loss_history_decreases(spark):
    c = Chain.from_testdata(spark, SF_SMALL)
    model = MD.fit(c.split.where(F.col("split") == "train"), c.p.top_k, MD.ml_estimator(max_iter=50))
    hist = [r.loss for r in MD.loss_history(spark, model).orderBy("iteration").collect()]
    assert len(hist) >= 2 and hist[-1] <= hist[0]


@pytest.mark.parametrize("intercept", [False, True])
def test_certificate_tells_a_fit_from_a_stopped_one(spark, intercept):
    from pomelo.plans.queries import OPTIMAL, _fit_rows
    c = Chain.from_testdata(spark, SF_SMALL, materialize=True)
    train = c.split.where(F.col("split") == "train").checkpoint()
    make = MD.ml_estimator if intercept else MD.lbfgs_estimator
    whole, stopped = MD.fit(train, c.p.top_k, make()), MD.fit(train, c.p.top_k, make(max_iter=1))
    rows = [(r.label, dict((int(i), float(v)) for i, v in (t.split(":") for t in r.feature.split()))) for r in train.collect()]
    for model, optimal in ((whole, True), (stopped, False)):
        got = {r.column_index: r for r in MD.optimality(MD.training_scores(model, train, c.p.top_k), intercept).collect()}
        coef = model.coefficients.toArray()
        want = {}
        for y, x in rows:
            p = 1 / (1 + np.exp(-(model.intercept + sum(coef[i] * v for i, v in x.items()))))
            for i, v in {**x, **({MD.INTERCEPT: 1.0} if intercept else {})}.items():
                n, a, b = want.get(i, (0, 0.0, 0.0))
                want[i] = n + 1, a + y * v, b + p * v
        assert set(got) == set(want)
        for i, (n, a, b) in want.items():
            assert got[i].n_rows == n and abs(got[i].label_sum - a) < 1e-9 and abs(got[i].score_sum - b) < 1e-6
            assert abs(got[i].gradient - (b - a) / len(rows)) < 1e-8
        assert (max(abs(r.gradient) for r in got.values()) < OPTIMAL) == optimal
        values = {(r.part, r.key): r.value for r in _fit_rows(c, model, train).collect()}
        assert all(values["column", str(i)] == a for i, (_, a, _) in want.items()) == optimal
        assert values["loss", "last"] == 0.0 and values["loss", "rises"] == 0.0
        share = sum(y for y, _ in rows) / len(rows)
        first = -(share * np.log(share) + (1 - share) * np.log(1 - share)) if intercept else np.log(2)
        assert abs(values["loss", "first"] - first) < 1e-6


def test_closed_form_auc_matches_mllib(spark):
    from pyspark.mllib.evaluation import BinaryClassificationMetrics
    rng = np.random.default_rng(7)
    rows = [(int(p), int(y)) for p, y in zip(rng.integers(0, 2, 300), rng.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "prediction int, label int")
    ours = MT.hard_metrics(df).collect()[0].auc
    ref = BinaryClassificationMetrics(df.rdd.map(lambda r: (float(r.prediction), float(r.label)))).areaUnderROC
    assert abs(ours - ref) < 1e-12


def test_f1_curve_matches_mllib_and_brute_force(spark):
    from pyspark.mllib.evaluation import BinaryClassificationMetrics
    rng = np.random.default_rng(11)
    scores = np.round(rng.random(500), 3)
    labels = rng.integers(0, 2, 500)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int")
    for ranges in (1, 5, 16):
        ours = {r.threshold: r.f1 for r in MT.f1_by_threshold(df, ranges=ranges).collect()}
        P = labels.sum()
        for t in list(ours)[:50]:
            tp = int(((scores >= t) & (labels == 1)).sum())
            pp = int((scores >= t).sum())
            assert abs(ours[t] - 2 * tp / (pp + P)) < 1e-12
    m = BinaryClassificationMetrics(df.rdd.map(lambda r: (r.score, float(r.label))))
    jm = m._java_model.fMeasureByThreshold().toJavaRDD().collect()
    ref = {float(x._1()): float(x._2()) for x in jm}
    assert set(ref) == set(ours)
    assert max(abs(ref[t] - ours[t]) for t in ref) < 1e-9


def test_threshold_on_training_scores_is_exact(spark):
    """More than 5,000 distinct scores: every one is a candidate."""
    rng = np.random.default_rng(3)
    n = 6000
    x = rng.normal(size=(n, 3)).round(4)
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=n) * 2 > 0).astype(float)
    rows = [(f"e{i}", float(t), " ".join(f"{j}:{v}" for j, v in enumerate(r))) for i, (r, t) in enumerate(zip(x, y))]
    train = spark.createDataFrame(rows, "entity_id string, label double, feature string")
    model = MD.fit(train, 3, MD.ml_estimator(max_iter=30))
    scored = MD.score_with_model(model, train, 3, 0.5).select("score", "label").toPandas()
    score, label = scored["score"].to_numpy(), scored["label"].to_numpy()
    assert len(set(score)) > 5000
    order = np.argsort(-score, kind="stable")
    tp, pp = np.cumsum(label[order]), np.arange(1, n + 1)
    last = np.append(score[order][1:] != score[order][:-1], True)
    f1 = 2 * tp / (pp + label.sum())
    at = np.flatnonzero(last)[np.argmax(f1[last])]
    got = MD.best_threshold_on_training(model, train, 3).collect()[0]
    assert abs(got.threshold - score[order][at]) < 1e-15 and abs(got.f1 - f1[at]) < 1e-12


def test_vectors_carry_values_and_reject_foreign_indices(spark):
    from pomelo.operators.features import assemble_vectors
    df = spark.createDataFrame([("a", "2:0.5 0:3 1:x:"), ("b", ""), ("c", None)], "entity_id string, feature string")
    got = {r.entity_id: r.features for r in assemble_vectors(df.withColumn(
        "feature", F.regexp_replace("feature", " 1:x:", "")), 4).collect()}
    assert got["a"].toArray().tolist() == [3.0, 0.0, 0.5, 0.0] and got["b"].numNonzeros() == 0 and got["c"] is None
    for bad in ("4:1", "-1:1", "1:1 1:2"):
        with pytest.raises(SparkRuntimeException, match="outside"):
            assemble_vectors(spark.createDataFrame([(bad,)], "feature string"), 4).collect()


def test_both_scoring_forms_agree_on_values(spark):
    rows = [(f"e{i}", float(i % 2), f"0:{i % 5} 1:{(i * 7) % 3 + 0.25}") for i in range(60)]
    df = spark.createDataFrame(rows, "entity_id string, label double, feature string")
    model = MD.fit(df, 3, MD.ml_estimator(max_iter=20))
    a = {r.entity_id: r.score for r in MD.score_with_model(model, df, 3, 0.5).collect()}
    b = {r.entity_id: r.score for r in MD.score_with_weights(
        df, MD.weight_table(spark, model), 0.5, float(model.intercept)).collect()}
    assert set(a) == set(b) and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_entities_without_weights_score_at_the_intercept(spark):
    df = spark.createDataFrame([("a", "0:1"), ("b", "5:1"), ("c", ""), ("d", "0:2 5:1")], "entity_id string, feature string")
    w = spark.createDataFrame([(0, 1.5)], "column_index int, weight double")
    got = {r.entity_id: r.margin for r in MD.score_with_weights(df, w, 0.5, intercept=0.25).collect()}
    assert got == {"a": 1.75, "b": 0.25, "c": 0.25, "d": 3.25}


def test_random_split_variant_is_seeded(spark):
    df = spark.range(2000).withColumnRenamed("id", "entity_id").coalesce(4)
    a1, b1 = ST.random_split(df, 1234, 0.8)
    a2, b2 = ST.random_split(df, 1234, 0.8)
    assert sorted(r.entity_id for r in a1.collect()) == sorted(r.entity_id for r in a2.collect())
    assert a1.count() + b1.count() == 2000 and 0.7 < a1.count() / 2000 < 0.9
