"""Registered driver queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the test tables under ``sf_dir`` (through the fixture
derivations) and runs one operator group of SURVEY §2 over the whole data.
The matching DuckDB statements live in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pomelo.functions.dates import normalise_run_date
from pomelo.operators import features as FE
from pomelo.operators import labels as LB
from pomelo.operators import merge as MG
from pomelo.operators import metrics as MT
from pomelo.operators import model as MD
from pomelo.operators import sets as ST
from pomelo.plans import roundtrips as RT
from pomelo.plans.chain import Chain
from pomelo.sources import fixtures as FX
from pomelo.sources import tables as TB

Query = Callable[[SparkSession, str], DataFrame]


def _chain(spark: SparkSession, sf_dir: str) -> Chain:
    return Chain.from_testdata(spark, sf_dir)


def _mchain(spark: SparkSession, sf_dir: str) -> Chain:
    """For queries whose plan reads the same run steps many times."""
    return Chain.from_testdata(spark, sf_dir, materialize=True)


def q_behavior_explode(spark, sf_dir):
    return _chain(spark, sf_dir).tokens


def q_behavior_items_stripped(spark, sf_dir):
    return _chain(spark, sf_dir).behavior_items


def q_item_topk(spark, sf_dir):
    return _chain(spark, sf_dir).topk


def q_active_items_semi(spark, sf_dir):
    return _chain(spark, sf_dir).active


def q_item_index(spark, sf_dir):
    return FE.dimension_rows(_chain(spark, sf_dir).item_index)


def q_feature_strings(spark, sf_dir):
    return _chain(spark, sf_dir).features


def q_feature_parse_long(spark, sf_dir):
    return _chain(spark, sf_dir).feature_long


def q_labels_from_users(spark, sf_dir):
    return _chain(spark, sf_dir).known_labels


def q_labels_two_branch_union(spark, sf_dir):
    """P13 + U4: the rows of both branches, as the twin table gets them."""
    return _chain(spark, sf_dir).two_branch


def q_labels_from_devices(spark, sf_dir):
    return _chain(spark, sf_dir).device_labels


def q_label_balance(spark, sf_dir):
    b = MT.class_balance(_chain(spark, sf_dir).known_labels)
    return b.withColumn("ratio", F.round("ratio", 6))


def q_decode_attributes(spark, sf_dir):
    return _chain(spark, sf_dir).decoded


def q_bucket_distribution(spark, sf_dir):
    return MT.distribution(_chain(spark, sf_dir).decoded, "age_range")


def q_value_counts(spark, sf_dir):
    return MT.group_count(_chain(spark, sf_dir).decoded, "age")


def q_run_date_normalise(spark, sf_dir):
    """D1 over date strings built from the order dates, with day numbers
    pushed past month ends so the lenient roll-over is exercised."""
    o = FX.read_table(spark, sf_dir, "orders")
    day = F.dayofmonth("o_orderdate") + (F.col("o_orderkey") % 4).cast("int") * 3
    raw = F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lpad(day.cast("string"), 2, "0"))
    return o.select("o_orderkey", raw.alias("raw_date")).withColumn("run_date", normalise_run_date("raw_date"))


def q_latest_partition_scan(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return c.truth_latest.select("entity_id", F.col("class_name").alias("class_trusted"))


def q_three_way_label_pred(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return LB.three_way(c.decoded, c.inp.device_user, c.inp.predictions, c.p.label_date, c.p.snapshot_new)


def q_train_set(spark, sf_dir):
    return _chain(spark, sf_dir).train


def q_predict_set(spark, sf_dir):
    return _chain(spark, sf_dir).predict


def q_set_cardinality_report(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return ST.cardinality_report(c.tag_counts, c.tagged)


def q_hash_split(spark, sf_dir):
    return _chain(spark, sf_dir).split.select("entity_id", "label", "split")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def q_score_linear(spark, sf_dir):
    c = _mchain(spark, sf_dir)
    s = MD.score_with_weights(c.predict, c.weights, c.p.threshold, margin_digits=6)
    return _rounded(s, "score")


def q_f1_by_threshold(spark, sf_dir):
    return _rounded(_mchain(spark, sf_dir).f1_curve, "threshold", "f1")


def q_best_threshold(spark, sf_dir):
    return _rounded(_mchain(spark, sf_dir).best, "threshold", "f1")


def q_hard_auc_accuracy(spark, sf_dir):
    m = _mchain(spark, sf_dir).train_metrics
    return _rounded(m, *m.columns)


def q_accuracy_avg(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return _rounded(c.accuracy_against(c.truth_part, c.stored_latest), "accuracy")


def q_eval_full_and_part(spark, sf_dir):
    m = _mchain(spark, sf_dir).eval_metrics
    return _rounded(m, *m.columns)


def q_label_agreement(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return MT.agreement(c.device_labels, c.branch_labels)


def q_agreed_rows(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return MG.agreed_rows(c.device_labels, c.branch_labels)


def q_left_only_rows(spark, sf_dir):
    c = _chain(spark, sf_dir)
    return MG.left_only_rows(c.device_labels, c.branch_labels, c.p.classes)


def q_known_plus_predicted(spark, sf_dir):
    return _mchain(spark, sf_dir).known_plus_predicted


def q_override_merge(spark, sf_dir):
    return _mchain(spark, sf_dir).merged


def q_snapshot_changes(spark, sf_dir):
    return _chain(spark, sf_dir).snapshot_changes


# The listed items of the drift check (a parameter list of item ids).
DRIFT_ITEMS = [("7",), ("42",), ("137",), ("1009",)]


def q_changed_item_share(spark, sf_dir):
    return _chain(spark, sf_dir).changed_item_share(TB.literal_frame(spark, DRIFT_ITEMS, "item_id string"))


def q_run_record(spark, sf_dir):
    r = _mchain(spark, sf_dir).run_record
    return _rounded(r, *r.columns)


def q_validation_run(spark, sf_dir):
    """The validation job: stored latest predictions vs both truth sources."""
    c = _chain(spark, sf_dir)
    full = c.accuracy_against(c.truth_latest, c.stored_latest)
    part = c.accuracy_against(c.truth_part, c.stored_latest)
    row = MT.side_by_side([(full, {"accuracy": "accuracy_full"}),
                           (part, {"accuracy": "accuracy_part"})])
    return _rounded(row.select(F.lit(c.p.snapshot_new).alias("date"), "*"), "accuracy_full", "accuracy_part")


# A fit counts as optimal where no column's mean gradient exceeds this.
OPTIMAL = 1e-5


def _fit_rows(c: Chain, model, train: DataFrame) -> DataFrame:
    """A fitted model as (part, key, n, value) rows.

    ``column``: of every column of the training rows, what the scores add up
    to.  Where the fit is optimal (``OPTIMAL``) that is what the labels add up
    to, and then the labels' sum is given, so the value is known without the
    weights; a fit that stopped too early gives other numbers.
    ``score``: of every entity to be scored, its number of items, and 1 where
    ``transform`` gives what the exported weights give (1e-9) and class 1 is
    exactly above the threshold.
    ``loss``: the first loss (of the model without items: log 2, or the
    labels' entropy with an intercept), by how much the last differs from the
    loss of the exported weights over the table, and how often it rises."""
    scored = c._m(MD.training_scores(model, train, c.p.top_k))
    columns = MD.optimality(scored, model.getFitIntercept()).select(
        F.lit("column").alias("part"), F.col("column_index").cast("string").alias("key"), F.col("n_rows").alias("n"),
        F.when(F.abs("gradient") < OPTIMAL, F.col("label_sum")).otherwise(F.col("score_sum")).alias("value"))
    a = MD.score_with_model(model, c.predict, c.p.top_k, c.p.threshold)
    b = (MD.score_with_weights(c.predict, MD.weight_table(c.spark, model), c.p.threshold, float(model.intercept),
                               keep=("n_active",))
         .select("entity_id", "n_active", F.col("score").alias("long_score")))
    same = ((F.abs(F.col("score") - F.col("long_score")) < 1e-9)
            & ((F.col("prediction") == 1) == (F.col("score") > c.p.threshold)))
    scores = a.join(b, "entity_id", "full_outer").select(
        F.lit("score").alias("part"), F.col("entity_id").alias("key"), F.col("n_active").cast("bigint").alias("n"),
        F.when(same, 1.0).otherwise(0.0).alias("value"))
    history = MD.loss_history(c.spark, model)                        # at most maxIter rows
    before = F.lag("loss").over(Window.orderBy("iteration"))
    rises = F.coalesce((F.col("loss") > F.col("before") + 1e-9).cast("int"), F.lit(0))
    steps = history.select("iteration", "loss", before.alias("before")).agg(
        F.min_by("loss", "iteration").alias("first"), F.max_by("loss", "iteration").alias("last"), F.sum(rises).alias("rises"))
    off = F.abs(F.col("last") - MD.table_loss(scored).scalar())
    losses = steps.select(F.inline(F.array(*[
        F.struct(F.lit("loss").alias("part"), F.lit(key).alias("key"), F.lit(0).cast("bigint").alias("n"),
                 F.round(value.cast("double"), 6).alias("value"))
        for key, value in (("first", F.col("first")), ("last", off), ("rises", F.col("rises")))])))
    return columns.unionByName(scores).unionByName(losses)


def _fit_query(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    c = _mchain(spark, sf_dir)
    train = c._m(c.split.where(F.col("split") == "train"))           # every iteration reads it
    return _fit_rows(c, MD.fit(train, c.p.top_k, estimator), train)


def q_lr_fit_predict(spark, sf_dir):
    """M1 + M4 + M8 + M12: the RDD-API fit on the train part of the split, its
    certificate, the predict set scored."""
    return _fit_query(spark, sf_dir, MD.lbfgs_estimator())


def q_lr_fit_intercept(spark, sf_dir):
    """M1 + M5 + M8 + M12: the ML-API fit (intercept, 1000 iterations), the same rows and the intercept's."""
    return _fit_query(spark, sf_dir, MD.ml_estimator())


QUERIES: dict[str, Query] = {
    "behavior_explode": q_behavior_explode,
    "behavior_items_stripped": q_behavior_items_stripped,
    "item_topk": q_item_topk,
    "active_items_semi": q_active_items_semi,
    "item_index": q_item_index,
    "feature_strings": q_feature_strings,
    "feature_parse_long": q_feature_parse_long,
    "labels_from_users": q_labels_from_users,
    "labels_two_branch_union": q_labels_two_branch_union,
    "labels_from_devices": q_labels_from_devices,
    "label_balance": q_label_balance,
    "decode_attributes": q_decode_attributes,
    "bucket_distribution": q_bucket_distribution,
    "value_counts": q_value_counts,
    "run_date_normalise": q_run_date_normalise,
    "latest_partition_scan": q_latest_partition_scan,
    "latest_partition_catalog": RT.latest_partition_catalog,
    "three_way_label_pred": q_three_way_label_pred,
    "train_set": q_train_set,
    "predict_set": q_predict_set,
    "set_cardinality_report": q_set_cardinality_report,
    "hash_split": q_hash_split,
    "score_linear": q_score_linear,
    "f1_by_threshold": q_f1_by_threshold,
    "best_threshold": q_best_threshold,
    "hard_auc_accuracy": q_hard_auc_accuracy,
    "accuracy_avg": q_accuracy_avg,
    "eval_full_and_part": q_eval_full_and_part,
    "label_agreement": q_label_agreement,
    "agreed_rows": q_agreed_rows,
    "left_only_rows": q_left_only_rows,
    "known_plus_predicted": q_known_plus_predicted,
    "override_merge": q_override_merge,
    "snapshot_changes": q_snapshot_changes,
    "changed_item_share": q_changed_item_share,
    "run_record": q_run_record,
    "validation_run": q_validation_run,
    "partition_overwrite_roundtrip": RT.partition_overwrite_roundtrip,
    "table_overwrite_append_roundtrip": RT.table_overwrite_append_roundtrip,
    "null_format_roundtrip": RT.null_format_roundtrip,
    "publish_results": RT.publish_results,
    "lr_fit_predict": q_lr_fit_predict,
    "lr_fit_intercept": q_lr_fit_intercept,
}
