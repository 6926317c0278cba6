"""Lazily wired DataFrames of the whole daily run over one input set.

``Chain`` connects the operators the way the four batch jobs do (feature
build -> label build -> train/score/merge/publish -> validation).  Every
attribute is a lazy DataFrame; nothing runs until an action.  The driver
queries pick single attributes, the jobs in ``plans.jobs`` write several.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.operators import compare as CP
from pomelo.operators import features as FE
from pomelo.operators import labels as LB
from pomelo.operators import merge as MG
from pomelo.operators import metrics as MT
from pomelo.operators import model as MD
from pomelo.operators import sets as ST
from pomelo.operators import tokens as TK
from pomelo.session import ensure_checkpoint_dir
from pomelo.sources import fixtures as FX
from pomelo.sources import tables as TB


# The fixed-weight run rounds margins, so that SQL finds the same distinct scores.
MARGIN_DIGITS = 6


class Chain:
    """Lazy plan of a daily run.

    ``materialize=True`` checkpoints the nodes that several later steps read
    (the top-K items, their distinct entity pairs, the item index, the tagged
    train/predict set, the scored validation set, the prediction set, the
    merged set) into the shared checkpoint
    folder — the points where the reference writes a table or caches.
    Multi-output plans (run record, publishing) then read each of them once
    instead of recomputing the whole run per branch, and a lost executor
    restarts from the checkpoint.
    """

    def __init__(self, spark: SparkSession, inputs: FX.Inputs, params: P.RunParams,
                 materialize: bool = False, given: dict[str, DataFrame] | None = None):
        """``given``: steps that another job has written, by attribute name
        (``features``, ``item_index``, ``set_labels``, ``truth_part``)."""
        self.spark = spark
        self.inp = inputs
        self.p = params
        self.materialize = materialize
        # features built here are grouped by entity; a table that was read has to be counted
        self.one_row_an_entity = "features" not in (given or {})
        self.__dict__.update(given or {})

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      params: P.RunParams = P.QUERY_PARAMS, materialize: bool = False) -> "Chain":
        return cls(spark, FX.load_inputs(spark, sf_dir), params, materialize)

    def _m(self, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    # --- feature build (job 3.1) ---------------------------------------------
    @cached_property
    def behavior_day(self) -> DataFrame:
        return TB.day_partition(self.inp.behavior, self.p.run_date)

    @cached_property
    def tokens(self) -> DataFrame:
        return TK.explode_behavior(self.behavior_day)

    @cached_property
    def behavior_items(self) -> DataFrame:
        return TK.explode_behavior_items(self.behavior_day)

    @cached_property
    def items(self) -> DataFrame:
        return FE.item_codes(TB.day_partition(self.inp.item_dim, self.p.run_date), self.p.code_prefix)

    @cached_property
    def topk(self) -> DataFrame:
        return self._m(FE.top_k_items(self.items, self.p.top_k))

    @cached_property
    def pairs(self) -> DataFrame:
        """Kept: the index and, in a plan of its own, the features read them; the behaviour is exploded once."""
        return self._m(FE.topk_pairs(self.tokens, self.topk, self.p.top_k))

    @cached_property
    def active(self) -> DataFrame:
        return FE.active_items(self.topk, self.pairs, self.p.top_k)

    @cached_property
    def item_index(self) -> DataFrame:
        return self._m(FE.number_items(self.active))

    @cached_property
    def features(self) -> DataFrame:
        return FE.feature_rows(self.pairs, self.item_index, self.p.top_k)

    @cached_property
    def feature_long(self) -> DataFrame:
        return TK.parse_feature_long(self.features)

    # --- label build (job 3.4) -----------------------------------------------
    @cached_property
    def labels_raw(self) -> DataFrame:
        """User x device labels before de-duplication (the appended twin table)."""
        return LB.user_device_labels(self.inp.users, self.inp.device_user, self.p.label_date)

    @cached_property
    def known_labels(self) -> DataFrame:
        return LB.first_per_key(self.labels_raw)

    @cached_property
    def two_branch(self) -> DataFrame:
        """The twin of the known labels, by a device table of its own."""
        return LB.two_branch_labels(self.inp.users, self.inp.device_user_twin, self.p.agreement_date)

    @cached_property
    def decoded(self) -> DataFrame:
        return LB.decode_attributes(self.inp.coded_ids, self.p.reference_year, self.p.classes)

    @cached_property
    def device_labels(self) -> DataFrame:
        return LB.labels_from_devices(self.decoded, self.inp.device_user, self.p.agreement_date,
                                      self.p.classes)

    @cached_property
    def branch_labels(self) -> DataFrame:
        return LB.first_per_key(self.two_branch)

    # --- train / score / merge (job 3.2) -------------------------------------
    @cached_property
    def set_labels(self) -> DataFrame:
        """Label rows entering J9.  The registered queries use the rows before
        de-duplication (FIXTURES.md) so the cardinality rule is exercised; the
        training job reads the written known-label table instead."""
        return self.labels_raw

    @cached_property
    def tag_counts(self) -> DataFrame:
        return ST.tag_counts(self.set_labels, self.features)

    @cached_property
    def tagged(self) -> DataFrame:
        if self.one_row_an_entity:
            return self._m(ST.tagged_sets_of_unique(self.set_labels, self.features))
        return self._m(ST.tagged_sets(self.tag_counts, self.features))

    @cached_property
    def train(self) -> DataFrame:
        return ST.train_rows(self.tagged)

    @cached_property
    def predict(self) -> DataFrame:
        return ST.predict_rows(self.tagged)

    @cached_property
    def split(self) -> DataFrame:
        return ST.hash_split(self.train, self.p.split_seed, self.p.train_fraction)

    @cached_property
    def weights(self) -> DataFrame:
        return FX.fixed_weights(self.item_index)

    @cached_property
    def valid_scored(self) -> DataFrame:
        valid = self.split.where(F.col("split") == "valid")
        return self._m(MD.score_with_weights(valid, self.weights, self.p.threshold,
                                             margin_digits=MARGIN_DIGITS, keep=("label",)))

    @cached_property
    def f1_curve(self) -> DataFrame:
        return MT.f1_by_threshold(self.valid_scored)

    @cached_property
    def best(self) -> DataFrame:
        """One row, kept: several steps ask for it."""
        return self._m(MT.best_threshold(self.f1_curve))

    @cached_property
    def chosen_threshold(self):
        """M7: best threshold (scalar subquery) or the default by flag."""
        if self.p.select_threshold:
            return self.best.select("threshold").scalar()
        return F.lit(self.p.threshold)

    @cached_property
    def train_metrics(self) -> DataFrame:
        """Default and selected threshold with hard AUC and accuracy (6 values)."""
        at_default = MT.hard_metrics(self.valid_scored)
        best_pred = self.valid_scored.withColumn(
            "prediction", F.when(F.col("score") > self.best.select("threshold").scalar(), 1).otherwise(0))
        at_best = MT.hard_metrics(best_pred)
        row = MT.side_by_side([
            (at_default, {"auc": "auc_default", "accuracy": "accuracy_default"}),
            (self.best, {"threshold": "select_threshold"}),
            (at_best, {"auc": "auc_select", "accuracy": "accuracy_select"}),
        ])
        return row.select(F.lit(float(self.p.threshold)).alias("default_threshold"),
                          "auc_default", "accuracy_default", "select_threshold",
                          "auc_select", "accuracy_select")

    @cached_property
    def predict_scored(self) -> DataFrame:
        return MD.score_with_weights(self.predict, self.weights, self.chosen_threshold,
                                     margin_digits=MARGIN_DIGITS)

    @cached_property
    def known_plus_predicted(self) -> DataFrame:
        return self._m(MG.known_plus_predicted(self.train, self.predict_scored, self.p.classes))

    @cached_property
    def truth_latest(self) -> DataFrame:
        """S3 + S4: newest partition of the trusted source (NULL classes kept);
        by the partition names (P22) where it is a partitioned catalog table."""
        latest = (TB.latest_partition_value_from_catalog(self.spark, self.inp.truth_table)
                  if self.inp.truth_table else None)
        return TB.latest_partition(self.inp.truth_full, latest=latest).select("entity_id", "class_name")

    @cached_property
    def truth_part(self) -> DataFrame:
        """Trusted entities absent from the known labels, one class each.  The
        jobs read the table that the agreement job has written instead."""
        return (MG.trusted_one_per_key(self.truth_latest, self.p.classes)
                .join(self.known_labels.select("entity_id"), "entity_id", "left_anti"))

    def accuracy_against(self, truth: DataFrame, pred: DataFrame) -> DataFrame:
        """J11 + A13 (avg form): (accuracy, n) over truth x predictions."""
        j = truth.select("entity_id", F.col("class_name").alias("t")).join(
            pred.select("entity_id", F.col("class_name").alias("p")), "entity_id")
        return j.agg(MT.accuracy_avg(j, "t", "p").alias("accuracy"), F.count(F.lit(1)).alias("n"))

    @cached_property
    def eval_metrics(self) -> DataFrame:
        full = self.accuracy_against(self.truth_latest, self.known_plus_predicted)
        part = self.accuracy_against(self.truth_part, self.known_plus_predicted)
        return MT.side_by_side([(full, {"accuracy": "accuracy_full"}),
                                (part, {"accuracy": "accuracy_part"})])

    @cached_property
    def merged(self) -> DataFrame:
        return self._m(MG.override_merge(self.known_plus_predicted, self.truth_latest, self.p.classes))

    def class_counts(self, df: DataFrame) -> DataFrame:
        c = self.p.classes
        return MT.class_balance(df, "class_name", c.positive, c.negative)

    @cached_property
    def run_record(self) -> DataFrame:
        """The 14-value run record, one row."""
        tm, pc, mc, ev = (self.train_metrics, self.class_counts(self.known_plus_predicted),
                          self.class_counts(self.merged), self.eval_metrics)
        return MT.side_by_side([
            (tm, {c: c for c in tm.columns}),
            (pc, {"n_pos": "pred_pos", "n_neg": "pred_neg", "ratio": "pred_ratio"}),
            (mc, {"n_pos": "merged_pos", "n_neg": "merged_neg", "ratio": "merged_ratio"}),
            (ev, {"accuracy_full": "accuracy_full", "accuracy_part": "accuracy_part"}),
        ])

    # --- validation and comparison (job 3.3) ---------------------------------
    @cached_property
    def stored_latest(self) -> DataFrame:
        """The stored predictions of the newest snapshot, distinct (entity,
        class) rows so copies cannot multiply the truth join."""
        return TB.distinct_per_key(TB.day_partition(self.inp.predictions, self.p.snapshot_new),
                                   "entity_id", "class_name")

    @cached_property
    def snapshot_changes(self) -> DataFrame:
        return CP.snapshot_changes(self.inp.predictions, self.p.snapshot_new, self.p.snapshot_old)

    def changed_item_share(self, item_list: DataFrame) -> DataFrame:
        """J13 + M14: each snapshot with the behaviour of its own day."""
        new, old = (TK.explode_behavior_items(TB.day_partition(self.inp.behavior, day))
                    for day in (self.p.snapshot_new, self.p.snapshot_old))
        return CP.changed_item_share(self.snapshot_changes, new, old, item_list, self.p.classes.negative)
