"""The batch jobs of a daily run, each one DataFrame plan plus its writes.

=====================  =========================================================
job                    reads -> writes
=====================  =========================================================
``feature_build``      item dimension + behaviour day -> item table day,
                       feature table day (K1 + K4)
``label_build``        users x devices -> known-label table (K2 + K5)
``decode_build``       coded ids -> decoded attribute table (K2 + K5) and the
                       bucket distribution
``agreement``          two label sources -> report row; the known-label twin is
                       filled with the two branches (K5), agreed rows it lacks
                       are appended (K6), left-only rows replace the partial
                       truth table (K5)
``train_publish``      the written labels, features and partial truth -> model,
                       threshold, predictions, evaluation, override merge, run
                       record -> K9, staged and switched together
``validation``         latest predictions vs truth and the written partial truth
                       -> accuracy row of the run date (K6)
``drift``              two snapshots x the behaviour of their days x a list of
                       items -> share row
=====================  =========================================================

Every job notes in the job log what it wrote (``plans.provenance``); a job
whose inputs another job writes fails where that has not run for the run date.

Lineage: the train/validation rows are written with ``checkpoint()`` into the
shared checkpoint folder before the iterative fit, so a lost executor during
L-BFGS recomputes from that copy, not from the raw tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.functions.dates import normalise_run_date_py
from pomelo.operators import features as FE
from pomelo.operators import merge as MG
from pomelo.operators import metrics as MT
from pomelo.operators import model as MD
from pomelo.plans import provenance as PV
from pomelo.plans.chain import Chain
from pomelo.sinks import publish as PB
from pomelo.sinks import tables as SK
from pomelo.sources import fixtures as FX
from pomelo.sources import tables as TB


@dataclass(frozen=True)
class TableNames:
    """Output tables of a run (catalog names) and their shared locations."""

    root: str
    items: str = "pomelo_items"
    features: str = "pomelo_features"
    known_labels: str = "pomelo_known_labels"
    known_labels_twin: str = "pomelo_known_labels_twin"
    decoded: str = "pomelo_decoded"
    truth_part: str = "pomelo_truth_part"
    predictions: str = "pomelo_predictions"
    latest: str = "pomelo_predictions_latest"
    metrics: str = "pomelo_run_metrics"
    accuracy: str = "pomelo_accuracy"
    log: str = "pomelo_job_log"

    @property
    def published(self) -> PB.Published:
        return PB.Published(self.root, self.predictions, self.latest, self.metrics)

    def loc(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


class FittedChain(Chain):
    """The daily run with a fitted model instead of fixed weights."""

    def __init__(self, spark: SparkSession, inputs: FX.Inputs, params: P.RunParams,
                 estimator: LogisticRegression | None = None, materialize: bool = True,
                 threshold_source: str = "validation", given: dict[str, DataFrame] | None = None):
        super().__init__(spark, inputs, params, materialize, given)
        self.estimator = estimator or MD.lbfgs_estimator()
        if threshold_source not in ("validation", "training"):
            raise ValueError(threshold_source)
        self.threshold_source = threshold_source

    def with_given(self, **given: DataFrame) -> "FittedChain":
        """A new run over the same inputs that takes these steps as they are."""
        return FittedChain(self.spark, self.inp, self.p, self.estimator, self.materialize, self.threshold_source, given)

    @classmethod
    def ml_variant(cls, spark: SparkSession, inputs: FX.Inputs, params: P.RunParams) -> "FittedChain":
        """M5: intercept, 1000 iterations, threshold from the training scores."""
        return cls(spark, inputs, params, MD.ml_estimator(), threshold_source="training")

    @cached_property
    def best(self) -> DataFrame:
        """Best-F1 threshold on the validation scores (default), or on the
        training scores as the ML-API variant does."""
        if self.threshold_source == "training":
            train = self.split.where(F.col("split") == "train")
            return self._m(MD.best_threshold_on_training(self.model, train, self.p.top_k))
        return super().best

    @cached_property
    def model(self) -> LogisticRegressionModel:
        return MD.fit(self.split.where(F.col("split") == "train"), self.p.top_k, self.estimator)

    @cached_property
    def valid_scored(self) -> DataFrame:
        valid = self.split.where(F.col("split") == "valid")
        return self._m(MD.score_with_model(self.model, valid, self.p.top_k, self.p.threshold))

    @cached_property
    def predict_scored(self) -> DataFrame:
        return MD.score_with_model(self.model, self.predict, self.p.top_k, self.chosen_threshold)


def feature_build(spark: SparkSession, chain: Chain, t: TableNames) -> None:
    """Job 3.1: item table and feature table for the run day."""
    date = normalise_run_date_py(chain.p.run_date)
    SK.create_partitioned_table(spark, t.items, "code STRING, name STRING, column_index BIGINT",
                                t.loc(t.items))
    SK.create_partitioned_table(spark, t.features, "entity_id STRING, feature STRING", t.loc(t.features),
                                bucket_by="entity_id", buckets=chain.p.feature_buckets)
    SK.overwrite_partition(spark, FE.dimension_rows(chain.item_index), t.items, date)
    SK.overwrite_partition(spark, chain.features, t.features, date,
                           bucket_by="entity_id", buckets=chain.p.feature_buckets)
    for table in (t.items, t.features):
        _note(spark, t, date, "feature", table, spark.table(table).where(F.col("stat_date") == date))


def _note(spark: SparkSession, t: TableNames, date: str, job: str, table: str, rows: DataFrame,
          derived: tuple[str, ...] = ()) -> None:
    PV.note(spark, t.log, t.loc(t.log), date, job, table, rows, derived)


def written_features(spark: SparkSession, chain: Chain, t: TableNames) -> dict[str, DataFrame]:
    """The tables the feature job wrote (as the reference's training job reads
    them): the bucketed feature table and the item table.  The item index is
    bounded by K rows; its ``item_code`` is rebuilt with the prefix."""
    date = normalise_run_date_py(chain.p.run_date)
    feats = spark.table(t.features).where(F.col("stat_date") == date).select("entity_id", "feature")
    items = spark.table(t.items).where(F.col("stat_date") == date)
    index = items.select(F.concat(F.lit(chain.p.code_prefix), F.col("code")).alias("item_code"),
                         F.col("name").alias("item_name"), "column_index")
    return {"features": feats, "item_index": index}


def label_build(spark: SparkSession, chain: Chain, t: TableNames) -> DataFrame:
    """Job 3.4: known labels, overwritten; returns the class balance row."""
    SK.create_table(spark, t.known_labels, "entity_id STRING, label INT", t.loc(t.known_labels))
    SK.overwrite_table(spark, chain.known_labels, t.known_labels)
    _note(spark, t, normalise_run_date_py(chain.p.run_date), "label", t.known_labels, spark.table(t.known_labels))
    return MT.class_balance(spark.table(t.known_labels))


def decode_build(spark: SparkSession, chain: Chain, t: TableNames) -> DataFrame:
    """Decoded attribute table; returns the bucket distribution."""
    SK.create_table(spark, t.decoded, "user_id BIGINT, age_range STRING, class_name STRING",
                    t.loc(t.decoded))
    SK.overwrite_table(spark, chain.decoded.select("user_id", "age_range", "class_name"), t.decoded)
    _note(spark, t, normalise_run_date_py(chain.p.run_date), "decode", t.decoded, spark.table(t.decoded))
    return MT.distribution(spark.table(t.decoded), "age_range")


def agreement(spark: SparkSession, chain: Chain, t: TableNames) -> DataFrame:
    """Two-source agreement: report, fill the twin, append agreed rows, replace left-only.

    The twin first gets the rows of both branches, copies counted once; then
    the agreed rows that it does not hold yet.  A second run of the day gives
    the same table."""
    left, right = chain.device_labels, chain.branch_labels
    report = MT.agreement(left, right)
    SK.create_table(spark, t.known_labels_twin, "entity_id STRING, label INT", t.loc(t.known_labels_twin))
    SK.create_table(spark, t.truth_part, "entity_id STRING, class_name STRING", t.loc(t.truth_part))
    SK.overwrite_table(spark, chain.two_branch.distinct(), t.known_labels_twin)
    held = spark.table(t.known_labels_twin)
    SK.append(spark, MG.agreed_rows(left, right).join(held, ["entity_id", "label"], "left_anti"), t.known_labels_twin)
    SK.overwrite_table(spark, MG.left_only_rows(left, right, chain.p.classes), t.truth_part)
    for table in (t.known_labels_twin, t.truth_part):
        _note(spark, t, normalise_run_date_py(chain.p.run_date), "agreement", table, spark.table(table))
    return report


def train_publish(spark: SparkSession, chain: FittedChain, t: TableNames, derive_missing: bool = False) -> DataFrame:
    """Job 3.2: fit/score/evaluate/merge and the three sinks; returns the record.

    Reads the feature and item tables, the known labels and the partial truth
    that the other jobs have written for the run date, and fails where one is
    missing.  With ``derive_missing`` the missing ones are derived from the
    raw inputs: label rows before de-duplication, and as partial truth the
    trusted entities without a known label."""
    date = normalise_run_date_py(chain.p.run_date)
    given, derived = {}, []

    def take(job: str, tables: tuple[str, ...], steps) -> None:
        if all([PV.require(spark, t.log, date, job, x, derive_missing) for x in tables]):
            given.update(steps())
        else:
            derived.extend(tables)

    take("feature", (t.features, t.items), lambda: written_features(spark, chain, t))
    take("label", (t.known_labels,), lambda: {"set_labels": spark.table(t.known_labels)})
    take("agreement", (t.truth_part,), lambda: {"truth_part": spark.table(t.truth_part)})
    chain = chain.with_given(**given)
    record = chain.run_record
    PB.create(spark, t.published, "entity_id STRING, class_name STRING", ", ".join(f"{c} DOUBLE" for c in record.columns))
    PB.publish(spark, chain.merged, record, date, t.published)
    _note(spark, t, date, "train", t.latest, spark.table(t.latest), tuple(derived))
    return spark.table(t.metrics).where(F.col("stat_date") == date)


def validation(spark: SparkSession, chain: FittedChain, t: TableNames, derive_missing: bool = False) -> DataFrame:
    """Job 3.3: latest predictions vs full and partial truth, one row per run date."""
    date = normalise_run_date_py(chain.p.run_date)
    PV.require(spark, t.log, date, "train", t.latest, False)
    derived = ()
    if PV.require(spark, t.log, date, "agreement", t.truth_part, derive_missing):
        chain = chain.with_given(truth_part=spark.table(t.truth_part))
    else:
        derived = (t.truth_part,)
    latest = spark.table(t.latest)
    full = chain.accuracy_against(chain.truth_latest, latest)
    part = chain.accuracy_against(chain.truth_part, latest)
    row = MT.side_by_side([(full, {"accuracy": "accuracy_full"}),
                           (part, {"accuracy": "accuracy_part"})])
    SK.create_table(spark, t.accuracy, "accuracy_full DOUBLE, accuracy_part DOUBLE, date STRING",
                    t.loc(t.accuracy), partitioned_by=("date",))
    SK.append_day(spark, row, t.accuracy, date, "date")
    _note(spark, t, date, "validation", t.accuracy, spark.table(t.accuracy).where(F.col("date") == date), derived)
    return spark.table(t.accuracy).select("date", "accuracy_full", "accuracy_part")


def drift(spark: SparkSession, chain: Chain, t: TableNames, items: list[str]) -> DataFrame:
    """How many entities whose class changed hold a listed item, per snapshot."""
    return chain.changed_item_share(TB.literal_frame(spark, [(i,) for i in items], "item_id string"))
