"""Binary logistic regression: fit (M4, M5), score (M8), loss history.

Fitting uses Spark ML (L-BFGS, distributed gradient aggregation).  Scoring
has two equal forms:

* ``model.transform`` on assembled sparse vectors (no join);
* the long form: feature rows left-joined to the weight table, summed per
  entity, sigmoid — expressible in SQL, used by the checks.

Prediction is class 1 when the score is strictly above the threshold
(trap #15: the threshold search counts scores >= t, prediction uses > t).
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.operators.features import assemble_vectors
from pomelo.operators.metrics import best_threshold, f1_by_threshold
from pomelo.operators.tokens import index_values
from pomelo.session import bounded_broadcast


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_with_weights(features: DataFrame, weights: DataFrame,
                       threshold: float | Column, intercept: float = 0.0,
                       margin_digits: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """M8, long form: (entity_id, margin, score, prediction) for every entity.

    Entities whose items carry no weight score at the intercept.  The weight
    table is counted and broadcast if small.  ``margin_digits`` rounds the
    margin, so that equal feature sets give equal scores whatever the order
    of the sum (the checks against SQL need it)."""
    # ``keep``: per-entity passthrough columns (one value per entity)
    rows = features.select("entity_id", *keep, "feature")
    w = bounded_broadcast(weights.select(F.col("column_index").cast("int").alias("column_index"), "weight"))
    long = rows.select("entity_id", *keep, F.explode_outer(index_values("feature")).alias("p"))
    z = (long.select("entity_id", *keep, F.col("p.i").alias("column_index"), F.col("p.v").alias("value"))
         .join(w, "column_index", "left")
         .groupBy("entity_id", *keep)
         .agg(F.coalesce(F.sum(F.col("weight") * F.col("value")), F.lit(0.0)).alias("z")))
    margin = F.col("z") + F.lit(intercept)
    if margin_digits is not None:
        margin = F.round(margin, margin_digits)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (z.select("entity_id", *keep, margin.alias("margin"))
            .withColumn("score", sigmoid(F.col("margin")))
            .withColumn("prediction", F.when(F.col("score") > t, F.lit(1)).otherwise(F.lit(0))))


def lbfgs_estimator(max_iter: int = 100, tol: float = 1e-4) -> LogisticRegression:
    """M4: the RDD-API defaults (no intercept, 100 iterations, no regularisation)."""
    return LogisticRegression(featuresCol="features", labelCol="label", family="binomial",
                              fitIntercept=False, maxIter=max_iter, regParam=0.0, tol=tol,
                              standardization=True)


def ml_estimator(max_iter: int = 1000) -> LogisticRegression:
    """M5: the ML-API variant (intercept on, library defaults otherwise)."""
    return LogisticRegression(featuresCol="features", labelCol="label", family="binomial",
                              maxIter=max_iter)


def fit(train: DataFrame, k: int, estimator: LogisticRegression) -> LogisticRegressionModel:
    """Fit on (entity_id, label, feature) rows; the vectors are built where the rows are."""
    data = assemble_vectors(train.select("label", "feature"), k).select("label", "features")
    return estimator.fit(data)


def score_with_model(model: LogisticRegressionModel, df: DataFrame, k: int,
                     threshold: float | Column) -> DataFrame:
    """M8 via ``transform``: (entity_id, label, score, prediction)."""
    vec = assemble_vectors(df.select("entity_id", "label", "feature"), k)
    out = model.transform(vec)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    score = vector_to_array("probability").getItem(1)
    return out.select("entity_id", "label", score.alias("score"),
                      F.when(score > t, F.lit(1)).otherwise(F.lit(0)).alias("prediction"))


def best_threshold_on_training(model: LogisticRegressionModel, train: DataFrame, k: int) -> DataFrame:
    """M7 the way the ML-API variant picks it: the threshold with the best
    F-measure on the *training* scores, every distinct score a candidate (the
    model's own summary thins its curve out beyond about 1,000), ties to the
    higher threshold.  (threshold, f1)"""
    return best_threshold(f1_by_threshold(score_with_model(model, train, k, 0.5)))


# Column number of the intercept in ``optimality``.
INTERCEPT = -1


def training_scores(model: LogisticRegressionModel, train: DataFrame, k: int) -> DataFrame:
    """(label, feature, margin, score) of the training rows."""
    return model.transform(assemble_vectors(train.select("label", "feature"), k)).select(
        "label", "feature", vector_to_array("rawPrediction").getItem(1).alias("margin"),
        vector_to_array("probability").getItem(1).alias("score"))


def optimality(scored: DataFrame, intercept: bool) -> DataFrame:
    """M4 / M5: the certificate that a fit is one, computed over the table.

    The mean log loss is convex, so a model without penalty is optimal exactly
    where its gradient vanishes: for every column the scores add up to what
    the labels add up to.  Per column of the scored training rows (``INTERCEPT`` for
    the intercept, if the model has one): (column_index, n_rows, label_sum =
    sum(label * x), score_sum = sum(score * x), gradient = (score_sum -
    label_sum) / rows).  One pass, one shuffle of at most K sums per task."""
    terms = index_values("feature")
    if intercept:
        terms = F.concat(F.array(F.struct(F.lit(INTERCEPT).alias("i"), F.lit(1.0).alias("v"))), terms)
    sums = scored.select("label", "score", F.explode(terms).alias("p")).groupBy(F.col("p.i").alias("column_index")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("label") * F.col("p.v")).alias("label_sum"),
        F.sum(F.col("score") * F.col("p.v")).alias("score_sum"))
    n = scored.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    return sums.withColumn("gradient", (F.col("score_sum") - F.col("label_sum")) / n)


def table_loss(scored: DataFrame) -> DataFrame:
    """(loss): the mean log loss over the scored training rows."""
    # log(1 + exp(margin)) - label * margin without overflow
    return scored.agg(F.avg(F.greatest("margin", F.lit(0.0)) + F.log1p(F.exp(-F.abs("margin")))
                            - F.col("label") * F.col("margin")).alias("loss"))


def weight_table(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """Export the fitted coefficients as (column_index, weight) rows.

    The coefficient vector is K doubles held by the driver-side model object
    already; entries of zero are left out, and scoring counts them as such."""
    coef = model.coefficients.toArray()
    rows = [(int(i), float(v)) for i, v in enumerate(coef) if v != 0.0]
    return spark.createDataFrame(rows, "column_index int, weight double")


def loss_history(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """(iteration, loss) from the training summary (<= maxIter rows)."""
    hist = list(model.summary.objectiveHistory)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)],
                                 "iteration int, loss double")
