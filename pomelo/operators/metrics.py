"""Counts, ratios, distributions, threshold curves and evaluation metrics.

Several counts are folded into one conditional aggregate (one job, one pass)
instead of one action per count.  Ratios use ``try_divide`` so x/0 is NULL
(trap #23, deviation: the reference yields Infinity/NaN).

The F1-by-threshold curve (M6) needs a running sum over all distinct scores
in descending order.  A global window would move every distinct score to
one task, so it is computed as a distributed prefix sum: the distinct scores,
kept in the checkpoint folder, are cut at approximate quantiles into ranges of
about ``RANGE_ROWS`` (one number per range reaches the driver), a window runs
inside each range, and the totals of the ranges above are added from a table
with one row per range.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pomelo.session import bounded_broadcast, ensure_checkpoint_dir


# Distinct scores in one range of the F1 prefix sum, about.
RANGE_ROWS = 50_000


def ratio(num: Column, den: Column) -> Column:
    """A3: ``num * 1.0 / den``; NULL when ``den`` is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def class_balance(df: DataFrame, col: str = "label", positive=1, negative=0) -> DataFrame:
    """A1 + A2 + A3 in one pass: n, n_pos, n_neg, ratio = n_pos / n_neg."""
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 count_if(F.col(col) == positive).alias("n_pos"),
                 count_if(F.col(col) == negative).alias("n_neg"))
    return agg.select("n", "n_pos", "n_neg", ratio(F.col("n_pos"), F.col("n_neg")).alias("ratio"))


def group_count(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """``group by col`` with ``count(*)`` (``countByValue``)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """A5: per-value count and its share of the total.

    The total is a scalar subquery over the aggregated rows, so however many
    values the column has, they stay where they were counted."""
    g = group_count(df, col)
    return g.withColumn("share", F.round(ratio(F.col("n"), g.agg(F.sum("n")).scalar()), 6))


def accuracy_avg(df: DataFrame, a: str, b: str) -> Column:
    """``avg((a == b).cast(int))``; NULL pairs are ignored."""
    return F.avg((F.col(a) == F.col(b)).cast("int"))


def hard_metrics(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """M9 + A13 on hard 0/1 predictions: AUC = (1 + TPR - FPR) / 2, accuracy.

    With one threshold the ROC curve is (0,0), (FPR,TPR), (1,1), whose
    trapezoid area is the closed form above (trap #17: not on scores)."""
    p, y = F.col(pred), F.col(label)
    agg = df.agg(count_if((p == 1) & (y == 1)).alias("tp"),
                 count_if((p == 1) & (y == 0)).alias("fp"),
                 count_if(y == 1).alias("pos"),
                 count_if(y == 0).alias("neg"),
                 count_if(p == y).alias("hit"),
                 F.count(F.lit(1)).alias("n"))
    tpr = ratio(F.col("tp"), F.col("pos"))
    fpr = ratio(F.col("fp"), F.col("neg"))
    return agg.select(((F.lit(1.0) + tpr - fpr) / 2).alias("auc"),
                      ratio(F.col("hit"), F.col("n")).alias("accuracy"))


def f1_by_threshold(scored: DataFrame, score: str = "score", label: str = "label",
                    ranges: int | None = None) -> DataFrame:
    """M6: (threshold, tp, pp, f1) for every distinct score.

    At threshold t: tp = #(label 1, score >= t), pp = #(score >= t),
    f1 = 2 tp / (pp + P) with P the number of positives.
    """
    ensure_checkpoint_dir(scored.sparkSession)
    g = (scored.groupBy(F.col(score).alias("threshold"))
         .agg(count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("cnt"))
         .checkpoint(eager=True))
    n_ranges = max(2, ranges or -(-g.count() // RANGE_ROWS))
    # Range boundaries: approximate quantiles of the distinct scores.  Each
    # score finds its range by binary search (Bucketizer, in the JVM); range 0
    # holds the highest scores and equal scores share a range.
    probs = [i / n_ranges for i in range(1, n_ranges)]
    cuts = g.agg(F.percentile_approx("threshold", probs, max(10000, 20 * n_ranges)).alias("b")).first()
    bounds = sorted({float(b) for b in (cuts.b or [0.0])})
    splits = [float("-inf")] + bounds + [float("inf")]
    ranged = (Bucketizer(splits=splits, inputCol="threshold", outputCol="bucket")
              .transform(g)
              .withColumn("rng", (F.lit(len(splits) - 2) - F.col("bucket")).cast("int"))
              .drop("bucket"))
    local = Window.partitionBy("rng").orderBy(F.col("threshold").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranged = (ranged.withColumn("tp_local", F.sum("pos").over(local))
              .withColumn("pp_local", F.sum("cnt").over(local)))
    # one row per range: totals, then exclusive running totals of the ranges above
    tot = ranged.groupBy("rng").agg(F.sum("pos").alias("rpos"), F.sum("cnt").alias("rcnt"))
    above = Window.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offs = tot.select(
        "rng",
        F.coalesce(F.sum("rpos").over(above), F.lit(0)).alias("tp_off"),
        F.coalesce(F.sum("rcnt").over(above), F.lit(0)).alias("pp_off"),
        F.sum("rpos").over(every).alias("positives"))
    out = ranged.join(bounded_broadcast(offs, len(bounds) + 1), "rng")
    tp = (F.col("tp_local") + F.col("tp_off")).cast("bigint")
    pp = (F.col("pp_local") + F.col("pp_off")).cast("bigint")
    return out.select(
        "threshold", tp.alias("tp"), pp.alias("pp"),
        F.try_divide((F.lit(2.0) * tp).cast("double"), (pp + F.col("positives")).cast("double")).alias("f1"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold with the highest F1; ties go to the
    higher threshold (trap #16).  A distributed top-1."""
    return (curve.where(F.col("f1").isNotNull())
            .orderBy(F.col("f1").desc(), F.col("threshold").desc()).limit(1)
            .select("threshold", "f1"))


def agreement(left: DataFrame, right: DataFrame, key: str = "entity_id",
              value: str = "label") -> DataFrame:
    """A16 + J6 + J7: two de-duplicated label sources compared in one full
    outer join and one conditional aggregate."""
    l_ = left.select(key, F.col(value).alias("l"))
    r_ = right.select(key, F.col(value).alias("r"))
    j = l_.join(r_, key, "full_outer")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    agg = j.agg(count_if(F.col("l").isNotNull()).alias("n_left"),
                count_if(F.col("r").isNotNull()).alias("n_right"),
                count_if(both).alias("n_both"),
                count_if(both & (F.col("l") == F.col("r"))).alias("n_match"),
                count_if(both & (F.col("l") != F.col("r"))).alias("n_mismatch"),
                count_if(F.col("r").isNull()).alias("n_left_only"),
                count_if(F.col("l").isNull()).alias("n_right_only"))
    return agg.select("*",
                      F.round(ratio(F.col("n_match"), F.col("n_both")), 6).alias("match_ratio"),
                      F.round(ratio(F.col("n_mismatch"), F.col("n_both")), 6).alias("mismatch_ratio"))


def side_by_side(parts: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """One-row frames placed side by side as one row.

    Each part is (frame with one row, {source column: output name}); the
    output columns follow the given order.  The frames are stacked as
    (name, value) rows and pivoted by one conditional aggregate, so there is
    no cross join and each frame's aggregate is computed once."""
    stacked, names = None, []
    for df, cols in parts:
        pairs = [F.struct(F.lit(out).alias("metric"), df[src].cast("double").alias("value"))
                 for src, out in cols.items()]
        part = df.select(F.explode(F.array(*pairs)).alias("m")).select("m.metric", "m.value")
        stacked = part if stacked is None else stacked.unionByName(part)
        names += list(cols.values())
    return stacked.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
