"""Train / predict set building (J9, M2) and the train/validation split (M3).

J9 in the reference unions tagged label rows and feature rows and reduces by
key, summing the tags and joining the strings.  Here only numbers are reduced:
how many label and feature rows an entity has, and the sum of its labels, in
hash aggregates with map-side combine (a hot entity collapses there) and one
full outer join of the two.  The feature string is fetched afterwards, for
entities that have exactly one: those counts are the build side of a hash
join, and the feature rows stream past, neither sorted nor aggregated, and
on a feature table bucketed by entity not shuffled either.  The build side of
a task are the counts of its own entities, unique keys of about 100 bytes.

The cardinality rule (trap #12):

  train   <=> exactly one label row and one feature row, >= 1 valid index
  predict <=> no label row and one feature row, >= 1 valid index
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo.operators.metrics import count_if
from pomelo.operators.tokens import active_index_count


def label_counts(labels: DataFrame) -> DataFrame:
    """(entity_id, n_label, label): how many label rows an entity has, and their sum."""
    return (labels.where(F.col("entity_id").isNotNull() & F.col("label").isNotNull())
            .groupBy("entity_id")
            .agg(F.count(F.lit(1)).alias("n_label"), F.sum(F.col("label").cast("double")).alias("label")))


def tag_counts(labels: DataFrame, features: DataFrame) -> DataFrame:
    """J9 + A10 + U1: (entity_id, n_label, label, n_feature) of every entity of either side."""
    lab = label_counts(labels)
    feat = (features.where(F.col("entity_id").isNotNull())
            .groupBy("entity_id")
            .agg(F.count(F.lit(1)).alias("n_feature")))
    j = lab.hint("shuffle_hash").join(feat, "entity_id", "full_outer")
    return j.select(
        "entity_id",
        F.coalesce("n_label", F.lit(0)).alias("n_label"),
        F.coalesce("label", F.lit(0.0)).alias("label"),
        F.coalesce("n_feature", F.lit(0)).alias("n_feature"))


def tagged_sets(counts: DataFrame, features: DataFrame) -> DataFrame:
    """(entity_id, n_label, label, feature, n_active) of the entities with exactly one feature row."""
    one = counts.where(F.col("n_feature") == 1).select("entity_id", "n_label", "label").hint("shuffle_hash")
    text = F.coalesce("feature", F.lit(""))
    return (features.select("entity_id", text.alias("feature"), active_index_count("feature").alias("n_active"))
            .join(one, "entity_id").select("entity_id", "n_label", "label", "feature", "n_active"))


def tagged_sets_of_unique(labels: DataFrame, features: DataFrame) -> DataFrame:
    """``tagged_sets`` where each entity is known to have one feature row: no counting, one join."""
    lab = label_counts(labels).hint("shuffle_hash")
    text = F.coalesce("feature", F.lit(""))
    return (features.where(F.col("entity_id").isNotNull())
            .select("entity_id", text.alias("feature"), active_index_count("feature").alias("n_active"))
            .join(lab, "entity_id", "left")
            .select("entity_id", F.coalesce("n_label", F.lit(0)).alias("n_label"), F.coalesce("label", F.lit(0.0)).alias("label"),
                    "feature", "n_active"))


def train_rows(tagged: DataFrame) -> DataFrame:
    """M2 + F6 + F7 + F8: (entity_id, label, feature, n_active) for training."""
    return (tagged.where((F.col("n_label") == 1) & (F.col("n_active") > 0))
            .select("entity_id", "label", "feature", "n_active"))


def predict_rows(tagged: DataFrame) -> DataFrame:
    """M2: (entity_id, label = 0.0, feature, n_active) to be scored."""
    return (tagged.where((F.col("n_label") == 0) & (F.col("n_active") > 0))
            .select("entity_id", "label", "feature", "n_active"))


def cardinality_report(counts: DataFrame, tagged: DataFrame) -> DataFrame:
    """How many entities fall in each class of the cardinality rule (one row)."""
    nl, nf, na = F.col("n_label"), F.col("n_feature"), F.col("n_active")
    # entities with one feature row come from ``tagged``, which knows the string; the others have no use for it
    rest = counts.where(nf != 1).withColumn("n_active", F.lit(0))
    ones = tagged.select("entity_id", "n_label", "label", F.lit(1).cast("long").alias("n_feature"), "n_active")
    return rest.unionByName(ones).agg(
        count_if((nl == 1) & (nf == 1) & (na > 0)).alias("n_train"),
        count_if((nl == 0) & (nf == 1) & (na > 0)).alias("n_predict"),
        count_if(nl >= 2).alias("n_multi_label"),
        count_if(nf >= 2).alias("n_multi_feature"),
        count_if((nl >= 1) & (nf == 0)).alias("n_label_no_feature"),
        count_if((nl <= 1) & (nf == 1) & (na == 0)).alias("n_empty_feature"))


def hash_fraction(key: str, seed: int):
    """Stable number in [0, 1) of a key: the first 32 bits of md5(key '#' seed).

    Unlike ``randomSplit`` it does not depend on partition layout, so a
    recomputed task (lost executor) puts every row in the same side."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(key), F.lit(f"#{seed}"))), 1, 8), 16, 10).cast("bigint")
    return h / F.lit(float(1 << 32))


def hash_split(df: DataFrame, seed: int, train_fraction: float, key: str = "entity_id") -> DataFrame:
    """M3 (hash form): adds ``split`` = 'train' / 'valid'."""
    return df.withColumn("split", F.when(hash_fraction(key, seed) < train_fraction, F.lit("train"))
                         .otherwise(F.lit("valid")))


def random_split(df: DataFrame, seed: int, train_fraction: float) -> tuple[DataFrame, DataFrame]:
    """M3 as the reference's DataFrame variant does it (``randomSplit``)."""
    a, b = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return a, b
