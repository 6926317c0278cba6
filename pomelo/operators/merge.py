"""Unions and merges of predictions with label sources.

The override merge (J8 + J7 + U3 in the reference: left outer, anti, union)
is one full outer join: the trusted value wins where present.  Trusted rows
with a NULL class are dropped on read and the trusted source is reduced to
one row per entity first (trap #19, deviation: no failure), by label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.functions import recode as R


def known_plus_predicted(train: DataFrame, scored: DataFrame, classes: P.ClassNames) -> DataFrame:
    """M10 + U2 + P15 + P16: known training labels as classes, union all the
    model classes of the predict set -> (entity_id, class_name)."""
    known = train.select("entity_id", R.label_to_class("label", classes).alias("class_name"))
    pred = scored.select("entity_id", R.label_to_class("prediction", classes).alias("class_name"))
    return known.unionByName(pred)


def trusted_one_per_key(trusted: DataFrame, classes: P.ClassNames, key: str = "entity_id",
                        value: str = "class_name") -> DataFrame:
    """A9 on the trusted source: (key, class_name), NULL dropped, of contradicting rows the negative class.

    The least 0/1 label is taken, not the least text: a number combines in a
    hash aggregate, a text would sort the whole source by key first.  A text
    that names neither class is no label and dropped like NULL."""
    named = trusted.where(F.col(value).isin(classes.positive, classes.negative))
    least = named.groupBy(key).agg(F.min(R.class_to_label(value, classes.positive)).alias("label"))
    return least.select(key, R.label_to_class("label", classes).alias(value))


def override_merge(pred: DataFrame, trusted: DataFrame, classes: P.ClassNames, key: str = "entity_id") -> DataFrame:
    """J8 + J10 + U3: (entity_id, class_name), trusted class wins."""
    t = trusted_one_per_key(trusted, classes, key).select(key, F.col("class_name").alias("t"))
    p = pred.select(key, F.col("class_name").alias("p"))
    return p.join(t, key, "full_outer").select(key, F.coalesce("t", "p").alias("class_name"))


def agreed_rows(left: DataFrame, right: DataFrame, key: str = "entity_id") -> DataFrame:
    """J6 + F10: keys in both sources with equal labels -> (entity_id, label)."""
    r = right.select(key, F.col("label").alias("r"))
    return left.join(r, key).where(F.col("label") == F.col("r")).select(key, "label")


def left_only_rows(left: DataFrame, right: DataFrame, classes: P.ClassNames,
                   key: str = "entity_id") -> DataFrame:
    """J7 + P15: keys only in ``left`` -> (entity_id, class_name)."""
    return (left.join(right.select(key), key, "left_anti")
            .select(key, R.label_to_class("label", classes).alias("class_name")))
