"""Snapshot comparison.

M14 asks, per snapshot, how many of the entities whose class changed (and
that hold a given class on that snapshot) have a listed item.  The item list
is a parameter (S6), counted before it is broadcast; entities are
counted distinct (trap #28, deviation) and the raw joined-row count is kept
next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo.operators.metrics import count_if, ratio
from pomelo.session import bounded_broadcast
from pomelo.sources.tables import snapshot_pair


def snapshot_changes(preds: DataFrame, new_date: str, old_date: str,
                     key: str = "entity_id", value: str = "class_name") -> DataFrame:
    """S5 + J12 + F10: (entity_id, class_new, class_old) where they differ; a
    null class differs from every other."""
    a, b = snapshot_pair(preds, key, value, new_date, old_date)
    return (a.join(b, key)
            .where(~F.col(f"{value}_new").eqNullSafe(F.col(f"{value}_old")))
            .select(key, F.col(f"{value}_new").alias("class_new"),
                    F.col(f"{value}_old").alias("class_old")))


def changed_item_share(changes: DataFrame, items_new: DataFrame, items_old: DataFrame,
                       item_list: DataFrame, cls: str) -> DataFrame:
    """J13 + F11 + A3 + M14, both snapshots in one row, one pass.

    ``items_*`` are (entity_id, item_id) rows of the behaviour on each date.
    They are semi-joined to the broadcast item list (narrow) and counted per
    (entity, side) — pre-aggregated, so a hot entity collapses map-side —
    then left-joined to the changed entities of each side (one row each) and
    summarised by one conditional aggregate:

    n_changed   changed entities holding class ``cls`` on that side
    n_hit       of those, entities with a listed item (distinct)
    n_hit_rows  the reference's joined-row count (an entity listing an item
                twice counts twice)
    """
    lst = bounded_broadcast(item_list.select("item_id").distinct())

    def hits(items: DataFrame, side: str) -> DataFrame:
        return (items.join(lst, "item_id", "left_semi")
                .select("entity_id", F.lit(side).alias("side")))

    counts = (hits(items_new, "new").unionByName(hits(items_old, "old"))
              .groupBy("entity_id", "side").agg(F.count(F.lit(1)).alias("n_items")))
    changed = (changes.where(F.col("class_new") == cls).select("entity_id", F.lit("new").alias("side"))
               .unionByName(changes.where(F.col("class_old") == cls)
                            .select("entity_id", F.lit("old").alias("side"))))
    j = changed.join(counts, ["entity_id", "side"], "left")
    hit = F.col("n_items").isNotNull()
    aggs = []
    for side in ("new", "old"):
        on = F.col("side") == side
        aggs += [count_if(on).alias(f"n_changed_{side}"),
                 F.countDistinct(F.when(on & hit, F.col("entity_id"))).alias(f"n_hit_{side}"),
                 F.coalesce(F.sum(F.when(on, F.col("n_items"))), F.lit(0)).cast("bigint")
                 .alias(f"n_hit_rows_{side}")]
    row = j.agg(*aggs)
    return row.select(
        *[F.col(c).cast("bigint").alias(c) for c in
          ("n_changed_new", "n_hit_new", "n_hit_rows_new", "n_changed_old", "n_hit_old", "n_hit_rows_old")],
        F.round(ratio(F.col("n_hit_new"), F.col("n_changed_new")), 6).alias("share_new"),
        F.round(ratio(F.col("n_hit_old"), F.col("n_changed_old")), 6).alias("share_old"))
