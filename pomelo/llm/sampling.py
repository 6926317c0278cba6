"""A bounded sample of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int | dict[int, int],
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, text, y)`` of at most ``per_class`` documents per label (one number, or one for each), and
    how many labels there are.

    Ids are taken in the order of their hash, so the sample is the same
    however the rows lie.  Ids without a label, outside ``train`` or with
    labels that contradict each other are left out; of several texts of one
    id the least counts.  The sample's size is fixed, so it may be broadcast.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).where(train)
             .groupBy(id_col).agg(F.min(label).alias("y"), F.max(label).alias("z"))
             .where("y = z").select(F.col(id_col).alias("doc_id"), "y"))
    sizes = {int(r.y): r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in sorted(sizes):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class if isinstance(per_class, int) else per_class[y])
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        picked = known.limit(0)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = (texts.join(F.broadcast(picked), "doc_id")      # a fixed number of rows
              .groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    return sample, sizes
