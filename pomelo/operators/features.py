"""Feature build: top-K items, active items, column numbering, sparse rows.

Plan shape (the behaviour table is the only large input):

* top-K items: ``orderBy(...).limit(K)`` -> TakeOrderedAndProject, every task
  keeps at most K rows; the result is bounded by K by construction.
* pairs: tokens semi-joined to the *broadcast* top-K codes (narrow), then
  distinct (entity, code) pairs — one shuffle hashing both columns, so a hot
  entity is split over many tasks; this exchange is shared by the next two.
* active items: distinct codes of the pairs (<= K), semi-joined to top-K.
* numbering: one window over <= K rows.
* feature rows: pairs x broadcast index (narrow), then one ``collect_list``
  per entity over at most K rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.functions import text as T
from pomelo.operators.tokens import index_values
from pomelo.session import bounded_broadcast


def topk_order() -> list:
    """Top-K order: installs, then code, then name, all descending (trap #2)."""
    return [F.col("install_num").desc(), F.col("item_code").desc(), F.col("item_name").desc()]


def item_codes(item_dim: DataFrame, prefix: str = P.CODE_PREFIX) -> DataFrame:
    """P5 + P8 + P10: (item_code = prefix + trimmed id, item_name, install_num).

    Items without an id are dropped here, before they could take a top-K slot."""
    blank = T.java_trim(T.without_newlines("item_id")) == ""
    return item_dim.where(F.col("item_id").isNotNull() & ~blank).select(
        T.add_prefix(prefix, "item_id").alias("item_code"),
        T.java_trim(T.without_newlines("item_name")).alias("item_name"),
        F.col("install_num").cast("bigint").alias("install_num"))


def top_k_items(items: DataFrame, k: int) -> DataFrame:
    """O1: the K items with most installs; ties -> larger code, then name."""
    return items.orderBy(*topk_order()).limit(k)


def topk_pairs(tokens: DataFrame, topk: DataFrame, k: int) -> DataFrame:
    """Distinct (entity_id, item_code) pairs whose code is among the top K.

    The tokens are semi-joined to the broadcast top-K codes (narrow), then
    de-duplicated on both columns.  That one shuffle serves both the active
    item list and the feature rows (the same exchange is reused), and since
    it hashes both columns an entity holding a third of all rows is spread
    over many tasks."""
    codes = bounded_broadcast(topk.select("item_code"), k)
    return (tokens.select("entity_id", "item_code")
            .join(codes, "item_code", "left_semi")
            .distinct())


def active_items(topk: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """A7 + J2: top-K items held by at least one entity (left semi).

    Top-K is taken first, so fewer than K columns can result (trap #1).
    ``pairs`` come from ``topk_pairs`` (<= K distinct codes).  Counting the
    entities per code reads the distinct pairs' exchange, the same one the
    feature rows read, so the behaviour is exploded once for both."""
    held = (pairs.groupBy("item_code").agg(F.count("entity_id").alias("n_entities"))
            .where(F.col("n_entities") >= 1).select("item_code"))
    return topk.join(bounded_broadcast(held, k), "item_code", "left_semi")


def number_items(active: DataFrame) -> DataFrame:
    """O3: dense ``column_index`` 0..n-1 in top-K order (deterministic, trap #3).

    A global window is used on purpose: the input is bounded by K rows."""
    w = Window.orderBy(*topk_order())
    return active.withColumn("column_index", (F.row_number().over(w) - 1).cast("bigint"))


def dimension_rows(index: DataFrame, prefix_len: int = 2) -> DataFrame:
    """Rows of the written item table (code with the prefix stripped)."""
    return index.select(T.strip_prefix_guarded("item_code", prefix_len).alias("code"),
                        F.col("item_name").alias("name"), "column_index")


def item_index(item_dim: DataFrame, tokens: DataFrame, k: int,
               prefix: str = P.CODE_PREFIX) -> DataFrame:
    """O1 -> J2 -> O3: (item_code, item_name, install_num, column_index)."""
    topk = top_k_items(item_codes(item_dim, prefix), k)
    return number_items(active_items(topk, topk_pairs(tokens, topk, k), k))


def feature_rows(pairs: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """J1 + P17 + O2 + A11: (entity_id, feature ``"i:1 j:1 ..."``).

    ``pairs`` are the distinct (entity, code) pairs of ``topk_pairs``.
    Features are binary (the parsed value is discarded, trap #4) and each
    index appears once (trap #5, deviation required by the sparse vector);
    one entity's group holds at most K rows.
    """
    idx = bounded_broadcast(index.select("item_code", "column_index"), k)
    return (pairs.join(idx, "item_code")
            .groupBy("entity_id")
            .agg(F.array_sort(F.collect_list("column_index")).alias("idx"))
            .select("entity_id",
                    F.array_join(F.transform("idx", lambda x: F.concat(x.cast("string"), F.lit(":1"))),
                                 " ").alias("feature")))


def assemble_vectors(df: DataFrame, k: int, feature_col: str = "feature",
                     output_col: str = "features") -> DataFrame:
    """M1: the sparse vector of dimension K of a feature string, values and all.

    Tokens are parsed, sorted and checked in the JVM, where they become the
    struct that a vector column is stored as.  The JVM has no cast from that
    struct to the vector type, so the column passes through one Arrow function
    that hands its arrays back as they are: no row becomes a Python object.
    An index outside [0, K), or one that occurs twice, fails the job."""
    @F.arrow_udf(VectorUDT())
    def as_vector(parts: pa.Array) -> pa.Array:
        return parts

    # parsed in a projection of its own: the vector refers to the pairs several times
    parsed = df.withColumn("_pairs", index_values(feature_col))
    index, value = F.col("_pairs.i"), F.col("_pairs.v")
    wrong = (F.element_at(index, 1) < 0) | (F.element_at(index, -1) >= k) | (F.size(F.array_distinct(index)) < F.size(index))
    checked = F.when((F.size(index) > 0) & wrong, F.raise_error(F.concat(
        F.lit(f"column index outside [0, {k}) or repeated: "), F.array_join(index, " "))).cast("array<int>")).otherwise(index)
    # type 0 is the sparse form
    return parsed.withColumn(output_col, as_vector(F.when(F.col(feature_col).isNotNull(), F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(k).alias("size"), checked.alias("indices"), value.alias("values"))))).drop("_pairs")
