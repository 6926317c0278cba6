"""Generators: behaviour / feature strings to long form.

``explode`` is a narrow operator: no shuffle, no per-partition iterator, no
fault on empty partitions (SURVEY trap #8).  Null or blank entity ids and
null strings are dropped (trap #10, deviation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo.functions import text as T


def _valid_rows(df: DataFrame, key: str, value: str, extra: tuple[str, ...]) -> DataFrame:
    k = T.java_trim(key)
    return (df.where(F.col(value).isNotNull() & F.col(key).isNotNull() & (F.length(k) > 0))
            .select(k.alias(key), *extra, F.col(value)))


def explode_pairs(df: DataFrame, key: str = "entity_id", value: str = "feature",
                  extra: tuple[str, ...] = ()) -> DataFrame:
    """(key, extra..., "a:x b:y") -> (key, extra..., parts), well-formed tokens only.

    A token is taken apart before the explode, so once: after it, the filter
    and each column that refers to ``parts`` would do it again.  The outer form
    adds no rows (no string splits into nothing) and spares a filter on the
    array's size, which would be pushed below and split every string again."""
    rows = _valid_rows(df, key, value, extra)
    split = rows.select(key, *extra, F.transform(T.split_tokens(value), lambda t: T.pair_parts(t)).alias("parts"))
    return split.select(key, *extra, F.explode_outer("parts").alias("parts")).where(T.is_pair(F.col("parts")))


def explode_behavior(df: DataFrame, strict: bool = True) -> DataFrame:
    """G1: (entity_id, "code:value ...") -> (entity_id, item_code, value)."""
    p = F.col("parts")
    return explode_pairs(df).select(
        "entity_id", T.first_piece(p).alias("item_code"),
        T.strict_double(T.second_piece(p), strict).alias("value"))


def explode_behavior_items(df: DataFrame, prefix_len: int = 2) -> DataFrame:
    """G2 + P7: (entity_id, item_id) with the code prefix stripped, no value."""
    return explode_pairs(df).select(
        "entity_id", T.strip_prefix(T.first_piece(F.col("parts")), prefix_len).alias("item_id"))


def parse_feature_long(df: DataFrame, strict: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """G3 in long form: (entity_id, "i:v ...") -> (entity_id, extra..., column_index, value)."""
    p = F.col("parts")
    return explode_pairs(df, extra=extra).select(
        "entity_id", *extra, T.strict_int(T.first_piece(p)).alias("column_index"),
        T.strict_double(T.second_piece(p), strict).alias("value"))


def index_values(feature: str = "feature"):
    """G3 as an array of (i, v) of the well-formed tokens, by index (strict casts)."""
    toks = F.filter(T.split_tokens(feature), lambda t: T.is_pair(T.pair_parts(t)))
    return F.array_sort(F.transform(toks, lambda t: F.struct(
        T.strict_int(T.first_piece(T.pair_parts(t))).alias("i"),
        T.strict_double(T.second_piece(T.pair_parts(t))).alias("v"))))


def active_index_count(feature: str = "feature"):
    """F6 helper: number of well-formed tokens (0 for NULL/empty strings)."""
    toks = F.filter(T.split_tokens(F.coalesce(F.col(feature), F.lit(""))),
                    lambda t: T.is_pair(T.pair_parts(t)))
    return F.size(toks)
