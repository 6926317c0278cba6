"""Neutral input tables derived from the synthetic TPC-H-style test tables.

The jobs read tables with the shapes in ``FIXTURES.md`` (item dimension,
behaviour, users, device-user map, coded ids, trusted truth, stored
predictions).  In production those are real day-partitioned tables; for the
tests and the benchmark they are derived here from ``lineitem``, ``orders``,
``part`` and ``customer`` so that every query's work grows with the data.

Each fixture exists twice: a DataFrame builder (Spark) and a SQL text
(DuckDB oracle).  Keep the two in step.

Bounds: an entity is five consecutive orders (``floor(orderkey / 5)``), so
the behaviour string of one entity holds at most 5 x 7 tokens.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo import params as P

# Fixed values of the fixture derivation.
BEHAVIOR_DATE = "20171028"
OLD_BEHAVIOR_DATE = "20170910"
ITEM_DIM_DATE = "20171028"
DEVICE_DATES = ("20170711", "20171028")      # even / odd order key
USER_DATES = ("20170711", "20171028")        # every user has a row on both days
TRUTH_DATES = ("20170711", "20171105")       # even / odd order key
PREDICTION_DATES = ("20170910", "20171028")  # even / odd order key
PRICE_CUT = 250000


_SCHEMAS: dict = {}  # path -> inferred schema (the test tables are read-only)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table as its files lie."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _SCHEMAS.get(path)
    # a known schema skips the footer-reading inference job of each scan
    df = (spark.read.schema(known) if known is not None else spark.read).parquet(path)
    _SCHEMAS.setdefault(path, df.schema)
    return df


def entity_of(key: str) -> Column:
    return F.concat(F.lit("d"), F.floor(F.col(key) / 5).cast("bigint").cast("string"))


def _by_parity(key: str, dates: tuple[str, str]) -> Column:
    return F.when(F.col(key) % 2 == 0, F.lit(dates[0])).otherwise(F.lit(dates[1]))


def item_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, item_name, install_num, stat_date.

    Counts are pre-aggregated on ``lineitem`` before the join with ``part``.
    """
    counts = (read_table(spark, sf_dir, "lineitem").groupBy("l_partkey")
              .agg(F.count(F.lit(1)).alias("install_num")))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    key = F.col("p_partkey")
    # some items come without a usable id: null or blank
    item_id = (F.when(key % 101 == 0, F.lit(None).cast("string")).when(key % 103 == 0, F.lit(" \t"))
               .otherwise(key.cast("string")))
    return (part.join(counts, part.p_partkey == counts.l_partkey)
            .select(item_id.alias("item_id"), F.col("p_name").alias("item_name"),
                    F.col("install_num"), F.lit(ITEM_DIM_DATE).alias("stat_date")))


def behavior_tokens(spark: SparkSession, sf_dir: str, date: str = BEHAVIOR_DATE) -> DataFrame:
    """entity_id, token: one token per line item (some malformed on purpose).

    Every tenth entity has malformed tokens only on the newer day, so it has
    a behaviour row but no features.  The older day holds other items."""
    li = read_table(spark, sf_dir, "lineitem")
    item = F.col("l_partkey") if date == BEHAVIOR_DATE else F.col("l_suppkey")
    code = F.concat(F.lit(P.CODE_PREFIX), item.cast("string"))
    qty = F.col("l_quantity").cast("int").cast("string")
    malformed = F.col("l_linenumber") == 7
    if date == BEHAVIOR_DATE:
        malformed = malformed | (F.floor(F.col("l_orderkey") / 5) % 10 == 0)
    token = (F.when(malformed, code)
             .when(F.col("l_partkey") % 50 == 0, F.concat(code, F.lit(":"), qty, F.lit(":")))
             .otherwise(F.concat(code, F.lit(":"), qty)))
    return li.select(entity_of("l_orderkey").alias("entity_id"), token.alias("token"))


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, feature ``"code:value ..."``, stat_date (one row per entity and day)."""
    def day(date: str) -> DataFrame:
        return (behavior_tokens(spark, sf_dir, date).groupBy("entity_id")
                .agg(F.concat_ws(" ", F.collect_list("token")).alias("feature"))
                .withColumn("stat_date", F.lit(date)))

    return day(BEHAVIOR_DATE).unionByName(day(OLD_BEHAVIOR_DATE))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, label_code (1, 2 or 0), stat_date; some codes differ between the days."""
    rows = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.explode(F.array(*map(F.lit, USER_DATES))).alias("stat_date"))
    moved = ((F.col("user_id") % 11 == 0) & (F.col("stat_date") == USER_DATES[0])).cast("int")
    k = (F.col("user_id") + moved) % 5
    return rows.select("user_id", F.when(k <= 2, k).otherwise(F.lit(0)).cast("int").alias("label_code"), "stat_date")


def device_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, user_id, stat_date."""
    return read_table(spark, sf_dir, "orders").select(
        entity_of("o_orderkey").alias("entity_id"),
        F.col("o_custkey").alias("user_id"),
        _by_parity("o_orderkey", DEVICE_DATES).alias("stat_date"))


def device_user_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, user_id, stat_date: the device table of the known-label twin; some devices have another user than in ``device_user``."""
    key = F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders").select(
        entity_of("o_orderkey").alias("entity_id"), (F.col("o_custkey") + (key % 13 == 0).cast("int")).alias("user_id"),
        _by_parity("o_orderkey", DEVICE_DATES).alias("stat_date"))


def coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, first_code (encoded id, 12/14 chars or malformed), second_code.

    The code is of the whole key; every twentieth user repeats the pair of
    the user before."""
    key = F.col("c_custkey")
    b = key - (key % 20 == 0).cast("int")
    head = F.lpad((b % 1000000).cast("string"), 6, "0")
    tail = F.lpad((F.floor(b / 1000000) % 10000).cast("string"), 4, "0")
    first = (F.when(b % 4 == 2, F.concat(head, (F.lit(30) + b % 60).cast("string"), tail))
             .when(b % 4 == 3, F.concat(F.lit("X"), b.cast("string")))
             .otherwise(F.concat(head, (F.lit(1930) + b % 90).cast("string"), tail)))
    return read_table(spark, sf_dir, "customer").select(
        key.alias("user_id"), first.alias("first_code"), (b % 7).cast("string").alias("second_code"))


def truth_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, class_name (mostly null: partial coverage), stat_date — the trusted label source."""
    key = F.col("o_orderkey")
    cls = (F.when((key % 3 != 0) | (key % 11 == 0), F.lit(None).cast("string"))
           .when(F.col("o_custkey") % 2 == 0, F.lit("pos")).otherwise(F.lit("neg")))
    return read_table(spark, sf_dir, "orders").select(
        entity_of("o_orderkey").alias("entity_id"), cls.alias("class_name"),
        _by_parity("o_orderkey", TRUTH_DATES).alias("stat_date"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, class_name (some null), stat_date — two stored prediction snapshots."""
    o = read_table(spark, sf_dir, "orders")
    cls = F.when(F.col("o_totalprice") > PRICE_CUT, F.lit("pos")).otherwise(F.lit("neg"))
    return (o.select(entity_of("o_orderkey").alias("entity_id"),
                     _by_parity("o_orderkey", PREDICTION_DATES).alias("stat_date"),
                     cls.alias("c"), "o_orderkey")
            .groupBy("entity_id", "stat_date").agg(F.min("c").alias("c"), F.min("o_orderkey").alias("k"))
            .select("entity_id", F.when(F.col("k") % 17 != 0, F.col("c")).alias("class_name"), "stat_date"))


def fixed_weights(index: DataFrame) -> DataFrame:
    """column_index, weight — fixed coefficients over the data-derived index,
    so scoring and metrics are SQL-checkable without fitting.  Zero weights
    are not listed."""
    w = ((F.col("column_index") * 37) % 101 - 50).cast("double") / F.lit(100.0)
    return index.select(F.col("column_index"), w.alias("weight")).where("weight <> 0")


@dataclass
class Inputs:
    """The raw inputs of all jobs (DataFrames, lazily derived)."""

    item_dim: DataFrame
    behavior: DataFrame
    users: DataFrame
    device_user: DataFrame
    coded_ids: DataFrame
    truth_full: DataFrame
    predictions: DataFrame
    device_user_twin: DataFrame
    truth_table: str | None = None    # catalog name of a partitioned ``truth_full``


WRITTEN = "inputs:"    # what a folder given in place of test tables begins with, if it holds written inputs


def write_inputs(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Derive the inputs once and keep them as files; what to give for ``sf_dir`` to read those."""
    inputs = load_inputs(spark, sf_dir)
    for f in fields(Inputs):
        if f.name != "truth_table":
            getattr(inputs, f.name).write.mode("overwrite").parquet(f"{folder}/{f.name}")
    return WRITTEN + folder


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    if sf_dir.startswith(WRITTEN):
        return Inputs(**{f.name: spark.read.parquet(f"{sf_dir.removeprefix(WRITTEN)}/{f.name}")
                         for f in fields(Inputs) if f.name != "truth_table"})
    return Inputs(
        item_dim=item_dim(spark, sf_dir),
        behavior=behavior(spark, sf_dir),
        users=users(spark, sf_dir),
        device_user=device_user(spark, sf_dir),
        coded_ids=coded_ids(spark, sf_dir),
        truth_full=truth_full(spark, sf_dir),
        predictions=predictions(spark, sf_dir),
        device_user_twin=device_user_twin(spark, sf_dir),
    )


# --- the same derivations as DuckDB SQL (oracle side) -----------------------

def _ent(key: str) -> str:
    return f"('d' || CAST(CAST(FLOOR({key} / 5) AS BIGINT) AS VARCHAR))"


def _tokens_sql(date: str, item: str, malformed: str) -> str:
    code = f"'11' || CAST({item} AS VARCHAR)"
    qty = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    return f"""
        SELECT {_ent('l_orderkey')} AS entity_id,
               CASE WHEN {malformed} THEN {code}
                    WHEN l_partkey % 50 = 0 THEN {code} || ':' || {qty} || ':'
                    ELSE {code} || ':' || {qty} END AS token,
               '{date}' AS stat_date
        FROM lineitem"""


_B = "(c_custkey - CAST(c_custkey % 20 = 0 AS INTEGER))"
_HEAD = f"lpad(CAST({_B} % 1000000 AS VARCHAR), 6, '0')"
_TAIL = f"lpad(CAST(CAST(FLOOR({_B} / 1000000) AS BIGINT) % 10000 AS VARCHAR), 4, '0')"

FIXTURE_SQL: dict[str, str] = {
    "item_dim": f"""
        SELECT CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 103 = 0 THEN ' ' || chr(9)
                    ELSE CAST(p_partkey AS VARCHAR) END AS item_id, p_name AS item_name,
               COUNT(*) AS install_num, '{ITEM_DIM_DATE}' AS stat_date
        FROM part JOIN lineitem ON l_partkey = p_partkey
        GROUP BY p_partkey, p_name""",
    # token rows of both days; the Spark side aggregates them to one string per entity and day
    "behavior_tokens": _tokens_sql(BEHAVIOR_DATE, "l_partkey",
                                   "l_linenumber = 7 OR CAST(FLOOR(l_orderkey / 5) AS BIGINT) % 10 = 0")
    + "\n        UNION ALL" + _tokens_sql(OLD_BEHAVIOR_DATE, "l_suppkey", "l_linenumber = 7"),
    "users": f"""
        SELECT user_id, CAST(CASE WHEN k <= 2 THEN k ELSE 0 END AS INTEGER) AS label_code, stat_date
        FROM (SELECT c_custkey AS user_id, stat_date,
                     (c_custkey + CASE WHEN c_custkey % 11 = 0 AND stat_date = '{USER_DATES[0]}' THEN 1 ELSE 0 END) % 5 AS k
              FROM customer, (VALUES ('{USER_DATES[0]}'), ('{USER_DATES[1]}')) AS d(stat_date)) u""",
    "device_user": f"""
        SELECT {_ent('o_orderkey')} AS entity_id, o_custkey AS user_id,
               CASE WHEN o_orderkey % 2 = 0 THEN '{DEVICE_DATES[0]}' ELSE '{DEVICE_DATES[1]}' END AS stat_date
        FROM orders""",
    "device_user_twin": f"""
        SELECT {_ent('o_orderkey')} AS entity_id, o_custkey + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS user_id,
               CASE WHEN o_orderkey % 2 = 0 THEN '{DEVICE_DATES[0]}' ELSE '{DEVICE_DATES[1]}' END AS stat_date
        FROM orders""",
    "coded_ids": f"""
        SELECT c_custkey AS user_id,
               CASE WHEN {_B} % 4 = 2 THEN {_HEAD} || CAST(30 + {_B} % 60 AS VARCHAR) || {_TAIL}
                    WHEN {_B} % 4 = 3 THEN 'X' || CAST({_B} AS VARCHAR)
                    ELSE {_HEAD} || CAST(1930 + {_B} % 90 AS VARCHAR) || {_TAIL} END AS first_code,
               CAST({_B} % 7 AS VARCHAR) AS second_code
        FROM customer""",
    "truth_full": f"""
        SELECT {_ent('o_orderkey')} AS entity_id,
               CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 11 = 0 THEN NULL
                    WHEN o_custkey % 2 = 0 THEN 'pos' ELSE 'neg' END AS class_name,
               CASE WHEN o_orderkey % 2 = 0 THEN '{TRUTH_DATES[0]}' ELSE '{TRUTH_DATES[1]}' END AS stat_date
        FROM orders""",
    "predictions": f"""
        SELECT {_ent('o_orderkey')} AS entity_id,
               CASE WHEN MIN(o_orderkey) % 17 <> 0
                    THEN MIN(CASE WHEN o_totalprice > {PRICE_CUT} THEN 'pos' ELSE 'neg' END) END AS class_name,
               CASE WHEN o_orderkey % 2 = 0 THEN '{PREDICTION_DATES[0]}' ELSE '{PREDICTION_DATES[1]}' END AS stat_date
        FROM orders GROUP BY 1, 3""",
}
