"""Label building: users x devices, two-branch union, decoded attributes.

All joins are equi-joins on keys; filters are written before the joins so
they reach the scans.  "First survivor" steps (A8, A9) use ``min`` so the
result is deterministic (trap #14); ``min`` combines map-side, so a hot key
is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.functions import recode as R
from pomelo.sources.tables import day_partition, distinct_per_key


def first_per_key(df: DataFrame, key: str = "entity_id", value: str = "label") -> DataFrame:
    """One value per key (``reduceByKey((x, y) => x)``, made deterministic)."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def user_device_labels(users: DataFrame, device_user: DataFrame, date: str,
                       codes: tuple[int, ...] = (1, 2), positive_code: int = 2) -> DataFrame:
    """J3 + F1 + F2 + P12: (entity_id, label) rows of one day, not yet de-duplicated.

    User rows of the day are made distinct first, so copies of one user row
    cannot multiply that user's device rows (a join emits one row per device)."""
    u = distinct_per_key(day_partition(users, date).where(F.col("label_code").isin(*codes)), "user_id", "label_code")
    d = day_partition(device_user, date).select("entity_id", "user_id")
    return (u.join(d, "user_id")
            .select("entity_id", R.code_to_label("label_code", positive_code).alias("label")))


def labels_from_users(users: DataFrame, device_user: DataFrame, date: str) -> DataFrame:
    """The known-label table: J3 + P12 + A9 -> (entity_id, label)."""
    return first_per_key(user_device_labels(users, device_user, date))


def two_branch_labels(users: DataFrame, device_user: DataFrame, date: str,
                      positive_code: int = 2, negative_code: int = 1) -> DataFrame:
    """P13 + U4: ``select entity, 1`` for one code union all ``entity, 0`` for
    the other (the reference's two inserts into one table)."""
    d = day_partition(device_user, date).select("entity_id", "user_id")

    def branch(code: int, label: int) -> DataFrame:
        u = distinct_per_key(day_partition(users, date).where(F.col("label_code") == code), "user_id", "label_code")
        return u.join(d, "user_id").select("entity_id", F.lit(label).alias("label"))

    return branch(positive_code, 1).unionByName(branch(negative_code, 0))


def decode_attributes(coded: DataFrame, reference_year: int, classes: P.ClassNames,
                      pattern: str = "^[0-9].*$") -> DataFrame:
    """F3 + A8 + P18..P21 + F9 + P11 -> (user_id, age, age_range, class_name).

    Duplicate (first_code, second_code) pairs keep the smallest user id.
    """
    ok = coded.where(F.col("first_code").rlike(pattern))
    uniq = ok.groupBy("first_code", "second_code").agg(F.min("user_id").alias("user_id"))
    age = R.age_from_year(R.birth_year("first_code"), reference_year)
    out = uniq.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        age.alias("age"),
        F.col("second_code"))
    out = out.where((F.col("age") >= P.AGE_MIN) & (F.col("age") <= P.AGE_MAX))
    return out.select("user_id", "age",
                      R.double_text(R.age_bucket("age")).alias("age_range"),
                      R.parity_class("second_code", classes).alias("class_name"))


def labels_from_devices(decoded: DataFrame, device_user: DataFrame, date: str,
                        classes: P.ClassNames) -> DataFrame:
    """J4 + P14 + A9: decoded class per user -> (entity_id, label) per device."""
    d = day_partition(device_user, date).select("entity_id", "user_id")
    j = decoded.select("user_id", "class_name").join(d, "user_id")
    return first_per_key(j.select("entity_id", R.class_to_label("class_name", classes.positive)
                                  .alias("label")))


def three_way(decoded: DataFrame, device_user: DataFrame, preds: DataFrame,
              device_date: str, pred_date: str) -> DataFrame:
    """J5 + P2 + P3: decoded ⋈ devices ⋈ stored predictions on two keys.

    (user_id, entity_id, class_trusted, class_pred)."""
    d = day_partition(device_user, device_date).select("entity_id", "user_id")
    # distinct (entity, class) rows: copies of a stored prediction cannot
    # multiply the device rows of that entity
    p = distinct_per_key(day_partition(preds, pred_date)
                         .select("entity_id", F.col("class_name").alias("class_pred")),
                         "entity_id", "class_pred")
    return (decoded.select("user_id", F.col("class_name").alias("class_trusted"))
            .join(d, "user_id").join(p, "entity_id")
            .select("user_id", "entity_id", "class_trusted", "class_pred"))

