"""Row-level recodes between codes, labels and class names (attribute-neutral)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.functions.text import java_trim


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_to_label(c: Column | str, positive_code: int = 2) -> Column:
    """Source code ``positive_code`` -> 1, anything else -> 0.

    The column is cast to int first, so a string column compares as a number
    (SURVEY trap #24)."""
    return F.when(_c(c).cast("int") == positive_code, F.lit(1)).otherwise(F.lit(0))


def class_to_label(c: Column | str, positive: str) -> Column:
    """Class name ``positive`` -> 1, everything else (NULL too) -> 0."""
    return F.when(_c(c) == positive, F.lit(1)).otherwise(F.lit(0))


def label_to_class(c: Column | str, classes: P.ClassNames) -> Column:
    """1 -> positive name, anything else -> negative name."""
    return F.when(_c(c) == 1, F.lit(classes.positive)).otherwise(F.lit(classes.negative))


def birth_year(code: Column | str) -> Column:
    """Year from an encoded id by its length (14 -> [6,10), 12 -> 1900+[6,8))."""
    code = java_trim(code)
    n = F.length(code)
    return (F.when(n == 14, F.substring(code, 7, 4).cast("int"))
            .when(n == 12, F.substring(code, 7, 2).cast("int") + 1900)
            .otherwise(F.lit(0)))


def age_from_year(year: Column, reference_year: int) -> Column:
    """P19 with the current year made a parameter."""
    return F.lit(reference_year) - year


def age_bucket(age: Column | str) -> Column:
    """P20: bucket number 1..5 (fixed ranges in ``params.AGE_BUCKETS``), else 0."""
    age = _c(age)
    expr = None
    for lo, hi, b in P.AGE_BUCKETS:
        cond = (age >= lo) & (age <= hi)
        expr = F.when(cond, F.lit(b)) if expr is None else expr.when(cond, F.lit(b))
    return expr.otherwise(F.lit(0))


def double_text(c: Column) -> Column:
    """``toString`` of a Double, e.g. 3 -> ``'3.0'``."""
    return c.cast("double").cast("string")


def parity_class(c: Column | str, classes: P.ClassNames) -> Column:
    """Odd -> positive name, even -> negative name (strict int cast)."""
    n = java_trim(_c(c).cast("string")).cast("int")
    return F.when(n % 2 == 0, F.lit(classes.negative)).otherwise(F.lit(classes.positive))
