"""Left joins against a keyed table some of whose keys may be hot.

Every key of the table comes with the number of rows that will meet it.  A
key met by more than a ``SHARE``-th of all rows is hot; there can be fewer
than ``SHARE`` of those, whatever the data, so they are broadcast.  All other
keys are joined by an ordinary join, in which no key brings more than a
``SHARE``-th of the rows to a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo.llm.common import fresh_names

SHARE = 1000


def left_join(rows: DataFrame, key: str, spread: list[str], keyed: DataFrame, weight: str, total: int) -> DataFrame:
    """``rows`` with the other columns of ``keyed``, matched on the string column ``key`` (both have it).

    ``keyed`` has one row a key; its column ``weight`` is how many of the
    ``total`` rows have that key.  ``spread`` are columns of ``rows`` by which
    rows that need no shuffled join (null or hot keys) are dealt out.
    """
    extra = [c for c in keyed.columns if c not in (key, weight)]
    hot = keyed.where(F.col(weight) * SHARE > total)
    cold = keyed.where(F.col(weight) * SHARE <= total)
    is_hot, join_on = fresh_names(rows, "is_hot", "join_on")
    found = F.struct(*extra)
    near = rows.join(F.broadcast(hot.select(key, found.alias(is_hot))), key, "left")     # fewer than SHARE rows
    # keys have no blank, so what begins with one meets nothing
    elsewhere = F.concat(F.lit(" "), F.xxhash64(*spread).cast("string"))
    near = near.withColumn(join_on, F.when(F.col(is_hot).isNotNull() | F.col(key).isNull(), elsewhere).otherwise(F.col(key)))
    far = cold.select(F.col(key).alias(join_on), found.alias(join_on + "_found"))
    both = near.join(far, join_on, "left")
    got = F.coalesce(is_hot, join_on + "_found")
    return both.select(*rows.columns, *[got[c].alias(c) for c in extra])
