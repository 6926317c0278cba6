"""Run-date handling.

D1: the reference parses ``yyyyMMdd`` into a lenient calendar
(``set(y, m-1, d)``) and formats it back; no day is subtracted.  Leniency
means month and day overflow roll forward (``20170231`` -> ``20170303``,
``20171300`` -> ``20171231``).  ``to_date`` would reject such input, so the
roll is written as month and day offsets from January 1st.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pomelo.functions.text import java_trim


def normalise_run_date(c: Column | str) -> Column:
    """Column form of D1 (``yyyyMMdd`` string in, ``yyyyMMdd`` string out)."""
    c = F.col(c) if isinstance(c, str) else c
    y = java_trim(F.substring(c, 1, 4)).cast("int")
    m = java_trim(F.substring(c, 5, 2)).cast("int")
    d = java_trim(F.substring(c, 7, 2)).cast("int")
    day = F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1), d - 1)
    return F.date_format(day, "yyyyMMdd")


def normalise_run_date_py(s: str) -> str:
    """Driver-side D1 for the date argument of a job (one string)."""
    y, m, d = int(s[0:4].strip()), int(s[4:6].strip()), int(s[6:8].strip())
    months = y * 12 + (m - 1)
    first = _dt.date(months // 12, months % 12 + 1, 1)
    return (first + _dt.timedelta(days=d - 1)).strftime("%Y%m%d")


def partition_value(spec: Column | str) -> Column:
    """``'stat_date=20171105'`` -> ``20171105`` (int)."""
    spec = F.col(spec) if isinstance(spec, str) else spec
    return F.split_part(spec, F.lit("="), F.lit(2)).cast("int")
