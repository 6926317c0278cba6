"""Token grammar of the behaviour and feature strings, as Column expressions.

A behaviour string is ``"code:value code:value ..."``.  The reference trims
with Java ``String.trim`` (strips every char <= U+0020) and splits with Java
``String.split``, which drops trailing empty pieces.  Spark's ``trim`` only
strips spaces and Spark's ``split`` keeps trailing empties, so both are
re-expressed here with built-in functions (no UDF, stays in codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Java's String.trim removes: U+0000 .. U+0020.
JAVA_WHITESPACE = "".join(chr(i) for i in range(0x21))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """``String.trim`` semantics."""
    return F.btrim(_c(c), F.lit(JAVA_WHITESPACE))


def split_tokens(c: Column | str) -> Column:
    """Trimmed string split on single spaces (empty tokens die at F4 later)."""
    return F.split(java_trim(c), " ")


def pair_parts(token: Column | str, sep: str = ":") -> Column:
    """Pieces of ``token`` split on ``sep`` the way Java does it.

    Java drops trailing empty pieces, so trailing separators are removed
    before splitting: ``"a:1:"`` -> [a, 1], ``"a:"`` -> [a], ``":5"`` -> ["", 5].
    """
    return F.split(F.rtrim(java_trim(token), F.lit(sep)), sep)


def is_pair(parts: Column) -> Column:
    """the token has exactly two pieces."""
    return F.size(parts) == 2


def first_piece(parts: Column) -> Column:
    return java_trim(F.element_at(parts, 1))


def second_piece(parts: Column) -> Column:
    return java_trim(F.element_at(parts, 2))


def _strict(c: Column, kind: str) -> Column:
    got = c.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"not a {kind}: '"), c, F.lit("'")))
    return F.when(c.isNotNull() & got.isNull(), wrong.cast(kind)).otherwise(got)


def strict_double(c: Column, strict: bool = True) -> Column:
    """P10 ``toDouble``: malformed text fails the job, whatever the session's
    ANSI setting; ``strict=False`` gives NULL instead."""
    return _strict(c, "double") if strict else c.try_cast("double")


def strict_int(c: Column) -> Column:
    """P10 ``toInt``: malformed text fails the job, whatever the session's ANSI setting."""
    return _strict(c, "int")


def strip_prefix_guarded(c: Column | str, n: int = 2) -> Column:
    """Drop the first ``n`` chars only when the string is longer than ``n``."""
    c = _c(c)
    return F.when(F.length(c) > n, F.substring(c, n + 1, 1 << 30)).otherwise(c)


def strip_prefix(c: Column | str, n: int = 2) -> Column:
    """Unguarded ``substring(n)``; short strings give ``''`` instead of failing."""
    return F.substring(_c(c), n + 1, 1 << 30)


def without_newlines(c: Column | str) -> Column:
    """Plain replacement, no regular expression; the planner copies the filter on item ids to the counted side too."""
    return F.replace(_c(c), F.lit("\n"), F.lit(""))


def add_prefix(prefix: str, c: Column | str) -> Column:
    """P5 + P8: prefix the trimmed id with newlines removed."""
    return F.concat(F.lit(prefix), java_trim(without_newlines(c)))
