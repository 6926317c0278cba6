"""Order-insensitive comparison of rows (columns by name); NULL and NaN differ."""

import math


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, con, sql):
    """A Spark DataFrame has the rows of a DuckDB statement."""
    result = con.execute(sql)
    ca, ra = _sorted(df.columns, df.collect())
    cb, rb = _sorted([c[0] for c in result.description], result.fetchall())
    assert ca == cb, f"columns {ca} != {cb}"
    assert len(ra) == len(rb), f"row count {len(ra)} != {len(rb)}"
    bad = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
    assert not bad, f"values differ: {bad}"
