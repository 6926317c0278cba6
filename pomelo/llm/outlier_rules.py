"""Quality rules by robust multivariate outliers (operator 2); DataFrame functions only.

Base statistics of every whole text give a vector of transformed values; per
language and source, minimum-covariance-determinant estimates say what is
usual, and documents beyond a Mahalanobis distance are rejected.

The estimates: from three starts (median and MAD; mean and covariance of all;
median with unit scales) concentration steps keep, per group, the ``CORE``
share of rows of least distance and estimate again from those; of the starts,
the least determinant wins.  A group's row order by distance is a histogram of
fine distance buckets (a bucket is kept whole), so no group is sorted or
gathered: every step is a grouped sum that combines before the shuffle, and a
group with a third of all rows costs no task more than another.  A variance
below its floor (``FLOORS``) is raised to it, so a statistic that is constant
in a group does not reject small departures; larger ones stay as estimated.
The limit of the distance is a quantile of its chi-square distribution.

Groups of fewer than ``MIN_GROUP`` usable rows are pooled by language, and
what is still too small in one pool; a pool that stays too small rejects
nothing.  Group tables are broadcast up to ``BROADCAST_GROUPS`` rows (counted)
and joined by shuffle beyond.

Cases: a null text has no words (base_failed); a null language or source
counts as the empty one; equal rows get equal verdicts, each counted; an
empty table gives an empty result.  Windows of words are compared by 64-bit
hash within one text (two different ones among 100,000 words coincide with a
chance below 1e-9).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pomelo.llm.common import checkpointed

SPACE = " \t\n\x0b\x0c\r"
CORE = 0.75                 # share of a group's rows that the estimate rests on
STEPS = 3                   # concentration steps
MIN_GROUP = 50
BROADCAST_GROUPS = 50_000   # rows of about 250 bytes
BUCKETS = 16                # distance buckets to a factor of two
# chi-square with 5 degrees of freedom: its 1 - 1e-6 quantile, and the factor that makes the
# covariance of the nearest 75 % consistent (0.75 over the chi-square(7) share below the 0.75 quantile)
CUTOFF = 35.89
CONSISTENCY = 1.412
# transformed statistics and the standard deviation that each has at least (only a group that is degenerate in a
# statistic has less): alone, a length 20 times the usual one rejects, or a share of duplicate lines or of repeated
# words of 0.23 where there are none
VECTOR = ("log_words", "log_word_length", "symbol_share", "dup_line_share", "repeat_share")
FLOORS = (0.5, 0.1, 0.05, 0.08, 0.08)
D = len(VECTOR)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
STARTS = ("median", "mean", "unit")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text."""
    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(x - F.get(p, k - 1), F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def positions(s: Column) -> Column:
        again = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def of_windows(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                .otherwise(_let(_let(by_hash, positions), covered)))

    def of_words(w: Column) -> Column:
        window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(hashes, of_windows))

    return _let(words, of_words)


def statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(text, F.lit(""))
    core = F.btrim(text, F.lit(SPACE))
    words = F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    white = F.length(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", ""))

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            (F.length(text) - white).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"))

    return _let(words, of)


def _base_failed(s: str) -> Column:
    n = F.col(f"{s}.n_words")
    return (n < 50) | (100 * F.col(f"{s}.n_repeat_words") > 50 * n)


def _vector(s: str) -> list[Column]:
    n, chars = F.greatest(F.col(f"{s}.n_words"), F.lit(1)), F.greatest(F.col(f"{s}.word_chars"), F.lit(1))
    return [F.log(n), F.log(chars / n), F.sqrt(F.col(f"{s}.n_symbols") / chars),
            F.sqrt(F.least(F.col(f"{s}.n_dup_lines") / n, F.lit(1.0))), F.sqrt(F.col(f"{s}.n_repeat_words") / n)]


def _placed(groups: DataFrame) -> DataFrame:
    """A table of groups, marked for broadcast if it is small."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def _pooled(rows: DataFrame) -> DataFrame:
    """``rows (lang, source, ...)`` -> ``(lang, source, g)``: the group whose estimates each uses (null: none)."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.where(F.col("n") < MIN_GROUP)
    by_lang = small.groupBy("lang").agg(F.sum("n").alias("pool"))
    rest = by_lang.where(F.col("pool") < MIN_GROUP).agg(F.coalesce(F.sum("pool"), F.lit(0)).alias("rest"))
    own = F.to_json(F.struct(F.lit(2).alias("level"), "lang", "source"))
    pool = F.to_json(F.struct(F.lit(1).alias("level"), "lang"))
    return checkpointed(
        sizes.join(by_lang, "lang", "left")
        .select("lang", "source",
                F.when(F.col("n") >= MIN_GROUP, own).when(F.col("pool") >= MIN_GROUP, pool)
                .when(rest.scalar() >= MIN_GROUP, F.lit("all")).alias("g")))


def _factor(params: DataFrame) -> DataFrame:
    """Means ``m*`` and covariances ``c*_*`` -> means, inverse Cholesky factor ``f*_*`` and log determinant."""
    out = params
    for i, j in PAIRS:
        done = sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
        left = F.col(f"c{i}_{j}") - done
        out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(left, F.lit(1e-12))) if i == j else left / F.col(f"l{j}_{j}"))
    for i, j in PAIRS:
        done = sum((F.col(f"l{i}_{k}") * F.col(f"f{k}_{j}") for k in range(j, i)), F.lit(0.0))
        out = out.withColumn(f"f{i}_{j}", (F.lit(float(i == j)) - done) / F.col(f"l{i}_{i}"))
    det = sum((F.log(F.col(f"l{i}_{i}")) for i in range(D)), F.lit(0.0))
    return out.select("g", "start", *[f"m{i}" for i in range(D)], *[f"f{i}_{j}" for i, j in PAIRS], det.alias("det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x*`` under ``m*`` and ``f*_*``."""
    gap = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(D)]
    return sum((F.pow(sum((F.col(f"f{i}_{j}") * gap[j] for j in range(i + 1)), F.lit(0.0)), F.lit(2)) for i in range(D)),
               F.lit(0.0))


def _quantiles(values: DataFrame, keys: list[str], share: float) -> DataFrame:
    """``values (keys, bucket)`` -> ``(keys, at)``: the least bucket with ``share`` of the rows at or below it."""
    counts = values.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"))
    # windows over buckets, a bounded number for each key
    counts = counts.selectExpr(*keys, "bucket", f"sum(n) over (partition by {', '.join(keys)} order by bucket) as upto",
                               f"sum(n) over (partition by {', '.join(keys)}) as total")
    return counts.where(F.col("upto") >= share * F.col("total")).groupBy(*keys).agg(F.min("bucket").alias("at"))


def _medians(rows: DataFrame) -> DataFrame:
    """``(g, med*, mad*)`` of ``rows (g, x*)``, on a grid of 1/256."""
    grid = 256
    long = rows.select("g", F.posexplode(F.array(*[F.col(f"x{i}") for i in range(D)])).alias("k", "x"))
    med = _quantiles(long.select("g", "k", F.floor(F.col("x") * grid).alias("bucket")), ["g", "k"], 0.5)
    med = checkpointed(med.select("g", "k", (F.col("at") / grid).alias("med")))
    off = (long.join(_placed(med), ["g", "k"])
           .select("g", "k", F.floor(F.abs(F.col("x") - F.col("med")) * grid).alias("bucket")))
    mad = _quantiles(off, ["g", "k"], 0.5).select("g", "k", (F.col("at") / grid).alias("mad"))
    pick = lambda name, i: F.max(F.when(F.col("k") == i, F.col(name))).alias(f"{name}{i}")
    return med.join(mad, ["g", "k"]).groupBy("g").agg(*[pick(c, i) for i in range(D) for c in ("med", "mad")])


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    """Means and covariances of ``rows (g, start, x*)``, the latter times ``factor`` and on the diagonal at least the floors."""
    agg = rows.groupBy("g", "start").agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(D)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}_{j}") for i, j in PAIRS])
    at_least = lambda c, i, j: F.greatest(c, F.lit(FLOORS[i] ** 2)) if i == j else c
    cov = [at_least(F.col(f"v{i}_{j}") * factor, i, j).alias(f"c{i}_{j}") for i, j in PAIRS]
    return agg.select("g", "start", *[f"m{i}" for i in range(D)], *cov)


def _estimates(rows: DataFrame) -> DataFrame:
    """``rows (g, x*)`` -> per group the means and inverse factor of its minimum covariance determinant."""
    med = _medians(rows)
    diag = lambda start, var: med.select(
        "g", F.lit(start).alias("start"), *[F.col(f"med{i}").alias(f"m{i}") for i in range(D)],
        *[(var(i) if i == j else F.lit(0.0)).alias(f"c{i}_{j}") for i, j in PAIRS])
    first = (diag("median", lambda i: F.greatest(F.pow(1.4826 * F.col(f"mad{i}"), F.lit(2)), F.lit(FLOORS[i] ** 2)))
             .unionByName(diag("unit", lambda i: F.lit(FLOORS[i] ** 2)))
             .unionByName(_moments(rows.withColumn("start", F.lit("mean")), 1.0)))
    params = checkpointed(_factor(first))
    for _ in range(STEPS):
        far = (rows.join(_placed(params), "g")
               .select("g", "start", *[f"x{i}" for i in range(D)],
                       F.floor(F.log2(1 + _distance()) * BUCKETS).alias("bucket")))
        edge = checkpointed(_quantiles(far.select("g", "start", "bucket"), ["g", "start"], CORE))
        core = far.join(_placed(edge), ["g", "start"]).where("bucket <= at")
        params = checkpointed(_factor(_moments(core, CONSISTENCY)))
    best = params.groupBy("g").agg(F.min_by(F.struct(*params.columns[2:]), F.struct("det", "start")).alias("p"))
    return best.select("g", "p.*").drop("det")


def _keys(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")]


def estimates(stats: DataFrame) -> DataFrame:
    """``stats (lang, source, s)`` -> ``(lang, source, m*, f*_*)``; groups without an estimate are not listed."""
    usable = stats.where(~_base_failed("s")).select(
        "lang", "source", *[v.alias(f"x{i}") for i, v in enumerate(_vector("s"))])
    groups = _pooled(usable)
    rows = usable.join(_placed(groups.where("g is not null")), ["lang", "source"]).drop("lang", "source")
    return checkpointed(groups.join(_estimates(rows), "g").drop("g"))


def _judged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows (lang, source, s, ...)`` with base_failed, distance (null: no estimate) and kept."""
    joined = rows.join(_placed(found), ["lang", "source"], "left")
    for i, v in enumerate(_vector("s")):
        joined = joined.withColumn(f"x{i}", v)
    usual = F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return (joined.withColumn("base_failed", _base_failed("s")).withColumn("distance", _distance())
            .withColumn("kept", ~F.col("base_failed") & usual)
            .select(*rows.columns, "base_failed", "distance", "kept"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: the base statistics, base_failed and kept."""
    lang, source = _keys(docs)
    stats = checkpointed(docs.select("doc_id", lang.alias("lang"), source.alias("source"),
                                     statistics(F.col("text")).alias("s")))
    return _judged(stats, estimates(stats)).select("doc_id", "s.*", "base_failed", "kept")


def keep_usual(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns as they were."""
    lang, source = _keys(docs)
    # written with the rows: the statistics of a text are computed once
    packed = checkpointed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                      lang.alias("lang"), source.alias("source"), statistics(F.col("text")).alias("s")))
    return _judged(packed, estimates(packed.select("lang", "source", "s"))).where("kept").select("row.*")


def oracle() -> str:
    """DuckDB SQL for the rows of ``report``."""
    xs, ms = [f"x{i}" for i in range(D)], [f"m{i}" for i in range(D)]
    space = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]"
    cs = [f"c{i}_{j}" for i, j in PAIRS]
    fs = [f"f{i}_{j}" for i, j in PAIRS]

    def factor(source: str) -> str:
        sql = source
        for j in range(D):                              # a column of the Cholesky factor at a time
            cols = []
            for i in range(j, D):
                left = f"c{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
                cols.append((i, left))
            sql = f"SELECT *, sqrt(greatest({cols[0][1]}, 1e-12)) AS l{j}_{j} FROM ({sql})"
            if cols[1:]:
                sql = "SELECT *, " + ", ".join(f"({left}) / l{j}_{j} AS l{i}_{j}" for i, left in cols[1:]) + f" FROM ({sql})"
        for gap in range(D):                            # its inverse, a diagonal at a time
            done = {i: "".join(f" - l{i}_{k} * f{k}_{i - gap}" for k in range(i - gap, i)) for i in range(gap, D)}
            sql = "SELECT *, " + ", ".join(
                f"({'1.0' if gap == 0 else '0.0'}{done[i]}) / l{i}_{i} AS f{i}_{i - gap}" for i in range(gap, D)) + f" FROM ({sql})"
        det = " + ".join(f"ln(l{i}_{i})" for i in range(D))
        return f"SELECT g, start, {', '.join(ms + fs)}, {det} AS det FROM ({sql})"

    def moments(source: str, scale: float) -> str:
        cov = ", ".join((f"greatest(covar_pop(x{i}, x{j}) * {scale}, {FLOORS[i] ** 2})" if i == j
                         else f"covar_pop(x{i}, x{j}) * {scale}") + f" AS c{i}_{j}" for i, j in PAIRS)
        return (f"SELECT g, start, {', '.join(f'avg(x{i}) AS m{i}' for i in range(D))}, {cov} "
                f"FROM ({source}) GROUP BY g, start")

    distance = " + ".join("pow(" + " + ".join(f"f{i}_{j} * (x{j} - m{j})" for j in range(i + 1)) + ", 2)" for i in range(D))

    def start(name: str, var: Callable[[int], str]) -> str:
        cov = ", ".join(f"{var(i) if i == j else 0.0} AS c{i}_{j}" for i, j in PAIRS)
        return f"SELECT g, '{name}' AS start, {', '.join(f'med{i} AS m{i}' for i in range(D))}, {cov} FROM md"

    steps = ""
    for t in range(STEPS):
        steps += f""",
        far{t} AS MATERIALIZED (SELECT r.g, p.start, {', '.join(xs)}, floor(log2(1 + {distance}) * {BUCKETS}) AS bucket
                  FROM r JOIN p{t} p ON r.g = p.g),
        e{t} AS MATERIALIZED (SELECT g, start, quantile_disc(bucket, {CORE}) AS at_bucket FROM far{t} GROUP BY g, start),
        p{t + 1} AS MATERIALIZED ({factor(moments(f'SELECT f.* FROM far{t} f JOIN e{t} e ON f.g = e.g AND f.start = e.start '
                                                  'WHERE bucket <= at_bucket', CONSISTENCY))})"""
    first = " UNION ALL BY NAME ".join([
        start("median", lambda i: f"greatest(pow(1.4826 * mad{i}, 2), {FLOORS[i] ** 2})"),
        start("unit", lambda i: str(FLOORS[i] ** 2)),
        moments("SELECT *, 'mean' AS start FROM r", 1.0)])
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS n, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   coalesce(text, '') AS text FROM documents),
        t AS MATERIALIZED (
            SELECT n, doc_id, lang, source, text, list_filter(string_split_regex(text, '{space}+'), lambda x: x <> '') AS w,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM d),
        win AS (SELECT n, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
                FROM (SELECT n, w, unnest(generate_series(1, len(w) - 2)) AS i FROM t WHERE len(w) > 2)),
        again AS (SELECT n, i, count(*) OVER (PARTITION BY n, s) AS c FROM win),
        rep AS (SELECT n, count(DISTINCT p) AS c FROM (SELECT n, unnest([i, i + 1, i + 2]) AS p FROM again WHERE c > 1) GROUP BY n),
        s0 AS (
            SELECT t.n, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(rep.c, 0) AS BIGINT) AS n_repeat_words
            FROM t LEFT JOIN rep ON t.n = rep.n),
        s AS MATERIALIZED (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                   ln(greatest(n_words, 1)) AS x0, ln(greatest(word_chars, 1) / greatest(n_words, 1)) AS x1,
                   sqrt(n_symbols / greatest(word_chars, 1)) AS x2,
                   sqrt(least(n_dup_lines / greatest(n_words, 1), 1.0)) AS x3,
                   sqrt(n_repeat_words / greatest(n_words, 1)) AS x4 FROM s0),
        sz AS (SELECT lang, source, count(*) AS c FROM s WHERE NOT base_failed GROUP BY lang, source),
        bl AS (SELECT lang, sum(c) AS pool FROM sz WHERE c < {MIN_GROUP} GROUP BY lang),
        gr AS MATERIALIZED (
            SELECT sz.lang, source, CASE WHEN c >= {MIN_GROUP} THEN '2|' || sz.lang || '|' || source
                        WHEN pool >= {MIN_GROUP} THEN '1|' || sz.lang
                        WHEN (SELECT coalesce(sum(pool), 0) FROM bl WHERE pool < {MIN_GROUP}) >= {MIN_GROUP} THEN 'all' END AS g
            FROM sz LEFT JOIN bl ON sz.lang = bl.lang),
        r AS MATERIALIZED (
            SELECT gr.g, {', '.join(xs)} FROM s JOIN gr ON s.lang = gr.lang AND s.source = gr.source
            WHERE NOT base_failed AND gr.g IS NOT NULL),
        m0 AS (SELECT g, {', '.join(f'quantile_disc(floor(x{i} * 256), 0.5) / 256 AS med{i}' for i in range(D))} FROM r GROUP BY g),
        md AS MATERIALIZED (
            SELECT r.g, {', '.join(f'any_value(med{i}) AS med{i}' for i in range(D))},
                   {', '.join(f'quantile_disc(floor(abs(x{i} - med{i}) * 256), 0.5) / 256 AS mad{i}' for i in range(D))}
            FROM r JOIN m0 ON r.g = m0.g GROUP BY r.g),
        p0 AS MATERIALIZED ({factor(f"SELECT g, start, {', '.join(ms + cs)} FROM ({first})")}){steps},
        best AS (SELECT * FROM p{STEPS} QUALIFY row_number() OVER (PARTITION BY g ORDER BY det, start) = 1)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce({distance} <= {CUTOFF}, true) AS kept
        FROM s LEFT JOIN gr ON s.lang = gr.lang AND s.source = gr.source LEFT JOIN best ON gr.g = best.g
    """
