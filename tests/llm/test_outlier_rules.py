"""Operator 2: base statistics against brute force, verdicts against a plain estimate, no Python in the plan."""

import contextlib
import io
import random
import re

import numpy as np
import pytest

from pomelo.llm import outlier_rules as R
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    covered = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(3)}
    lines, dup, earlier = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def plain_verdicts(rows):
    """rows of (lang, source, statistics) -> kept, by sorting every group's distances."""
    def vector(s):
        n, chars = max(s[0], 1), max(s[1], 1)
        return [np.log(n), np.log(chars / n), np.sqrt(s[2] / chars), np.sqrt(min(s[3] / n, 1)), np.sqrt(s[4] / n)]

    groups = {}
    for lang, source, s in rows:
        if not s[5]:
            groups.setdefault((lang, source), []).append(vector(s))
    langs = {}
    for (lang, source), g in groups.items():
        if len(g) < R.MIN_GROUP:
            langs.setdefault(lang, []).extend(g)
    rest = [v for g in langs.values() if len(g) < R.MIN_GROUP for v in g]
    floor = np.diag(np.square(R.FLOORS))
    raised = lambda c: c - np.diag(np.diag(c)) + np.maximum(np.diag(np.diag(c)), floor)

    def estimate(g):
        x = np.array(g)
        med = np.median(x, axis=0)
        mad = 1.4826 * np.median(np.abs(x - med), axis=0)
        found = []
        for m, c in ((med, raised(np.diag(mad ** 2))), (med, floor), (x.mean(0), raised(np.cov(x.T, bias=True)))):
            for _ in range(R.STEPS):
                d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
                core = x[np.argsort(d)[:int(np.ceil(R.CORE * len(x)))]]
                m, c = core.mean(0), raised(np.cov(core.T, bias=True) * R.CONSISTENCY)
            found.append((np.linalg.slogdet(c)[1], m, c))
        return min(found, key=lambda f: f[0])[1:]

    fits = {}

    def fit(key, g):
        if key not in fits:
            fits[key] = estimate(g)
        return fits[key]

    out = []
    for lang, source, s in rows:
        g = groups.get((lang, source), [])
        pick = (fit((lang, source), g) if len(g) >= R.MIN_GROUP else
                fit(lang, langs[lang]) if len(langs.get(lang, [])) >= R.MIN_GROUP else
                fit(None, rest) if len(rest) >= R.MIN_GROUP and g else None)
        d = 0.0
        if pick and not s[5]:
            gap = np.array(vector(s)) - pick[0]
            d = gap @ np.linalg.inv(pick[1]) @ gap
        out.append((not s[5] and d <= R.CUTOFF, d))
    return out


def test_query_on_the_test_table(spark):
    from pomelo.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op2_robust_outliers"](spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    rows = [(d.lang, d.source, plain_statistics(d.text)) for d in docs]
    for d, (_, _, s), (kept, far) in zip(docs, rows, plain_verdicts(rows)):
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == s
        if abs(far - R.CUTOFF) > 0.2 * R.CUTOFF:       # the plain form cuts groups at a row, not at a bucket
            assert r.kept == kept, (d.doc_id, far)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    passed = [r for r in got.values() if not r.base_failed and r.doc_id in labels]
    assert np.mean([r.kept for r in passed if labels[r.doc_id] == 1]) > 0.99
    assert np.mean([r.kept for r in passed if labels[r.doc_id] == 0]) < 0.2


def test_each_statistic_alone_rejects(spark):
    """Ordinary texts of about 200 words without a repeat, and one departure at a time."""
    prepare(spark)
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(5, 9))) for _ in range(60_000)]
    fresh = iter(rng.sample(sorted(set(words)), 55_000))
    some = lambda n: [next(fresh) for _ in range(n)]
    lines = lambda ws, k=10: "\n".join(" ".join(ws[i:i + k]) for i in range(0, len(ws), k))
    usual = [lines(some(rng.randint(150, 250))) for _ in range(200)]
    block = some(48)
    odd = {"length": lines([f"{a}{i}" for i, a in enumerate(rng.choices(words, k=60_000))]),
           "word length": lines([w * 6 for w in some(200)]),
           "symbols": lines([w + "##" for w in some(200)]),
           "duplicate lines": "\n".join(x for w in some(100) for x in (w, w)),
           "repeats": lines(block + some(106) + block)}
    ordinary = {"long": lines(some(600)), "short": lines(some(60)), "one repeat": lines((a := some(200)) + a[:6]),
                "a symbol": lines(some(200)) + " #1", "one line twice": "\n".join([lines(a := some(200)), lines(a[:10])])}
    rows = [(str(i), t) for i, t in enumerate(usual)] + list(odd.items()) + list(ordinary.items())
    df = spark.createDataFrame([(n, t, "en", "web") for n, t in rows], "doc_id string, text string, lang string, source string")
    got = {r.doc_id: r for r in R.report(df).collect()}
    assert not any(got[n].base_failed for n, _ in rows)
    assert [n for n in odd if got[n].kept] == [] and [n for n in ordinary if not got[n].kept] == []
    assert sum(got[str(i)].kept for i in range(len(usual))) == len(usual)
    assert got["repeats"].n_repeat_words == 96 and got["repeats"].n_words == 202


ODD = ["", None, " \n\t\x0b\x0c\r ", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a b a a a",
       "x\ny\nx\n \n \nx ", "\n\n", "#*$ %&| <> ok", "É漢😀 a b \x1c c", "a\n\na\n\n", " lead", "trail ",
       "w1 w2 w3 " * 400, "one two three four " * 30000]


def test_statistics_of_odd_and_random_texts(spark):
    prepare(spark)
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choices("ab#|\n\t  é", k=rng.randint(0, 300))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", "text", R.statistics(df.text).alias("s")).collect():
        assert tuple(r.s) == plain_statistics(r.text)[:5], r.text and r.text[:80]


def test_outliers_per_group_odd_rows_and_clashing_columns(spark):
    prepare(spark)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, k=rng.randint(60, 400)))
        rows.append((i, text, "en", "big" if i % 3 else f"s{i % 7}", "k"))
    bad = [(1000 + i, " ".join(w + "###" for w in rng.choices(words, k=200)), "en", "big", "k") for i in range(10)]
    odd = [(2000, None, None, None, None), (2001, "", "xx", None, None), (2002, rows[5][1], None, "lonely", "k"),
           (None, rows[6][1], "en", "big", "k"), rows[1], rows[1]]
    df = spark.createDataFrame(rows + bad + odd, "doc_id long, text string, lang string, source string, kept string")
    out = [(r.doc_id, r.kept) for r in R.report(df).collect()]
    assert len(out) == len(rows) + len(bad) + len(odd)
    verdict = dict(out)
    assert all(verdict[r[0]] for r in rows) and not any(verdict[r[0]] for r in bad)
    assert not verdict[2000] and not verdict[2001] and verdict[2002] and verdict[None]
    kept = R.keep_usual(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in df.collect() if verdict[r.doc_id])


@pytest.mark.parametrize("limit", [0, 50_000])
def test_group_tables_joined_either_way_give_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "BROADCAST_GROUPS", limit)
    docs = table(spark, SF, "documents")
    got = {(r.doc_id, r.kept) for r in R.report(docs).collect()}
    assert len(got) == docs.count()
    store = test_group_tables_joined_either_way_give_the_same.__dict__
    assert store.setdefault("got", got) == got


def test_no_python_in_the_plan(spark):
    out = R.report(table(spark, SF, "documents"))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain("formatted")
    assert not re.search("Python|Pandas|Arrow", text.getvalue())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert R.report(df).count() == 0
    assert R.keep_usual(df).count() == 0
