"""Operator 12: rotations, cuts, and rows against a plain rewrite of the texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from pomelo.llm import fim
from pomelo.llm.common import prepare, table


def plain(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    p, m = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:p]), "".join(units[p:m]), "".join(units[m:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_rotation_in_place():
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randint(0, 40)
        a, mid, b = sorted(rng.randint(0, n) for _ in range(3))
        data = bytearray(rng.randbytes(n))
        want = bytes(data[:a] + data[mid:b] + data[a:mid] + data[b:])
        fim.rotate(np.frombuffer(data, np.uint8), a, mid, b, block=rng.randint(1, 7))
        assert bytes(data) == want


def test_cuts_over_blocks():
    rng = random.Random(3)
    parts = ["a", "Zz", " ", "\n", "é", "漢", "😀", "{", "@", "[", "`", "0", "\x00", "Á"]
    for _ in range(500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        h1, h2 = rng.getrandbits(32), rng.getrandbits(32)
        p, m = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        want = (len(units), len("".join(units[:p]).encode()), len("".join(units[:m]).encode()))
        assert fim.cuts(text.encode(), h1, h2, block=rng.randint(1, 9)) == want


@pytest.mark.parametrize("form", ["plain", "psm", "spm"])
def test_exact_round_trip(form):
    rng = random.Random(4)
    parts = ["<", ">", "P", "S", "M", "P>", "S>", "M>", "<<", "x", "é", "\n"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        if form != "plain" and any(s in text for s in ("<P>", "<S>", "<M>")):
            continue
        p, m = sorted(len(text[:rng.randint(0, len(text))].encode()) for _ in range(2))
        out = fim.rearrange(text.encode(), p, m, form, block=rng.randint(1, 5))
        assert bytes(fim.put_back(bytes(out), form, block=rng.randint(1, 5))) == text.encode()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_plain_rewrite(spark, sf):
    from pomelo.llm.queries import QUERIES
    want = []
    for r in table(spark, sf, "documents").collect():
        *head, output = plain(r.doc_id, r.text)
        want.append((*head, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = QUERIES["op12_fim_rotation"](spark, sf)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    prepare(spark)
    rows = [(1, None), (2, ""), (3, "a<S>b"), (None, "one two"), (4, "x"), (4, "x"), (5, "é\n" * 5), (6, "word " * 600_000), (7, "<S> <"), (8, "P>x")]
    rows += [(k, "some words, and more of them") for k in range(100, 160)]
    df = spark.createDataFrame([(i, t, "f", -1, "o", b"x") for i, t in rows], "doc_id long, text string, form string, n long, output string, cut binary")
    got = sorted(map(tuple, fim.transform(df).collect()), key=repr)
    assert got == sorted((plain(i, t) for i, t in rows), key=repr)
    back = fim.transform(df).select("doc_id", fim.restored(fim.F.col("output"), fim.F.col("form")).alias("t"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.report(df).count() == 0


def test_one_narrow_pass(spark):
    from pomelo.llm.queries import QUERIES
    plan = QUERIES["op12_fim_rotation"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]
    assert plan.split("== Physical Plan ==")[1].count("ArrowEvalPython") == 2
