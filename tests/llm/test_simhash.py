"""Operator 9: fingerprints and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from pomelo.llm import simhash as S
from pomelo.llm.common import prepare

SF_SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    votes = Counter()
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        votes.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def plain_components(prints, ids):
    """ids and fingerprints of rows -> the least id of each row's component."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    least = {}
    for v, i in zip(prints, ids):
        r = find(v)
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(find(v)) for v in prints]


def test_query_equals_brute_force(spark):
    from pomelo.llm.queries import QUERIES
    rows = QUERIES["op9_simhash_multi_index"](spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    want = plain_components(prints, [d.doc_id for d in docs])
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted(
        (d.doc_id, f"{p:016x}", c) for d, p, c in zip(docs, prints, want))


def texts_of(rng, n):
    base = [" ".join(rng.choices([f"w{k}" for k in range(300)], k=rng.randint(30, 120))) for _ in range(n)]
    out = list(base)
    for t in base:
        for _ in range(rng.randint(0, 6)):
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    return out + ["", None, " \t\n", "one", "one two", "one two", "ONE Two", "x " * 30000, "É é", "é é"]


@pytest.mark.parametrize("block", [1, 3, 2048])
def test_near_copies_odd_rows_and_blocks(spark, block):
    prepare(spark)
    texts = texts_of(random.Random(block), 25)
    ids = [i * 3 % 101 + i for i in range(len(texts))]
    rows = [(i, t, "z", 1) for i, t in zip(ids, texts)] + [(None, texts[0], "z", 2), (None, "only null id here", "z", 2)]
    rows += rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int").repartition(3)
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in S.near_duplicates(df, block=block).collect()), key=repr)
    prints = [plain_fingerprint(r[1]) for r in rows]
    comp = plain_components(prints, [r[0] for r in rows])
    want = sorted(((r[0], int(np.uint64(p).view(np.int64)), c) for r, p, c in zip(rows, prints, comp)), key=repr)
    assert got == want
    kept = S.one_per_component(df, block=block)
    assert kept.columns == df.columns
    groups = {(c, p if c is None else None) for p, c in zip(prints, comp)}
    assert kept.count() == len(groups)
    assert {r.doc_id for r in kept.collect()} >= {c for c in comp if c is not None}


def test_links_at_every_distance(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    values = {base}
    for bits in range(1, 6):
        for _ in range(12):
            v = base
            for b in rng.sample(range(64), bits):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    found = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in S.links(df, block=5).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in found:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    assert [find(v) for v in values] == plain_components(values, values)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.report(df).count() == 0
    assert S.one_per_component(df).count() == 0
