"""Operator 11: the peeled trie against one built from the root in plain Python, and SQL."""

import hashlib
import random
import zlib

import pytest

from pomelo.llm import prefix_trie as T
from pomelo.llm.common import prepare, table

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def plain_trie(seqs):
    members, ends, children = {}, {}, {}
    for c, ts in seqs.items():
        for d in range(len(ts) + 1):
            node = tuple(ts[:d])
            members.setdefault(node, []).append(c)
            if d:
                children.setdefault(node[:-1], set()).add(node)
        ends.setdefault(tuple(ts), []).append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, ())
        leaves[node] = sum(leaves[k] for k in kids) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids)
    return sorted(((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, ())),
                    leaves[node], saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
                   for node, m in members.items()), key=repr)


def got(df):
    assert df.columns == COLUMNS and {t for _, t in df.dtypes[:-1]} == {"bigint"}
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_plain_trie(spark, sf):
    from pomelo.llm.queries import QUERIES
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, sf, "conversations").collect()]
    assert got(QUERIES["op11_prefix_trie"](spark, sf)) == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("seed", range(2))
def test_random_tries(spark, seed):
    """Few distinct turns: deep shared parts, prefixes of one another, many copies."""
    prepare(spark)
    rng = random.Random(seed)
    seqs = {c: [("user", rng.choice(["", "é", "long text"])) for _ in range(rng.choice([0, 1, 2, 3, 5, 9]))] for c in rng.sample(range(-50, 500), 200)}
    seqs[1000] = [("a", "x")] * 15
    seqs[1001], seqs[1002] = seqs[1000][:7], seqs[1000] + [("b", "y")] * 9
    rows = [(c, [(i, hashlib.blake2b(repr(t).encode(), digest_size=16).digest(), len(t[1].encode())) for i, t in enumerate(ts)]) for c, ts in seqs.items()]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<turn: long, digest: binary, bytes: long>>")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if seed % 2:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert got(T.trie(df)) == plain_trie(seqs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_odd_rows(spark):
    prepare(spark)
    rows = [(0, 1, "user", "a"), (0, None, "user", None), (0, 2, None, "b"), (0, 2, None, "b"), (5, 1, None, None), (6, 3, "user", "a" * 200_000),
            (None, 1, "user", "a"), (-3, 1, "user", "é"), (7, 1, "us", "era"), (7, 2, "user", "a"), (8, 1, "user", "a"), (8, 2, "user", "a")]
    rows += [(c, t, "user", f"t{t}") for c in range(10, 60) for t in range(3)]       # a hot group of copies
    df = spark.createDataFrame([(*r, 7, b"p", 1.0) for r in rows], "conv_id long, turn long, role string, text string, n long, path binary, depth double")
    want = plain_trie(plain_rebuilt(rows))
    assert got(T.report(df)) == want
    assert got(T.report(df.repartition(5, "text"))) == want


def test_only_turnless_and_empty_table(spark):
    prepare(spark)
    kind = "conv_id long, turns array<struct<turn: long, digest: binary, bytes: long>>"
    assert got(T.trie(spark.createDataFrame([(3, []), (2, [])], kind))) == plain_trie({3: [], 2: []})
    assert got(T.trie(spark.createDataFrame([(3, [])], kind))) == plain_trie({3: []})
    assert got(T.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))) == []
