"""Operator 4: held-out accuracy, gradients, and defined results for odd rows."""

import zlib

import numpy as np
import pytest

from pomelo.llm import quality_mil as Q
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def auc(scores, y):
    rank = np.empty(len(scores))
    rank[np.argsort(scores)] = np.arange(len(scores))
    n1 = int(y.sum())
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_quality(spark):
    from pomelo.llm.queries import QUERIES
    rows = QUERIES["op4_attention_mil"](spark, SF).collect()
    docs = table(spark, SF, "documents")
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    s, y, p = map(np.array, zip(*held))
    assert (p == y).mean() >= 0.95
    assert auc(s, y) >= 0.95


def test_passages_cover_whole_texts_in_blocks(monkeypatch):
    text = "\n".join(f"Word{i} again again, é!" for i in range(900))
    whole = np.concatenate(list(Q.passages(text)))
    assert len(whole) == -(-len(text.split()) // Q.PASSAGE_WORDS)
    rng = np.random.default_rng(0)
    y = np.array([0, 1] * 20)
    x = rng.normal(0, 1, (80, Q.N_FEATURES)).astype(np.float32) + np.repeat(y, 2)[:, None]
    model = Q.fit_arrays(x, np.full(40, 2), y, 0.5)
    one = model.score(text)
    monkeypatch.setattr(Q, "BLOCK_PASSAGES", 3)
    assert model.score(text) == pytest.approx(one, abs=1e-6)


def test_attention_finds_the_one_bad_passage():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 12, 300)
    y = rng.integers(0, 2, 300)
    bags = []
    for n, good in zip(sizes, y):
        x = rng.normal(0, 1, (n, Q.N_FEATURES))
        if not good:
            x[rng.integers(0, n), :4] += 6
        bags.append(x)
    model = Q.fit_arrays(np.concatenate(bags).astype(np.float32), sizes, y, float(y.mean()))
    w = model.weights

    def score(x):
        h = np.tanh(x @ w["W"] + w["b"])
        e = (np.tanh(h @ w["V"]) * Q._sigmoid(h @ w["U"])) @ w["w"]
        a = np.exp(e - e.max())
        return float(Q._sigmoid(a @ h / a.sum() @ w["c"] + w["c0"][0]))

    assert np.mean([(score(b) >= 0.5) == g for b, g in zip(bags, y)]) > 0.95


def test_fitting_reads_every_passage_of_its_documents(spark, monkeypatch):
    """A bad section anywhere in a long text is seen; the bound leaves out whole documents, not parts of them."""
    prepare(spark)
    plain = " ".join(f"word{i}" for i in range(Q.PASSAGE_WORDS))
    long = " ".join([plain] * 40 + [" ".join(["#|%"] * Q.PASSAGE_WORDS)] + [plain] * 59)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, long if k % 2 else plain) for k, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(Q, "fit_arrays", lambda x, sizes, y, prior: seen.append((x, sizes, y)) or Q.Model(prior))
    Q.fit(docs, labels)
    x, sizes, y = seen.pop()
    assert sorted(sizes.tolist()) == [1] * (y == 1).sum() + [100] * (y == 0).sum() and len(sizes) == len(ids)
    want = np.concatenate(list(Q.passages(long))).astype(np.float16)
    at = np.cumsum(sizes) - sizes
    for k in np.flatnonzero(y == 0):
        assert (x[at[k]:at[k] + 100].astype(np.float16) == want).all()
    Q.fit(docs, labels, passages_per_class=250)
    _, sizes, y = seen.pop()
    assert sizes[y == 0].tolist() == [100, 100] and sizes[y == 1].tolist() == [1] * int((y == 1).sum()) and (y == 1).sum() > 2


def test_query_scores_are_the_softmax_over_all_passages(spark):
    from pomelo.llm.queries import QUERIES
    docs = table(spark, SF, "documents")
    w = Q.fit(docs, table(spark, SF, "labels")).weights
    got = {r.doc_id: r.score for r in QUERIES["op4_attention_mil"](spark, SF).collect()}
    for r in docs.collect():
        x = np.concatenate(list(Q.passages(r.text or ""))).astype(np.float64)
        assert len(x) == max(1, -(-len((r.text or "").split()) // Q.PASSAGE_WORDS))
        h = np.tanh(x @ w["W"] + w["b"])
        e = (np.tanh(h @ w["V"]) * Q._sigmoid(h @ w["U"])) @ w["w"]
        a = np.exp(e - e.max())
        assert got[r.doc_id] == pytest.approx(float(Q._sigmoid(a @ h / a.sum() @ w["c"] + w["c0"][0])), abs=1e-5)


def test_odd_rows(spark):
    prepare(spark)
    texts = ["", None, "good plain words here " * 30, "bad### bad%%% " * 40, "x", "long " * 50000]
    docs = spark.createDataFrame([(i, texts[i % 6], "s", 0.5) for i in range(48)] + [(2, texts[2], "s", 0.1)] * 2
                                 + [(None, "no id", None, None)], "doc_id long, text string, score string, y double")
    labels = spark.createDataFrame([(i, int(i % 6 != 3), None) for i in range(48)] + [(2, 0, None), (None, 1, None), (5, None, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = Q.report(docs, labels).collect()
    assert len(rows) == 51
    by_text = {}
    for r in rows:
        if r.doc_id is not None:
            by_text.setdefault(texts[r.doc_id % 6] or "", set()).add(round(r.score, 9))
    assert all(len(s) == 1 for s in by_text.values())
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = {r.doc_id % 6 for r in kept.where("doc_id is not null").collect()}
    assert 2 in good and 3 not in good


@pytest.mark.parametrize("rows, want", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_labels_of_one_kind_or_none(spark, rows, want):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a"), (4, "b")], "doc_id long, text string")
    rows = [(i, y) for i, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    assert {r.score for r in Q.report(docs, labels).collect()} == {want}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, quality int")
    assert Q.report(docs, labels).count() == 0
