"""Operator 7: marginals against enumeration, held-out accuracy, spans, odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest

from pomelo.llm import toxicity_crf as X
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    crf = X.Crf(0.5, start=-0.7, step=rng.normal(size=(2, 2)))
    lengths = [1, 2, 5, 8]
    e = rng.normal(size=(8, 4)) * 2
    mask = np.arange(8)[:, None] < np.array(lengths)
    got = crf.marginals(e, mask)
    for s, n in enumerate(lengths):
        weight = {}
        for tags in itertools.product((0, 1), repeat=n):
            w = tags[0] * crf.start + sum(t * e[i, s] for i, t in enumerate(tags))
            weight[tags] = np.exp(w + sum(crf.step[a, b] for a, b in zip(tags, tags[1:])))
        for i in range(n):
            one = sum(w for t, w in weight.items() if t[i])
            assert got[i, s] == pytest.approx(np.log(one / (sum(weight.values()) - one)), abs=1e-9)


def test_fit_raises_the_likelihood_of_the_tags():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    texts = [[rng.choice(words) for _ in range(40)] for _ in range(200)]
    y = np.array([i % 2 for i in range(200)])
    for t, toxic in zip(texts, y):
        if toxic:
            t[rng.randrange(40)] = "vile" + rng.choice("abcdef")
    crf = X.fit_texts([" ".join(t) for t in texts], y, 0.5)
    tagger = X.Tagger(crf)
    odds = tagger.tag([" ".join(t) for t in texts])
    for t, o, toxic in zip(texts, odds, y):
        assert [w.startswith("vile") for w in t] == (o >= 0).tolist()
        assert (tagger.score(o) >= 0.5) == toxic
    new = tagger.tag(["w1 w2 (VILEq) w3", "w1 w2"])
    assert tagger.score(new[1]) < 0.5 and new[0].argmax() == 2


def test_near_copies_make_no_signs():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(5000)]
    clean = [" ".join(rng.choices(words, k=80)) for _ in range(300)]
    one = rng.choices(words, k=80)
    copies = [" ".join(one[:-1] + [rng.choice(words)]) for _ in range(200)]
    toxic = [" ".join(rng.choices(words, k=80) + ["nasty"]) for _ in range(60)] + copies
    assert X.find_signs(toxic, clean) == {"nasty"}


def test_different_texts_with_equal_keys_are_both_kept(spark, monkeypatch):
    """Keys only propose near-copies; similarity decides."""
    prepare(spark)
    monkeypatch.setattr(X, "copy_keys", lambda text: ["the same"])
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(40)]
    near = texts[11].split()
    near[30] = "other"
    assert X.similar(texts[11], " ".join(near)) and not X.similar(texts[0], texts[1])
    assert X._distinct(texts) == texts and X._distinct([*texts, texts[-1]]) == texts
    assert X.similar("a b", "a b") and not X.similar("a b", "a c") and X.similar("", " ")
    df = spark.createDataFrame([(str(i).zfill(3), 0, t) for i, t in enumerate([*texts, texts[-1], " ".join(near)])], "doc_id string, y int, text string")
    rows = [(r.doc_id, ["k"]) for r in df.orderBy("doc_id").collect()]
    pairs = X._pairs(rows) + [("011", "041")]
    assert X._near_copies(df, pairs) == {"040", "041"}


def plain_chain(crf, e):
    """Log odds by forward and backward messages over one whole sequence."""
    p = np.exp(crf.step)
    a, b = np.zeros((len(e), 2)), np.ones((len(e), 2))
    for i, x in enumerate(np.exp(e)):
        a[i] = (np.array([1, np.exp(crf.start)]) if i == 0 else a[i - 1] @ p) * [1, x]
        a[i] /= a[i].sum()
    for i in range(len(e) - 2, -1, -1):
        b[i] = p @ (b[i + 1] * [1, np.exp(e[i + 1])])
        b[i] /= b[i].sum()
    return np.log(a[:, 1] * b[:, 1]) - np.log(a[:, 0] * b[:, 0])


def test_a_text_is_one_chain(spark):
    """Windows change nothing, spans over their borders included; so for the query's scores."""
    rng = np.random.default_rng(5)
    crf = X.Crf(0.5, np.zeros(X.HASHED), -1.0, np.array([[1.5, -1.5], [-2.0, 2.5]]), np.array([0.1, 0.5, 0.3]))
    tagger = X.Tagger(crf)
    vocabulary = [f"w{k}" for k in range(50)]
    tagger.known = dict(zip(vocabulary, rng.normal(-0.5, 2, 50).tolist()))
    sizes = [0, 1, 63, 64, 65, 128, 129, 1000, 5, 64 * 7]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in sizes]
    for text, got in zip(texts, tagger.tag(texts)):
        want = plain_chain(crf, np.array([tagger.known[w] for w in text.split()])) if text else np.zeros(0)
        assert np.allclose(got, want, atol=1e-8)
    # strong words up to the border carry over it
    tagger.known = {"calm": -0.2, "vile": 6.0}
    odds = tagger.tag([" ".join(["calm"] * 60 + ["vile"] * 4 + ["calm"] * 60)])[0]
    assert odds[64] > -1 and odds[64] > odds[66] > odds[70]

    prepare(spark)
    from pomelo.llm.queries import QUERIES
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    crf = X.fit(docs, table(spark, "/root/testdata/sf0.01", "labels"))
    got = {r.doc_id: r.score for r in QUERIES["op7_crf_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    for r in docs.collect():
        words = (r.text or "").split()
        odds = plain_chain(crf, crf.emission[X.features(words)].sum(1).clip(-30, 30)) if words else np.zeros(0)
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-X._summary(odds) @ crf.unit)), abs=1e-6)


def test_held_out_toxicity_and_spans(spark):
    from pomelo.llm.queries import QUERIES
    rows = QUERIES["op7_crf_toxicity"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    assert len(rows) == len(docs)
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    s, y, p = [], [], []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        for span in r.spans:
            part = docs[r.doc_id][span.start:span.end]
            assert part and part == part.strip() and 0.5 <= span.marginal <= 1
        if r.held_out and r.doc_id in labels:
            s.append(r.score), y.append(labels[r.doc_id]), p.append(r.predicted)
    s, y, p = map(np.array, (s, y, p))
    assert (p == y).mean() >= 0.97
    assert (p[y == 0] == 0).mean() >= 0.99


def test_odd_rows(spark):
    prepare(spark)
    texts = ["", None, " \n", "plain words of a text " * 30, "you total idiotx here " * 5, "é idiotx!", "word " * 80_000 + "idiotx"]
    rng = random.Random(6)
    some = [" ".join(rng.choices([f"word{k}" for k in range(500)], k=30)) + " idiotx" * (i % 2) for i in range(80)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(some)] + [(100 + i, t, "s", 1) for i, t in enumerate(texts)]
                                 + [(104, texts[4], "s", 1), (None, texts[5], None, None)], "doc_id long, text string, spans string, score int")
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(80)] + [(4, 1, 1), (7, 0, None), (None, None, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = X.report(docs, labels).collect()
    assert len(rows) == 89
    by = {r.doc_id: r for r in rows}
    assert by[100].score == by[101].score == by[102].score == min(r.score for r in rows) and by[100].spans == []
    assert by[104].predicted == 1 and by[103].predicted == 0
    span = by[None].spans[0]
    assert texts[5][span.start:span.end] == "idiotx!"
    last = by[106].spans[-1]
    assert texts[6][last.start:last.end] == "idiotx"


def test_fitting_reads_whole_texts(spark):
    prepare(spark)
    rng = random.Random(9)
    plain = [f"{k}word" for k in range(50_000)]
    texts = [rng.choices(plain, k=2600) for _ in range(160)]
    for t in texts[1::2]:
        t[2500:2500] = ["idiotx", "and", "idiotx"]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, toxic int")
    for r in X.report(docs, labels).collect():
        words = [" ".join(texts[r.doc_id])[a.start:a.end] for a in r.spans]
        assert r.predicted == r.doc_id % 2 and (words != []) == bool(r.predicted) and all("idiotx" in w for w in words)


def test_fitting_in_tasks_equals_fitting_in_memory(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(X, "FIT_WINDOWS", (40, 50))
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"word{k}" for k in range(300)], k=200) + ["vilest"] * (i % 2) * 3) for i in range(150)]
    names = sorted(str(i) for i in range(150) if zlib.crc32(str(i).encode()) % X.FOLDS != X.HELD_OUT)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    crf = X.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id long, toxic int"))
    y = np.array([int(i) % 2 for i in names])
    signed = X._signed(X.find_signs(*[[texts[int(i)] for i in names if int(i) % 2 == k] for k in (1, 0)]))
    windows = [w for i in names for w in X.windows_of(i, texts[int(i)], int(i) % 2 == 1, signed)]
    few = [w for k in (0, 1) for w in sorted(w for w in windows if w[0] == k)[:X.FIT_WINDOWS[k]]]
    want = X.fit_windows(few, y.mean())
    assert np.allclose(crf.emission, want.emission) and np.allclose(crf.step, want.step)
    assert np.allclose(crf.unit, X._with_unit(want, np.array(X._summaries([texts[int(i)] for i in names], X.Tagger(want))), y).unit)


@pytest.mark.parametrize("rows, want", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_labels_of_one_kind_or_none(spark, rows, want):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a"), (4, "b")], "doc_id long, text string")
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    assert {r.score for r in X.report(docs, labels).collect()} == {want}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    assert X.report(docs, labels).count() == 0
