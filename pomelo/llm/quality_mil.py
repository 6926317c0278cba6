"""Quality scores by attention-based multiple-instance learning (operator 4).

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage of
the whole text is encoded; gated attention gives each passage a weight, the
weighted sum represents the document, and a logistic unit scores it.  All
weights are learned from document labels alone, by gradient descent on a
bounded sample of labelled rows, each with all passages of its whole text: at
most ``PER_CLASS`` documents per label, taken in the order of their hash, and
of these no more than ``FIT_PASSAGES`` passages per label in all (a document
that no longer fits is left out, the next ones are tried).  Scoring has no
bound: a long text is read in blocks with a running softmax.

A passage's features: frequencies of pairs of neighbouring character classes
(bytes in 16 classes), the share of different words, the share of words equal
to the one before, mean word length and the passage's fill.  Ids, languages,
sources and labels never enter a score.

Cases: null and empty texts are one passage without words; labels that are
null or contradict each other are left out; with labels of one kind only, or
none, every score is that share (0.5 without labels); equal texts have equal
scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pomelo.llm.common import checkpointed, fresh_names
from pomelo.llm.sampling import fold, labelled_sample

PASSAGE_WORDS = 64
PER_CLASS = 3000          # bound of the fitting sample
FIT_PASSAGES = 30_000     # bound of a label's sampled passages (rows of 1 KB on the driver)
BLOCK_PASSAGES = 512      # passages of one text encoded at a time
HIDDEN, GATE = 16, 8
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2

_CLASSES = np.zeros(256, np.int64)
for _name, _bytes in enumerate((
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".,;:", b"!?", b"'\"`",
        b"()[]{}", b"#*", b"$%&", b"|<>", b"/\\_-+=~^@", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0xE0)),
        bytes(range(0xE0, 0x100)), bytes(range(0x20)) + b"\x7f")):
    _CLASSES[list(_bytes)] = _name
N_FEATURES = 256 + 4


def passages(text: str) -> Iterator[np.ndarray]:
    """Features of a text's passages, one block of rows at a time."""
    words = text.encode().split()
    if not words:
        yield np.zeros((1, N_FEATURES), np.float32)
        return
    step = PASSAGE_WORDS * BLOCK_PASSAGES
    for at in range(0, len(words), step):
        block = words[at:at + step]
        lengths = np.fromiter(map(len, block), np.int64, len(block))
        starts = np.arange(0, len(block), PASSAGE_WORDS)
        n = len(starts)
        raw = np.frombuffer(b" ".join(block) + b" ", np.uint8)
        chars = np.add.reduceat(lengths + 1, starts)
        where = np.repeat(np.arange(n), chars)
        classes = _CLASSES[raw]
        pairs = where[:-1] * 256 + classes[:-1] * 16 + classes[1:]
        out = np.empty((n, N_FEATURES), np.float32)
        out[:, :256] = np.bincount(pairs, minlength=n * 256).reshape(n, 256) / chars[:, None]
        size = np.minimum(PASSAGE_WORDS, len(block) - starts)
        out[:, 256] = [len(set(block[s:s + PASSAGE_WORDS])) for s in starts] / size
        same = np.fromiter((a == b for a, b in zip(block, block[1:])), np.float64, len(block) - 1)
        out[:, 257] = np.add.reduceat(np.append(same, 0.0), starts) / size
        out[:, 258] = chars / size / 10
        out[:, 259] = size / PASSAGE_WORDS
        yield out


@dataclass
class Model:
    """Gated attention over encoded passages; ``weights`` None: always ``prior``."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.prior
        w = self.weights
        top, total, z = -np.inf, 0.0, np.zeros(HIDDEN)
        for x in passages(text):
            h = np.tanh(x @ w["W"] + w["b"])
            e = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]
            now = max(top, float(e.max()))
            keep, a = np.exp(top - now), np.exp(e - now)
            total, z, top = total * keep + a.sum(), z * keep + a @ h, now
        return float(_sigmoid(z @ w["c"] / total + w["c0"][0]))


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_arrays(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, prior: float,
               rounds: int = 200, rate: float = 0.02, decay: float = 1e-3, seed: int = 7) -> Model:
    """Fit on passages ``x`` (rows grouped by document, ``sizes`` rows each) and labels ``y``."""
    if len(set(y.tolist())) < 2:
        return Model(prior)
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-2
    x = ((x - mean) / scale).astype(np.float32)
    d = x.shape[1]
    p = {"W": rng.normal(0, d ** -0.5, (d, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "w": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "c0": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    weight = np.where(y == 1, prior / max((y == 1).sum(), 1), (1 - prior) / max((y == 0).sum(), 1))
    for t in range(1, rounds + 1):
        h = np.tanh(x @ p["W"] + p["b"])
        tv, su = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (tv * su) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        a /= np.add.reduceat(a, starts)[doc]
        z = np.add.reduceat(a[:, None] * h, starts)
        g = ((_sigmoid(z @ p["c"] + p["c0"][0]) - y) * weight).astype(np.float32)
        dz = g[:, None] * p["c"]
        da = (dz[doc] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, starts)[doc])
        dt, ds = (de[:, None] * p["w"]) * su * (1 - tv * tv), (de[:, None] * p["w"]) * tv * su * (1 - su)
        dh = (a[:, None] * dz[doc] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        grad = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (tv * su).T @ de,
                "c": z.T @ g, "c0": np.array([g.sum()])}
        for k in p:
            if k not in ("b", "c0"):
                grad[k] = grad[k] + decay * p[k] / len(p[k])
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            s[k] = 0.999 * s[k] + 0.001 * grad[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)
    plain = p["W"] / scale[:, None]               # the scaling of features goes into the first layer
    p |= {"b": p["b"] - mean @ plain, "W": plain}
    return Model(prior, {k: np.asarray(v, np.float32) for k, v in p.items()})


def _fitting(rows: list[tuple], most: int) -> list:
    """Ids of ``(label, hash, id, passages)``, in the order of the hash, while their passages fit in ``most`` a label."""
    left: dict[int, int] = {}
    out = []
    for y, _, name, n in sorted(rows, key=lambda r: (r[0], r[1], str(r[2]))):
        if n <= left.setdefault(y, most):
            left[y] -= n
            out.append(name)
    return out


def _passage_count(text: Column) -> Column:
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([max(1, -(-len(t.encode().split()) // PASSAGE_WORDS)) for t in texts.to_pylist()], pa.int64())
    return count(text)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label: str = "quality", per_class: int = PER_CLASS, passages_per_class: int = FIT_PASSAGES) -> Model:
    """Model from the labelled rows outside the held-out fold (a bounded sample of them, whole texts)."""
    sample, sizes = labelled_sample(docs, labels, label, fold(id_col, FOLDS) != HELD_OUT, per_class, id_col, text_col)
    if len(sizes) < 2:
        return Model(float(next(iter(sizes), 0.5)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                rows.append(b"".join(x.astype(np.float16).tobytes() for x in passages(text)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("y").cast(pa.int32()),
                                              pa.array(rows, pa.binary())], names=["id", "y", "x"])

    sample = checkpointed(sample.select("doc_id", "y", "text"))
    # two numbers for each of at most 2 * per_class documents
    sized = sample.select("y", F.xxhash64("doc_id"), "doc_id", _passage_count(F.col("text"))).collect()
    taken = _fitting([tuple(r) for r in sized], passages_per_class)
    rows = sorted(sample.where(F.col("doc_id").isin(taken)).mapInArrow(features, "id string, y int, x binary").collect())
    bags = [np.frombuffer(r.x, np.float16).reshape(-1, N_FEATURES) for r in rows]
    if not bags:
        return Model(0.5)
    return fit_arrays(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]),
                      np.array([r.y for r in rows]), sizes[1] / (sizes[0] + sizes[1]))


def score_of(text: Column, model: Model) -> Column:
    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t or "") for t in texts.to_pylist()], pa.float64())
    return score(text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score, predicted."""
    model = fit(docs, labels)
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return (docs.select("doc_id", held_out.alias("held_out"), score_of(F.col("text"), model).alias("score"))
            .select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, all columns as they were."""
    model = fit(docs, labels)
    (name,) = fresh_names(docs, "score")
    return docs.withColumn(name, score_of(F.col("text"), model)).where(F.col(name) >= threshold).drop(name)
