"""Toxic spans by a linear-chain conditional random field (operator 7).

Labels mark whole documents, so tokens get theirs first: among labelled
documents (near-copies, by five-word shingles of similarity 0.8, counted once), words and word beginnings that occur in
toxic documents far more often than chance allows, and hardly in others, are
signs; words with a sign in toxic documents are the tagged tokens, all other
tokens are not.  A two-state field with hashed features of a token (the word,
its beginnings and end, its form) is fitted to these by its likelihood.

A text is one chain, whatever its length.  With two states, the forward and
backward passes are recursions of odds.  They run for windows of ``WINDOW``
words of all texts of a batch side by side: a window's product of step
matrices says what it makes of the odds that enter it, so the odds at all
borders of a text follow window by window, and then every window is passed
from its true odds on both sides.  Marginals give the spans (runs at 0.5
or more) and, as the greatest log odds and the expected number of toxic
tokens, the document's score through a logistic unit fitted on the documents.

Fitting reads at most ``PER_CLASS`` documents per label, each as a whole: signs
are counted, sequences tagged and documents summed up in Spark tasks.  The
driver gets keys of near-copies, counts of possible signs, the ``FIT_WINDOWS``
sequences of least hash among all of the sample, and three numbers a document.
Scoring reads every whole text.  Ids, languages, sources and labels never
enter a score (the hash of an id only decides what is sampled).

Cases: null and empty texts have no tokens and the lowest score; labels that
are null or contradict each other are left out; with labels of one kind only,
or none, every score is that share (0.5 without labels) and there are no
spans; equal texts have equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pomelo.llm.common import checkpointed
from pomelo.llm.sampling import fold, labelled_sample

PER_CLASS = {0: 2000, 1: 1000}    # bound of the fitting sample: clean and toxic documents
FIT_WINDOWS = (4000, 6000)  # bound of the sequences, tagged and untagged, that the field is fitted on
FIT_TASKS = 32              # the sample's parts
WINDOW = 64
HASHED = 1 << 16
BEGINNINGS = (3, 4, 5, 6)   # letters of a word's beginnings
MIN_EVIDENCE = 24.0         # a sign's log-likelihood ratio against equal rates (chance below 1e-6)
MAX_CLEAN = 0.02            # its rate in clean documents over that in toxic ones, at most
THRESHOLD = 0.5
SHINGLE_WORDS, SIMILAR = 5, 0.8    # near-copies in the fitting sample
_ORDERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
FOLDS, HELD_OUT = 5, 0
CACHED_WORDS = 300_000      # per worker; beyond it the cache begins anew

_EDGES = ".,;:!?\"'`()[]{}<>*#$%&|~_-+=/\\^@"


def normal(word: str) -> str:
    return word.strip(_EDGES).lower()


def signs_of(word: str) -> list[str]:
    """What may mark a normal word: itself and its beginnings (with a star)."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)]


N_FEATURES = 3 + len(BEGINNINGS)
_STEP, _MIX = np.uint64(1099511628211), np.uint64(0x9E3779B97F4A7C15)


def features(words: list[str]) -> np.ndarray:
    """Hashed features of words as written, one row each; 0 stands for a beginning that a word lacks.

    Polynomial hashes of UTF-8 bytes: whole words, beginnings and the last three bytes."""
    norm = [w.strip(_EDGES).lower() for w in words]
    raw = [w.encode() for w in norm]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    start = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
    power = np.cumprod(np.full(int(size.max(initial=0)) + 1, _STEP, np.uint64))
    at = np.arange(len(flat)) - np.repeat(start, size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * power[at], dtype=np.uint64)])

    def slot(value: np.ndarray, kind: int) -> np.ndarray:
        return (((value + np.uint64(kind)) * _MIX) >> np.uint64(48)).astype(np.int64) % (HASHED - 1) + 1

    out = np.zeros((len(words), N_FEATURES), np.int32)
    out[:, 0] = slot(total[start + size] - total[start], 1)
    tail = np.zeros(len(words), np.uint64)
    for k in (3, 2, 1):
        has = size >= k
        tail[has] = tail[has] * np.uint64(257) + flat[(start + size - k)[has]]
    out[:, 1] = slot(tail, 2)
    form = np.fromiter((a.isupper() + 2 * a.islower() + 4 * b.isalpha() for a, b in zip(words, norm)), np.uint64, len(words))
    out[:, 2] = slot(form, 3)
    for i, k in enumerate(BEGINNINGS):
        has = size >= k
        out[has, 3 + i] = slot(total[start[has] + k] - total[start[has]], 4 + i)
    return out


def shingles(text: str) -> np.ndarray:
    """Hashes of a text's different runs of ``SHINGLE_WORDS`` normal words (fewer: of all of them)."""
    words = [normal(w) for w in text.split()]
    runs = {" ".join(words[i:i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1))}
    return np.array(sorted(xxhash.xxh64_intdigest(r) for r in runs), np.uint64)


def copy_keys(text: str) -> list[str]:
    """What near-copies mostly share: the least shingle hash of each of several orders."""
    h = shingles(text)
    return [f"{k}:{int((h * m).min()):x}" for k, m in enumerate(_ORDERS)]


def similar(a: str, b: str) -> bool:
    """Whether two texts share ``SIMILAR`` of their shingles."""
    x, y = shingles(a), shingles(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILAR * (len(x) + len(y) - both)


def _pairs(keys: Iterable[tuple[object, list[str]]]) -> list[tuple]:
    """``(earlier, later)`` of rows that share a key: each with the first and with the last one before it."""
    met: dict[str, tuple] = {}
    out: dict[tuple, None] = {}
    for name, ks in keys:
        for k in ks:
            if k in met:
                out.update(dict.fromkeys((other, name) for other in met[k]))
            met[k] = (met[k][0] if k in met else name, name)
    return list(out)


def _distinct(texts: list[str]) -> list[str]:
    """Texts without those that are near-copies of an earlier one."""
    copies = {b for a, b in _pairs(enumerate(map(copy_keys, texts))) if similar(texts[a], texts[b])}
    return [t for i, t in enumerate(texts) if i not in copies]


def _words_of(text: str) -> set[str]:
    return {normal(w) for w in text.split()}


def _signs_in(words: set[str]) -> set[str]:
    return {s for w in words if w for s in signs_of(w)}


def find_signs(toxic: list[str], clean: list[str]) -> set[str]:
    """Words and beginnings that mark toxic documents; of nested ones with the same reach, the longest."""
    n = m = 0
    hits: Counter[str] = Counter()
    for d in _distinct(toxic):
        n += 1
        hits.update(_signs_in(_words_of(d)))
    hits = Counter({s: t for s, t in hits.items() if t > 2})       # fewer are never evidence enough
    misses: Counter[str] = Counter()
    for d in _distinct(clean):
        m += 1
        misses.update(s for s in _signs_in(_words_of(d)) if s in hits)
    return signs_by_count(hits, misses, n, max(m, 1))


def _evidence(t: int, c: int, n: int, m: int) -> float:
    """Log-likelihood ratio of ``t`` in ``n`` toxic and ``c`` in ``m`` clean documents against equal rates."""
    both = (t + c) / (n + m)
    part = lambda k, size, p: (k * np.log(k / size / p) if k else 0.0) + (
        (size - k) * np.log((1 - k / size) / (1 - p)) if k < size and p < 1 else 0.0)
    return 2 * (part(t, n, both) + part(c, m, both))


def signs_by_count(hits: dict[str, int], misses: dict[str, int], n: int, m: int) -> set[str]:
    """Signs by the number of toxic (``hits`` of ``n``) and clean documents (``misses`` of ``m``) with them."""
    fit = {s: t for s, t in hits.items()
           if misses[s] / m <= MAX_CLEAN * t / n and _evidence(t, misses[s], n, m) >= MIN_EVIDENCE}
    longer: dict[str, int] = {}        # the greatest reach of what extends a beginning
    for s, t in fit.items():
        word = s.rstrip("*")
        for k in BEGINNINGS:
            if k < len(word) or (k == len(word) and not s.endswith("*")):
                longer[word[:k] + "*"] = max(t, longer.get(word[:k] + "*", 0))
    return {s for s, t in fit.items() if longer.get(s, 0) < 0.98 * t}


@dataclass
class Crf:
    """``emission``: log odds of a hashed feature; ``start`` and ``step``: log odds and log potentials."""

    prior: float
    emission: np.ndarray | None = None
    start: float = 0.0
    step: np.ndarray | None = None      # 2 x 2, from state to state
    unit: np.ndarray | None = None      # bias, greatest log odds, expected tokens

    def marginals(self, e: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Log odds of state 1; ``e`` (tokens, sequences) holds emission log odds, ``mask`` the real tokens."""
        return self.passed(np.exp(np.clip(e, -30, 30)), mask, np.full(e.shape[1], np.nan), np.ones(e.shape[1]))

    def passed(self, w: np.ndarray, mask: np.ndarray, enter: np.ndarray, leave: np.ndarray) -> np.ndarray:
        """Log odds of state 1 of sequences between the forward odds that ``enter`` (NaN: a text begins)
        and the backward odds that ``leave`` has after them; ``w`` are emission odds."""
        (t00, t01), (t10, t11) = np.exp(self.step)
        out = np.empty_like(w)
        r = out[0] = w[0] * np.where(np.isnan(enter), np.exp(self.start), (t01 + enter * t11) / (t00 + enter * t10))
        for j in range(1, len(w)):
            r = out[j] = w[j] * (t01 + r * t11) / (t00 + r * t10)
        b = leave
        out[-1] *= b
        for j in range(len(w) - 2, -1, -1):
            x = w[j + 1] * b
            b = np.where(mask[j + 1], (t10 + x * t11) / (t00 + x * t01), leave)
            out[j] *= b
        return np.log(out)

    def borders(self, w: np.ndarray, mask: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``enter`` and ``leave`` of windows that follow each other in texts; ``rank``: a window's place in its text."""
        p = np.exp(self.step)
        n = w.shape[1]
        enter, leave = np.full(n, np.nan), np.ones(n)
        more = np.flatnonzero((rank > 0) | np.append(rank[1:] > 0, False))        # windows of texts that have several
        if not len(more):
            return enter, leave
        # products of the step matrices, rows from, columns to; the first word of a text has no step
        m = np.zeros((2, 2, len(more)))
        m[0, 0] = m[1, 1] = 1.0
        first = rank[more] == 0
        for j in range(len(w)):
            emit = w[j, more]
            x = np.stack([m[:, 0] * p[0, 0] + m[:, 1] * p[1, 0], (m[:, 0] * p[0, 1] + m[:, 1] * p[1, 1]) * emit], 1)
            x /= x.sum((0, 1))
            still = ~mask[j, more] | (first if j == 0 else False)
            m = np.where(still, m, x)
        # from window to window: in every step one window of each text
        of_rank = np.argsort(rank[more], kind="stable")
        cuts = np.searchsorted(rank[more][of_rank], np.arange(rank.max() + 2))
        steps = [of_rank[a:b] for a, b in zip(cuts, cuts[1:])]
        odds = np.exp(self.start) * w[0, more]                                    # after the first word
        for here in steps:
            k = more[here]
            into = np.where(first[here], odds[here], enter[k])
            after = (m[0, 1, here] + into * m[1, 1, here]) / (m[0, 0, here] + into * m[1, 0, here])
            has_next = np.append(rank[1:] > 0, False)[k]
            enter[k[has_next] + 1] = after[has_next]
        for here in reversed(steps):
            back = here[rank[more[here]] > 0]
            k = more[back]
            x = leave[k]
            leave[k - 1] = (m[1, 0, back] + x * m[1, 1, back]) / (m[0, 0, back] + x * m[0, 1, back])
        return enter, leave


def fit_crf(seqs: np.ndarray, mask: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.3,
            decay: float = 1e-6) -> Crf:
    """Maximum likelihood on ``seqs`` (sequences, tokens, features), ``mask`` of real tokens and tags ``y``.

    Padding stands at the ends, with features that are never counted and an emission of zero.
    """
    emission, start, step = np.zeros(HASHED), -2.0, np.array([[0.5, -0.5], [-0.5, 0.5]])
    n, length, k = seqs.shape
    flat, m = seqs[mask], mask.astype(np.float32)
    used, index = np.unique(flat, return_inverse=True)
    index = index.reshape(flat.shape)
    moments = [np.zeros(len(used)), np.zeros(5)]
    squares = [np.zeros(len(used)), np.zeros(5)]
    theta = [np.zeros(len(used)), np.concatenate([[start], step.ravel()])]
    pair_mask = m[:, 1:] * m[:, :-1]
    state = np.stack([1 - y, y], -1)
    seen = np.einsum("ntf,ntg,nt->fg", state[:, :-1], state[:, 1:], pair_mask)
    for t in range(1, rounds + 1):
        e = np.zeros((n, length), np.float32)
        e[mask] = theta[0][index].sum(1)
        w, p = np.exp(np.clip(e, -30, 30)), np.exp(theta[1][1:].reshape(2, 2)).astype(np.float32)
        # scaled forward and backward messages
        a, b = np.empty((n, length, 2), np.float32), np.ones((n, length, 2), np.float32)
        a[:, 0] = np.stack([np.ones(n), np.exp(theta[1][0]) * w[:, 0]], -1)
        a[:, 0] /= a[:, 0].sum(-1, keepdims=True)
        for j in range(1, length):
            x = a[:, j - 1] @ p
            x[:, 1] *= w[:, j]
            a[:, j] = np.where(mask[:, j, None], x / x.sum(-1, keepdims=True), a[:, j - 1])
        for j in range(length - 2, -1, -1):
            x = b[:, j + 1].copy()
            x[:, 1] *= w[:, j + 1]
            x = x @ p.T
            b[:, j] = np.where(mask[:, j + 1, None], x / x.sum(-1, keepdims=True), 1.0)
        g = a * b
        g /= g.sum(-1, keepdims=True)
        after = b[:, 1:].copy()
        after[..., 1] *= w[:, 1:]
        pairs = a[:, :-1, :, None] * p * after[:, :, None, :]
        pairs = (pairs / pairs.sum((-1, -2), keepdims=True) * pair_mask[..., None, None]).sum((0, 1))
        gap = (g[..., 1] - y)[mask]
        total = mask.sum()
        grads = [np.bincount(index.ravel(), np.repeat(gap, k), len(used)) / total + decay * theta[0],
                 np.concatenate([[(g[:, 0, 1] - y[:, 0]).sum()], (pairs - seen).ravel()]) / total]
        for i in range(2):
            moments[i] = 0.9 * moments[i] + 0.1 * grads[i]
            squares[i] = 0.99 * squares[i] + 0.01 * grads[i] ** 2
            theta[i] = theta[i] - rate * (moments[i] / (1 - 0.9 ** t)) / (np.sqrt(squares[i] / (1 - 0.99 ** t)) + 1e-7)
    emission[used] = theta[0]
    return Crf(0.5, emission, float(theta[1][0]), theta[1][1:].reshape(2, 2))


class Tagger:
    """A fitted field on one worker, with the emissions of the words it has met."""

    def __init__(self, crf: Crf):
        self.crf, self.known = crf, {}

    def meet(self, words: list[list[str]]) -> None:
        """Emission log odds of the words that are new."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = list(set().union(*words).difference(self.known))
        if new:
            self.known.update(zip(new, self.crf.emission[features(new)].sum(1).tolist()))

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """Log odds of every word of each text."""
        words = [t.split() for t in texts]
        self.meet(words)
        sizes = np.array([len(w) for w in words], np.int64)
        rows = np.concatenate([[0], np.cumsum(-(-sizes // WINDOW))])
        e = np.zeros(rows[-1] * WINDOW)
        mask = np.zeros(len(e), bool)
        for w, at in zip(words, rows * WINDOW):
            e[at:at + len(w)] = np.fromiter(map(self.known.__getitem__, w), np.float64, len(w))
            mask[at:at + len(w)] = True
        w, mask = np.exp(np.clip(e, -30, 30)).reshape(-1, WINDOW).T, mask.reshape(-1, WINDOW).T
        rank = np.arange(rows[-1]) - np.repeat(rows[:-1], np.diff(rows))
        enter, leave = self.crf.borders(w, mask, rank)
        out = np.empty((rows[-1], WINDOW))
        for lo in range(0, len(out), 4096):
            part = slice(lo, lo + 4096)
            out[part] = self.crf.passed(np.ascontiguousarray(w[:, part]), np.ascontiguousarray(mask[:, part]),
                                        enter[part], leave[part]).T
        flat = out.reshape(-1)
        return [flat[at:at + n] for at, n in zip(rows * WINDOW, sizes)]

    def score(self, odds: np.ndarray) -> float:
        x = _summary(odds) @ self.crf.unit
        return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def _summary(odds: np.ndarray) -> np.ndarray:
    if not len(odds):
        return np.array([1.0, -12.0, 0.0])
    p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return np.array([1.0, np.clip(odds.max(), -12, 12), np.log1p(p[p >= 0.05].sum())])


def fit_unit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        grad = x.T @ (weight * (p - y)) + ridge * b
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        move = np.linalg.solve(hess, grad)
        b -= move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
    return b


def windows_of(name: str, text: str, toxic: bool, signed: Callable[[str], bool]) -> Iterator[tuple]:
    """(untagged, hash, name, place, words, tags) of every sequence of a text."""
    words = text.split()
    for i in range(0, len(words), WINDOW):
        part = words[i:i + WINDOW]
        marks = [toxic and signed(w) for w in part]
        key = int.from_bytes(hashlib.blake2b(f"{name}:{i}".encode(), digest_size=7).digest())
        yield not any(marks), key, name, i, " ".join(part), marks


def _least(windows: Iterable[tuple]) -> list[tuple]:
    """Of tagged and untagged sequences, the ``FIT_WINDOWS`` of least hash each."""
    kept: tuple[list, list] = ([], [])          # heaps, the greatest hash on top
    for w in windows:
        heap, most = kept[w[0]], FIT_WINDOWS[w[0]]
        item = (-w[1], w)
        if len(heap) < most:
            heapq.heappush(heap, item)
        elif heap and item > heap[0]:
            heapq.heapreplace(heap, item)
    return sorted(w for heap in kept for _, w in heap)


def _signed(signs: set[str]) -> Callable[[str], bool]:
    known: dict[str, bool] = {}

    def signed(word: str) -> bool:
        if word not in known:
            if len(known) > CACHED_WORDS:
                known.clear()
            known[word] = not signs.isdisjoint(signs_of(normal(word)))
        return known[word]

    return signed


def fit_windows(windows: list[tuple], prior: float) -> Crf:
    """The field, without its document unit, from (..., words, tags) of sequences."""
    seqs = np.zeros((len(windows), WINDOW, N_FEATURES), np.int32)
    tag = np.zeros((len(windows), WINDOW))
    mask = np.arange(WINDOW) < np.array([len(w[-1]) for w in windows])[:, None]
    for i, (*_, words, marks) in enumerate(windows):
        seqs[i, :len(marks)], tag[i, :len(marks)] = features(words.split()), marks
    crf = fit_crf(seqs, mask, tag)
    crf.prior = prior
    return crf


def _summaries(texts: list[str], tagger: Tagger) -> list[np.ndarray]:
    return [_summary(o) for at in range(0, len(texts), 20) for o in tagger.tag(texts[at:at + 20])]


def _with_unit(crf: Crf, summaries: np.ndarray, y: np.ndarray) -> Crf:
    weight = np.where(y == 1, crf.prior / (y == 1).sum(), (1 - crf.prior) / (y == 0).sum()) * len(y)
    crf.unit = fit_unit(summaries, y, weight)
    return crf


def fit_texts(texts: list[str], y: np.ndarray, prior: float) -> Crf:
    """Field and document unit from labelled documents in memory; ``fit`` does the same in Spark tasks."""
    if len(set(y.tolist())) < 2:
        return Crf(prior)
    signs = find_signs(*([t for t, k in zip(texts, y) if k == kind] for kind in (1, 0)))
    if not signs:
        return Crf(prior)
    signed = _signed(signs)
    crf = fit_windows(_least(w for i, (t, k) in enumerate(zip(texts, y)) for w in windows_of(str(i), t, k == 1, signed)), prior)
    return _with_unit(crf, np.array(_summaries(texts, Tagger(crf))), y)


def _strings(of: Callable[[str], Iterable[str]]) -> Column:
    """``of`` each text, as an array."""
    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([list(of(t)) for t in texts.to_pylist()], pa.list_(pa.string()))

    return run("text")


def _near_copies(sample: DataFrame, pairs: list[tuple[str, str]]) -> set[str]:
    """The later ones of the pairs whose texts are similar; at most a few pairs for each sampled document."""
    if not pairs:
        return set()

    @F.arrow_udf("boolean")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([similar(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    texts = sample.select("doc_id", "text")
    both = (sample.sparkSession.createDataFrame(pairs, "a string, b string").repartition(FIT_TASKS)
            .join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b"))
    return {r.b for r in both.where(alike("x", "y")).select("b").distinct().collect()}


def _mined(sample: DataFrame) -> set[str]:
    """``find_signs`` of ``sample (doc_id, y, text)``; the driver gets keys, near-copies and counts."""
    rows = sorted(sample.select("doc_id", "y", _strings(copy_keys).alias("keys")).collect())
    pairs = _pairs((r.doc_id, [f"{r.y}:{k}" for k in r["keys"]]) for r in rows)
    copies = _near_copies(sample, pairs)
    kept = Counter(r.y for r in rows if r.doc_id not in copies)
    n, m = kept[1], max(kept[0], 1)
    # a sign has this many toxic documents at least: with clean ones there is less evidence
    enough = next((t for t in range(3, n + 1) if _evidence(t, 0, n, m) >= MIN_EVIDENCE), n + 1)
    signs = _strings(lambda t: _signs_in(_words_of(t)))
    counts = (sample.where(~F.col("doc_id").isin(sorted(copies))).select("y", F.explode(signs).alias("sign"))
              .groupBy("sign").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
              .where((F.col("t") >= enough) & (F.col("c") * n <= 1.001 * MAX_CLEAN * m * F.col("t"))).collect())
    return signs_by_count({r.sign: r.t for r in counts}, {r.sign: r.c for r in counts}, n, m)


def _chosen(sample: DataFrame, signs: set[str]) -> list[tuple]:
    """``_least`` of the sequences of all of ``sample``."""
    names = ["plain", "key", "name", "place", "words", "marks"]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = _signed(signs)
        rows = _least(w for b in batches for name, y, text in zip(*(c.to_pylist() for c in b.columns))
                      for w in windows_of(name, text, y == 1, signed))
        kinds = [pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.bool_())]
        for at in range(0, len(rows), 1000):
            columns = zip(*rows[at:at + 1000])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    some = checkpointed(sample.select("doc_id", "y", "text").mapInArrow(
        choose, "plain boolean, key long, name string, place long, words string, marks array<boolean>"))
    # cut to the bound in a task, so that no more reaches the driver
    least = [some.where(F.col("plain") == bool(k)).orderBy("key", "name", "place").limit(FIT_WINDOWS[k]) for k in (0, 1)]
    return sorted(map(tuple, checkpointed(least[0].unionByName(least[1])).collect()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label: str = "toxic", per_class: dict[int, int] = PER_CLASS) -> Crf:
    """The field, fitted on labelled rows outside the held-out fold (a bounded sample of them, whole texts)."""
    sample, sizes = labelled_sample(docs, labels, label, fold(id_col, FOLDS) != HELD_OUT, per_class, id_col, text_col)
    if len(sizes) < 2:
        return Crf(float(next(iter(sizes), 0.5)))
    sample = checkpointed(sample.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
                          .repartition(FIT_TASKS, "doc_id"))
    found = {r.y for r in sample.select("y").distinct().collect()}
    if not found:
        return Crf(0.5)
    prior = sizes[1] / (sizes[0] + sizes[1])
    signs = _mined(sample) if len(found) == 2 else set()
    if not signs:
        return Crf(prior)
    crf = fit_windows(_chosen(sample, signs), prior)

    @F.arrow_udf("array<double>")
    def summary(texts: pa.Array) -> pa.Array:
        return pa.array([x.tolist() for x in _summaries(texts.to_pylist(), Tagger(crf))], pa.list_(pa.float64()))

    rows = sorted(sample.select("doc_id", "y", summary("text").alias("x")).collect())
    return _with_unit(crf, np.array([r.x for r in rows]), np.array([r.y for r in rows]))


def _spans(text: str, odds: np.ndarray) -> list[dict]:
    """Runs of words at 0.5 or more, in code points."""
    on = np.flatnonzero(odds >= 0)
    if not len(on):
        return []
    places = [m.span() for m in re.finditer(r"\S+", text)]
    runs = np.split(on, np.flatnonzero(np.diff(on) > 1) + 1)
    return [{"start": places[r[0]][0], "end": places[r[-1]][1],
             "marginal": float(1 / (1 + np.exp(-min(odds[r].max(), 40.0))))} for r in runs]


def tagged(text: Column, crf: Crf) -> Column:
    """Struct of ``score`` and ``spans`` (start, end, marginal) of a text."""
    kind = "struct<score: double, spans: array<struct<start: long, end: long, marginal: double>>>"

    @F.arrow_udf(kind)
    def tag(texts: pa.Array) -> pa.Array:
        rows = [t or "" for t in texts.to_pylist()]
        if crf.emission is None:
            scores, spans = [crf.prior] * len(rows), [[] for _ in rows]
        else:
            tagger = taggers.setdefault(0, Tagger(crf))
            odds = tagger.tag(rows)
            scores = [tagger.score(o) for o in odds]
            spans = [_spans(t, o) for t, o in zip(rows, odds)]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                                          names=["score", "spans"])

    taggers: dict[int, Tagger] = {}       # filled on each worker
    return tag(text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score, predicted, and the offending spans."""
    crf = fit(docs, labels)
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return (docs.select("doc_id", held_out.alias("held_out"), tagged(F.col("text"), crf).alias("t"))
            .select("doc_id", "held_out", F.col("t.score").alias("score"),
                    (F.col("t.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("t.spans").alias("spans")))
