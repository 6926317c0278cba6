"""Secret scans with one combined deterministic automaton (operator 3).

All rules are regexes over bytes.  They become one automaton: Thompson
fragments, subset construction over classes of bytes that no rule tells
apart, and minimisation; the result is a transition array.  A batch of texts,
a reset byte between them, is scanned for all rules in one byte pass.  The
pass runs on equal chunks side by side, each as if it began in the start
state; then, chunk by chunk, the bytes before the true path meets the assumed
one are put right, so the states are those of a scan from the first byte.

An accepting state names the rules that have a match ending there.  For each
rule, the match is the leftmost one from the end of the one before: a
reversed automaton reads back from the first end to the start, a forward one
reads on to the last end.  This needs rules whose first end belongs to their
leftmost match, which the tests hold against ``re``.  A rule may name what its
match runs on to (a key block's END line): only its head is in the automaton,
and from a head found the next run of hyphens is looked up and tested, so an
open head costs nothing while scanning.

The automata are compiled once, by the driver, and shared with the workers as
arrays.

Cases: null and empty texts have no spans; offsets count code points, end
exclusive; equal rows are scanned each on their own; an empty table gives an
empty result.  A text of any length is scanned in blocks of bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.llm.common import fresh_names

RESET = 0xFF           # stands between texts; no UTF-8 text has it
CHUNK = 512
LONG_RUNS = 8          # states, per block, for which a match longer than a chunk is stepped over arrays
_HYPHENS = re.compile(rb"-*")
BLOCK = 1 << 20        # bytes scanned at a time


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex, and the least length of the match and of its value.

    With ``until``, a match of ``head`` extends over all that has no run of five
    hyphens to the next such run, if ``until`` follows that."""

    kind: str
    head: str
    least: int = 1
    least_value: int = 0
    until: str = ""

    @property
    def pattern(self) -> str:
        """The whole match as one regex."""
        return self.head + (rf"((-{{0,4}}[^-])*-{{5,}}{self.until})?" if self.until else "")


# The first three are the base rules; their kinds are listed in this order.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         least_value=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    # from the BEGIN line over all that has no run of five hyphens to the END line; without one, the BEGIN line
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH |PGP |ENCRYPTED )?PRIVATE KEY( BLOCK)?-----",
         until=r"END (RSA |EC |DSA |OPENSSH |PGP |ENCRYPTED )?PRIVATE KEY( BLOCK)?-----"),
)
BASE_KINDS = ("assign", "access", "hex")


# -- regexes: concatenation, |, (...), (?i:...), classes, ? * + {m} {m,} {m,n}, escapes ------------

class _Parser:
    """Reads a pattern into nested tuples: ("set", bytes), ("cat", parts), ("or", parts), ("rep", part, m, n)."""

    def __init__(self, pattern: str):
        self.s, self.i, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.s[self.i:self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            part = self.atom()
            while (q := self.peek()) and q in "?*+{":
                self.take()
                m, n = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(q) or self.bounds()
                part = ("rep", part, m, n)
            parts.append(part)
        return ("cat", parts)

    def bounds(self) -> tuple[int, int | None]:
        end = self.s.index("}", self.i)
        low, comma, high = self.s[self.i:end].partition(",")
        self.i = end + 1
        return int(low), (int(high) if high else None) if comma else int(low)

    def atom(self):
        c = self.take()
        if c == "(":
            fold = self.fold
            if self.s.startswith("?i:", self.i):
                self.i, self.fold = self.i + 3, True
            inner = self.alternatives()
            if self.take() != ")":
                raise ValueError("unclosed group")
            self.fold = fold
            return inner
        if c == "[":
            return ("set", self.cased(self.members()))
        return ("set", self.cased({self.escape() if c == "\\" else ord(c)}))

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2:self.i], 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def members(self) -> set[int]:
        negate = self.peek() == "^"
        self.i += negate
        out: set[int] = set()
        while (c := self.take()) != "]":
            low = self.escape() if c == "\\" else ord(c)
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.take()
                c = self.take()
                out.update(range(low, (self.escape() if c == "\\" else ord(c)) + 1))
            else:
                out.add(low)
        return set(range(RESET)) - out if negate else out

    def cased(self, values: set[int]) -> frozenset[int]:
        if self.fold:
            values = values | {ord(chr(v).swapcase()) for v in values if v < 128}
        return frozenset(values)


class _Nfa:
    """States with edges on sets of bytes and empty edges."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def build(self, node, start: int, backward: bool) -> int:
        """Adds ``node`` from ``start``; its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in (reversed(node[1]) if backward else node[1]):
                start = self.build(part, start, backward)
            return start
        if kind == "or":
            end = self.state()
            for part in node[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.build(part, first, backward)].append(end)
            return end
        _, part, low, high = node
        for _ in range(low):
            start = self.build(part, start, backward)
        if high is None:
            loop, end = self.state(), self.state()
            self.empty[start] += [loop, end]
            self.empty[self.build(part, loop, backward)] += [loop, end]
            return end
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.build(part, start, backward)
            self.empty[start].append(end)
        return end


@dataclass
class Dfa:
    """``next[state, class_of[byte]]``; ``accepts[state]`` has a bit for each rule; state 0 starts."""

    class_of: np.ndarray
    next: np.ndarray
    accepts: np.ndarray

    @cached_property
    def lists(self) -> tuple[list[list[int]], list[int], bytes, int]:
        """The same for steps of one byte: rows, accepts, classes of bytes, and the state that nothing leaves (or -1)."""
        stuck = np.flatnonzero((self.accepts == 0) & (self.next == np.arange(len(self.next))[:, None]).all(1))
        return self.next.tolist(), self.accepts.tolist(), bytes(self.class_of.tolist()), int(stuck[0]) if len(stuck) else -1


def compile_rules(patterns: list[str], search: bool, backward: bool = False) -> Dfa:
    """The minimal automaton of all patterns.

    With ``search``, matches begin anywhere and the reset byte leads back to
    the start; without, they begin at the first byte, and the last state is dead.
    """
    nfa, starts, ends = _Nfa(), [], {}
    for r, p in enumerate(patterns):
        parser = _Parser(p)
        tree = parser.alternatives()
        if parser.i != len(p):
            raise ValueError(f"unread: {p[parser.i:]}")
        starts.append(nfa.state())
        ends[nfa.build(tree, starts[-1], backward)] = r

    def closure(state: int) -> int:
        """What ``state`` reaches by empty edges, as bits."""
        todo, seen = [state], {state}
        while todo:
            for n in nfa.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return sum(1 << s for s in seen if nfa.edges[s] or s in ends)

    # bytes that all edges treat alike form one class
    sets = sorted({e[0] for es in nfa.edges for e in es}, key=sorted)
    marks = [tuple(b in s for s in sets) + (b == RESET and search,) for b in range(256)]
    order = {m: i for i, m in enumerate(dict.fromkeys(marks))}
    class_of = np.array([order[m] for m in marks], np.int64)
    of_class = {c: b for b, c in enumerate(class_of.tolist())}
    reach = [closure(s) for s in range(len(nfa.edges))]
    first = 0
    for s in starts:
        first |= reach[s]
    # per state and class, the states after it; a set of states is a number's bits
    after = [[0] * len(order) for _ in nfa.edges]
    for s, edges in enumerate(nfa.edges):
        for on, t in edges:
            for c, b in of_class.items():
                if b in on and not (search and b == RESET):
                    after[s][c] |= reach[t]
    known, todo, table = {first: 0}, [first], []
    for here in todo:                                    # grows while it is read
        row = [first if search else 0] * len(order)
        while here:
            low = here & -here
            row = [a | b for a, b in zip(row, after[low.bit_length() - 1])]
            here ^= low
        for nxt in row:
            if nxt not in known:
                known[nxt] = len(known)
                todo.append(nxt)
        table.append([known[nxt] for nxt in row])
    moves = np.array(table, np.int64)
    accepts = np.array([sum(1 << r for s, r in ends.items() if states >> s & 1) for states in known], np.int64)
    return Dfa(class_of, *_minimal(moves, accepts))


def _minimal(moves: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States that no input tells apart become one; the start state stays 0."""
    label = np.unique(accepts, return_inverse=True)[1]
    # rows are told apart by a 64-bit sum; that no two were taken for one is tested at the end
    odd = np.random.default_rng(1).integers(0, 1 << 63, moves.shape[1] + 1, np.uint64) * np.uint64(2) + np.uint64(1)
    while True:
        rows = label.astype(np.uint64) * odd[-1] + (label[moves].astype(np.uint64) * odd[:-1]).sum(1, dtype=np.uint64)
        seen, new = np.unique(rows, return_inverse=True)
        if len(seen) == label.max() + 1:
            break
        label = new
    one = np.unique(label, return_index=True)[1]
    if (label[moves] != label[moves[one[label]]]).any() or (accepts != accepts[one[label]]).any():
        raise AssertionError("states merged that differ")
    first = np.full(label.max() + 1, len(label))
    np.minimum.at(first, label, np.arange(len(label)))
    rank = np.empty_like(first)
    rank[np.argsort(first)] = np.arange(len(first))       # numbered as first met, so the start is 0
    kept = np.sort(first)
    return rank[label[moves[kept]]], accepts[kept]


class Scanner:
    """The automata of a set of rules, ready to scan."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        dfa = compile_rules([r.head for r in rules], search=True)
        self.width = dfa.next.shape[1]
        self.class_of = dfa.class_of.astype(np.int32)
        # states premultiplied by the width, so that state + class is an index
        self.flat = (dfa.next * self.width).astype(np.int32).ravel()
        self.accepts = dfa.accepts
        self.accepting = np.flatnonzero(dfa.accepts)
        self.forward = [compile_rules([r.head], search=False) for r in rules]
        self.back = [compile_rules([r.head], search=False, backward=True) for r in rules]
        self.until = [compile_rules([r.until], search=False) if r.until else None for r in rules]

    def states(self, raw: np.ndarray, before: int) -> np.ndarray:
        """State after each byte, from state ``before`` (premultiplied)."""
        n = len(raw)
        rows = -(-n // CHUNK)
        classes = np.full(rows * CHUNK, self.class_of[RESET], np.int32)
        classes[:n] = self.class_of[raw]
        steps = np.ascontiguousarray(classes.reshape(rows, CHUNK).T)
        out = np.empty((CHUNK, rows), np.int32)
        self._side_by_side(steps, 0, out)
        out = np.ascontiguousarray(out.T)
        classes = classes.reshape(rows, CHUNK)
        from_state: dict[int, tuple[int, np.ndarray]] = {}
        for k in range(rows):                 # put right what each chunk's true first state changes
            if before in from_state:
                at, states = from_state[before]
                out[k] = states[:, k - at]
            elif before != 0 and not self._meets(classes[k], before, out[k]) and len(from_state) < LONG_RUNS:
                # a match that fills a chunk mostly fills more of them: all that follow, begun in its state
                left = int(out[k, -1])
                if left not in from_state and k + 1 < rows:
                    states = np.empty((CHUNK, rows - k - 1), np.int32)
                    self._side_by_side(steps[:, k + 1:], left, states)
                    from_state[left] = (k + 1, states)
            before = int(out[k, -1])
        return out.ravel()[:n]

    def _side_by_side(self, steps: np.ndarray, first: int, out: np.ndarray) -> None:
        """States of all chunks (columns), each begun in state ``first``."""
        state = np.full(steps.shape[1], first, np.int32)
        for j in range(CHUNK):
            state = self.flat[state + steps[j]]
            out[j] = state

    def _meets(self, classes: np.ndarray, before: int, out: np.ndarray) -> bool:
        """Step one chunk from ``before`` until its states are those in ``out``; whether that happened."""
        for j in range(CHUNK):
            before = int(self.flat[before + classes[j]])
            if before == out[j]:
                return True
            out[j] = before
        return False

    def ends(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of matches in a byte stream, and the rules (bits) that match there."""
        before, at, masks = 0, [], []
        for lo in range(0, len(raw), BLOCK):
            state = self.states(raw[lo:lo + BLOCK], before)
            hit = np.flatnonzero(np.isin(state, self.accepting * self.width))
            at.append(hit + lo + 1)
            masks.append(self.accepts[state[hit] // self.width])
            before = int(state[-1])
        return (np.concatenate(at), np.concatenate(masks)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def spans(self, raw: bytes, ends: np.ndarray, masks: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, for one text and the ends found in it."""
        out = []
        for r, rule in enumerate(self.rules):
            mine = ends[(masks >> r & 1) == 1]
            free, k = 0, 0
            while k < len(mine):
                start = _last(self.back[r], raw, int(mine[k]), free, -1)
                if start is None:
                    k += 1
                    continue
                end = self._extended(r, raw, _last(self.forward[r], raw, start, len(raw), 1))
                free = end
                k = int(np.searchsorted(mine, end, side="right"))
                if end - start >= rule.least and end - value_start(rule, raw, start, end) >= rule.least_value:
                    out.append((start, end, r))
        return sorted(out)

    def _extended(self, r: int, raw: bytes, end: int) -> int:
        """Where a match whose head ends at ``end`` ends."""
        if self.until[r] is None or (run := raw.find(b"-----", end)) < 0:
            return end
        last = _last(self.until[r], raw, _HYPHENS.match(raw, run).end(), len(raw), 1)
        return end if last is None else last

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Spans of each text, in code points, by start and then rule; texts are scanned together."""
        raws = [t.encode() for t in texts]
        stream = np.frombuffer(bytes([RESET]).join(raws), np.uint8)
        starts = np.cumsum([0] + [len(r) + 1 for r in raws])
        ends, masks = self.ends(stream)
        cut = np.searchsorted(ends, starts, side="right")
        out = []
        for i, raw in enumerate(raws):
            lo, hi = cut[i], cut[i + 1]
            found = self.spans(raw, ends[lo:hi] - starts[i], masks[lo:hi]) if hi > lo else []
            out.append(_code_points(raw, found))
        return out


def _last(dfa: Dfa, raw: bytes, at: int, stop: int, step: int) -> int | None:
    """Reading from ``at`` towards ``stop``, the farthest place where the automaton accepts."""
    rows, accepts, classes, dead = dfa.lists
    state, found = 0, None
    while at != stop:
        ahead = min(4096, abs(stop - at))
        piece = raw[at:at + ahead] if step > 0 else raw[at - ahead:at][::-1]
        for c in piece.translate(classes):
            state = rows[state][c]
            at += step
            if accepts[state]:
                found = at
            elif state == dead:
                return found
    return found


def value_start(rule: Rule, raw: bytes, start: int, end: int) -> int:
    """Where the value of a match begins: after the sign, spaces and quote of an assignment."""
    if rule.kind != "assign":
        return start
    at = start
    while raw[at] not in b":=":
        at += 1
    at += 1
    while raw[at] == 0x20:
        at += 1
    return at + (raw[at] in b"\"'")


def _code_points(raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or raw.isascii():
        return spans
    places = sorted({p for s in spans for p in s[:2]})
    data, at, n, points = np.frombuffer(raw, np.uint8), 0, 0, {}
    for p in places:
        n += int(np.count_nonzero((data[at:p] & 0xC0) != 0x80))
        points[p], at = n, p
    return [(points[a], points[b], r) for a, b, r in spans]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """The scanner of a set of rules, compiled once."""
    return Scanner(rules)


@lru_cache(maxsize=4)
def _shared(app: str, rules: tuple[Rule, ...]) -> Broadcast:
    """The driver's scanner, for all workers of an application (a few MB of arrays)."""
    return SparkSession.active().sparkContext.broadcast(scanner(rules))


def shared(rules: tuple[Rule, ...]) -> Broadcast:
    return _shared(SparkSession.active().sparkContext.applicationId, rules)


def _groups(texts: list[str], limit: int = BLOCK) -> Iterator[list[str]]:
    """Consecutive texts of about ``limit`` characters together."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of (kind, start, end) of a text's secrets, by start and then as the kinds are listed."""
    kinds = [r.kind for r in rules]
    ready = shared(rules)

    @F.arrow_udf("array<struct<kind: string, start: long, end: long>>")
    def scan(texts: pa.Array) -> pa.Array:
        one = ready.value
        found = [s for g in _groups([t or "" for t in texts.to_pylist()]) for s in one.scan(g)]
        offsets = np.cumsum([0] + [len(s) for s in found])
        flat = [x for s in found for x in s]
        values = pa.StructArray.from_arrays(
            [pa.array([kinds[r] for _, _, r in flat], pa.string()), pa.array([a for a, _, _ in flat], pa.int64()),
             pa.array([b for _, b, _ in flat], pa.int64())], names=["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return scan(text)


def redacted(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text with every secret value replaced by ``[kind]``; what overlaps is replaced together."""
    ready = shared(rules)

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        one, out = ready.value, []
        for group in _groups([t or "" for t in texts.to_pylist()]):
            for t, spans in zip(group, one.scan(group)):
                at, parts = 0, []
                for a, b, r in spans:
                    if rules[r].kind == "assign":      # the key stays
                        raw = t[a:b].encode()
                        a += value_start(rules[r], raw, 0, len(raw))
                    if a >= at:
                        parts += [t[at:a], f"[{rules[r].kind}]"]
                    at = max(at, b)
                out.append("".join([*parts, t[at:]]))
        return pa.array(out, pa.string())
    return redact(text)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: counts of the base kinds, digest of their spans, and all spans."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = docs.select("doc_id", spans_of(F.col("text"), rules).alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("s", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the secrets of every text redacted; ``n_chars``, if there, follows the text.

    Texts without a secret, null ones among them, stay as they are.
    """
    (new,) = fresh_names(docs, "new_text")
    out = docs.withColumn(new, redacted(F.col("text"), rules))
    changed = F.col("text").isNotNull() & (F.col(new) != F.col("text"))
    size = {"n_chars": F.when(changed, F.length(new)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)} \
        if "n_chars" in docs.columns else {}
    return out.withColumns({**size, "text": F.when(changed, F.col(new)).otherwise(F.col("text"))}).select(*docs.columns)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for the rows of ``report``: matches and what lies between them give the offsets."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    hits = " UNION ALL ".join(
        f"SELECT n, {k} AS k, {quote(r.kind)} AS kind, {r.least} AS least, {r.least_value} AS least_value, "
        f"regexp_extract_all(text, {quote(r.pattern)}) AS m, string_split_regex(text, {quote(r.pattern)}) AS s FROM d"
        for k, r in enumerate(rules))
    value = "regexp_extract(v, '^[^:=]*[:=]\\x20*[\"'']?(.*)$', 1)"
    spans = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k)"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
        h AS ({hits}),
        i AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM h WHERE len(m) > 0),
        p AS (SELECT n, k, kind, least, least_value, m[i] AS v,
                     list_sum(list_transform(s[1:i], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS place FROM i),
        f AS (SELECT n, k, kind, CAST(place AS BIGINT) AS a, CAST(place + length(v) AS BIGINT) AS b FROM p
              WHERE length(v) >= least AND (least_value = 0 OR length({value}) >= least_value))
        SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)},
               sha256(coalesce({spans} FILTER (k < {len(BASE_KINDS)}), '')) AS base_sha256,
               coalesce({spans}, '') AS spans
        FROM d LEFT JOIN f USING (n) GROUP BY n, doc_id
    """
