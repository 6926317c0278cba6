"""Fill-in-middle transformation: in-place block rotation.

A text is cut into prefix, middle and suffix at unit borders; a unit is a run
of ASCII letters or one other character.  The scan for the cuts marks the
first byte of every unit over fixed blocks of the UTF-8 bytes, so a text of
any length needs a block of extra memory besides its own copy.  The sentinels
are inserted into a bytearray, which then reads

    <P>prefix<M>middle<S>suffix

and two neighbouring blocks are exchanged in place by three reversals: the
last two for ``psm`` (<P>prefix<S>suffix<M>middle), the first two together
with the third for ``spm`` (<S>suffix<P>prefix<M>middle).  ``restore`` finds
the sentinels in the output, rotates back by the same three reversals and
takes the sentinels out.  No sentinel can arise by chance: a text that holds
one stays plain, and as each begins with ``<`` and has no other ``<``, none
can begin in a text and end in a sentinel or the other way round.

Where the cuts lie and which form a document takes is drawn from SHA-256 of
``1:`` and its id, so the result does not depend on partitions, order or
retries.  Rows are independent: one narrow pass, no shuffle.

Defined results: a null text is empty; an empty text is plain with n 0; a null
id hashes like an empty one; repeated rows give repeated rows; an empty table
gives no rows; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90          # h3 % 100 from here on: plain
SPM_BELOW = 20           # h4 % 100 below: spm

_P, _S, _M = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
BLOCK = 1 << 20          # bytes looked at or exchanged at once


def reverse(view: np.ndarray, a: int, b: int, block: int = BLOCK) -> None:
    """Reverse ``view[a:b]`` in place, exchanging at most ``block`` bytes from either end at once."""
    while b - a > 1:
        k = min(block, (b - a) // 2)
        left = view[a:a + k].copy()
        view[a:a + k] = view[b - k:b][::-1]
        view[b - k:b] = left[::-1]
        a, b = a + k, b - k


def rotate(view: np.ndarray, a: int, mid: int, b: int, block: int = BLOCK) -> None:
    """Exchange the neighbouring blocks ``view[a:mid]`` and ``view[mid:b]`` by three reversals."""
    reverse(view, a, mid, block)
    reverse(view, mid, b, block)
    reverse(view, a, b, block)


def _firsts(data: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which bytes of ``data[a:b]`` begin a unit."""
    x = data[a:b]
    low = x | 0x20
    letter = (low >= ord("a")) & (low <= ord("z"))
    after = np.empty_like(letter)               # whether the byte before is a letter
    after[1:] = letter[:-1]
    after[0] = a > 0 and ord("a") <= data[a - 1] | 0x20 <= ord("z")
    return np.where(letter, ~after, (x & 0xC0) != 0x80)


def cuts(text: bytes, h1: int, h2: int, block: int = BLOCK) -> tuple[int, int, int]:
    """Number of units, and the byte offsets at which prefix and middle end."""
    data = np.frombuffer(text, np.uint8)
    edges = [(a, min(a + block, len(data))) for a in range(0, len(data), block)]
    counts = [int(np.count_nonzero(_firsts(data, a, b))) for a, b in edges]
    n = sum(counts)

    def offset(units: int) -> int:
        for (a, b), c in zip(edges, counts):
            if units < c:
                return a + int(np.flatnonzero(_firsts(data, a, b))[units])
            units -= c
        return len(data)

    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, offset(first), offset(second)


def code_points(text: bytes, a: int, b: int) -> int:
    data = np.frombuffer(text, np.uint8)
    return sum(int(np.count_nonzero((data[i:min(i + BLOCK, b)] & 0xC0) != 0x80)) for i in range(a, b, BLOCK))


def rearrange(text: bytes, p: int, m: int, form: str, block: int = BLOCK) -> bytearray:
    """``text``, cut at ``p`` and ``m``, in the given form."""
    buf = bytearray(text)
    if form == "plain":
        return buf
    buf[m:m] = _S
    buf[p:p] = _M
    buf[0:0] = _P
    at_m, at_s = p + len(_P), m + len(_P) + len(_M)
    rotate(np.frombuffer(buf, np.uint8), 0 if form == "spm" else at_m, at_s, len(buf), block)
    return buf


def put_back(output: bytes, form: str, block: int = BLOCK) -> bytearray:
    """The text that ``rearrange`` was given, from its output and form alone."""
    buf = bytearray(output)
    if form == "plain":
        return buf
    end, at_m = len(buf), buf.find(_M)
    start = 0 if form == "spm" else buf.find(_S)              # the blocks exchanged begin here ...
    mid = buf.find(_P) if form == "spm" else at_m             # ... and here
    rotate(np.frombuffer(buf, np.uint8), start, mid, end, block)
    at_s = start + end - mid
    at_m -= mid - start
    for at in (at_s, at_m, 0):
        del buf[at:at + 3]
    return buf


def _binary(rows: list[bytearray | None]) -> pa.Array:
    return pa.array([None if r is None else bytes(r) for r in rows], pa.binary())


_CUT = "n long, prefix_chars long, middle_chars long, output binary"


def _arranged(text: Column, form: Column, h1: Column, h2: Column) -> Column:
    @F.arrow_udf(_CUT)
    def run(texts: pa.Array, forms: pa.Array, h1s: pa.Array, h2s: pa.Array) -> pa.Array:
        ns, ps, ms, outs = [], [], [], []
        for t, f, a, b in zip(texts.to_pylist(), forms.to_pylist(), h1s.to_pylist(), h2s.to_pylist()):
            n, p, m = cuts(t, a, b)
            ns.append(n)
            ps.append(None if f == "plain" else code_points(t, 0, p))
            ms.append(None if f == "plain" else code_points(t, p, m))
            outs.append(rearrange(t, p, m, f))
        return pa.StructArray.from_arrays([pa.array(ns, pa.int64()), pa.array(ps, pa.int64()), pa.array(ms, pa.int64()),
                                           _binary(outs)], ["n", "prefix_chars", "middle_chars", "output"])
    return run(text.cast("binary"), form, h1, h2)


def restored(output: Column, form: Column) -> Column:
    """The exact text behind an output and its form."""
    @F.arrow_udf("binary")
    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return _binary([None if o is None else put_back(o, f) for o, f in zip(outputs.to_pylist(), forms.to_pylist())])
    return run(output.cast("binary"), form).cast("string")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` of every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       *[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    plain = (F.col("text") == "") | (F.col("h3") % 100 >= plain_from)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.col("text").contains(mark)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_below, "spm").otherwise("psm")
    rows = rows.withColumn("form", form)
    done = rows.select("id", "form", _arranged(F.col("text"), F.col("form"), F.col("h1"), F.col("h2")).alias("cut"))
    return done.select(F.col("id").alias(id_col), "cut.n", "form", "cut.prefix_chars", "cut.middle_chars",
                       F.col("cut.output").cast("string").alias("output"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: units, form, sizes, and the digests of the output and of the text rebuilt from it."""
    out = transform(docs).withColumn("restored", restored(F.col("output"), F.col("form")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def oracle() -> str:
    """DuckDB SQL of ``report`` over ``documents``."""
    return r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256(concat('1:', doc_id)) AS x FROM documents),
        h AS (
            SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
                   CAST('0x' || x[1:8] AS UBIGINT) AS h1, CAST('0x' || x[9:16] AS UBIGINT) AS h2,
                   CAST('0x' || x[17:24] AS UBIGINT) AS h3, CAST('0x' || x[25:32] AS UBIGINT) AS h4 FROM d),
        c AS (
            SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
                   least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS p, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS m,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        s AS (
            SELECT doc_id, text, n, form, array_to_string(u[1:p], '') AS prefix,
                   array_to_string(u[p + 1:m], '') AS middle, array_to_string(u[m + 1:], '') AS suffix FROM c)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM s
    """
