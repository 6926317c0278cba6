"""BPE encoding and decoding with tree concatenation (operator 6).

Byte-level BPE, ids as the ``tokenizers`` library gives for the same
vocabulary file.  A text is a tree: halves of a long text are encoded in
parallel (rows of a DataFrame), then joined pairwise.  A join re-encodes a
window around the seam and lets it grow until the new encoding agrees with
both sides; outside the window the halves' own ids stand.

Two facts make the joins exact:

* The splitting pattern is read left to right and looks one character
  ahead.  So every piece of the left half but its last is a piece of the
  whole, and once a scan of the seam meets a piece boundary of the right
  half, the rest of the right half is split as before.
* Inside one piece (a long text without any split), ids are the encoding of
  their bytes exactly if each two neighbours are.  So a window whose first
  id equals the left half's id there, and whose last id equals the right
  half's, joins both exactly.

Cases: a null text counts as empty; an empty text has no ids; a special
token written in a text is its own id, as the library does by default;
repeated rows give repeated results; an empty table gives an empty result.
Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCAB = "byte_bpe_50k.json"
# Fixed value: how the byte-level vocabulary splits a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LEAF_CHARS = 32_768      # a longer text is halved until its parts are no longer
PIECE_CHARS = 256        # an unsplit piece longer than this is encoded by halves
FIRST_WINDOW = 4         # ids on either side of a seam to begin with

# Up to here the two libraries' character classes are compared one by one in
# the tests; a text with any other character is encoded by `tokenizers`.
_OTHER = re.compile("[^\x00-ɏ]")


def vocab_path(name_or_path: str) -> str:
    """A file of the public tokenizers by name, or any other path as it is."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers
    return public_tokenizers.path(name_or_path)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def library_encoder(path: str):
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(path)
    encoder.no_truncation()
    encoder.no_padding()
    return encoder


class ByteBpe:
    """Encoder and decoder of one vocabulary, on one worker."""

    def __init__(self, vocab: str = VOCAB):
        import tiktoken

        self.path = vocab_path(vocab)
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        ranks = {bytes(symbols[c] for c in s): i for s, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.bytes_of = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._piece = self.fast._core_bpe.encode_single_piece
        self.ranks = ranks

    @cached_property
    def slow(self):
        """The library's own encoder, loaded when a text needs it."""
        return library_encoder(self.path)

    @cached_property
    def _split(self):
        import regex
        return regex.compile(PATTERN)

    # -- whole texts ------------------------------------------------------
    def encode(self, text: str) -> np.ndarray:
        parts = [text]
        if self._special is not None and self._special.search(text):
            parts = re.split(f"({self._special.pattern})", text)
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([self.special[part]], dtype=np.uint32))
            elif part:
                out.append(self._plain(part))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def _plain(self, text: str) -> np.ndarray:
        if has_long_piece(text):
            return self.parts(text).ids
        if _OTHER.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text)

    def decode(self, ids: list[int]) -> str:
        try:
            raw = self.fast._core_bpe.decode_bytes(ids)
        except KeyError:                       # special tokens among them
            raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw.decode("utf-8", errors="replace")

    # -- parts of a text and their joins ----------------------------------
    def split(self, text: str) -> list[str]:
        """The pieces of ``text``, as the vocabulary's own pattern splits it."""
        if _OTHER.search(text):
            return [text[a:b] for _, (a, b) in self.slow.pre_tokenizer.pre_tokenize_str(text)]
        return self._split.findall(text)

    def parts(self, text: str) -> Parts:
        """``text`` encoded with its piece boundaries kept."""
        pieces = self.split(text)
        ids = [self.piece(p) for p in pieces]
        return Parts(text, np.fromiter(map(len, pieces), np.int64, len(pieces)),
                     np.fromiter(map(len, ids), np.int64, len(ids)),
                     np.array([i for x in ids for i in x], dtype=np.uint32))

    def piece(self, piece: str) -> list[int]:
        """One piece; a long one by halves."""
        if len(piece) <= PIECE_CHARS:
            raw = piece.encode()
            one = self.ranks.get(raw)
            return [one] if one is not None else self._piece(raw)
        half = len(piece) // 2
        return self.join_ids(self.piece(piece[:half]), self.piece(piece[half:]))

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring stretches of one piece, joined exactly."""
        get, w = self.bytes_of.__getitem__, FIRST_WINDOW
        while True:
            a, b = left[-w:], right[:w]
            mid = self._piece(b"".join(map(get, a)) + b"".join(map(get, b)))
            if (len(a) == len(left) or mid[0] == a[0]) and (len(b) == len(right) or mid[-1] == b[-1]):
                return left[:len(left) - len(a)] + mid + right[len(b):]
            w *= 2

    def join(self, x: Parts, y: Parts) -> Parts:
        """Parts of the concatenated text."""
        if not len(x.lengths) or not len(y.lengths):
            return y if not len(x.lengths) else x
        tail = x.text[len(x.text) - int(x.lengths[-1]):]
        tail_ids = x.ids[len(x.ids) - int(x.counts[-1]):].tolist()
        y_ends = np.concatenate([[0], np.cumsum(y.lengths)])
        w = 64
        while True:
            head = y.text[:w]
            whole = len(head) == len(y.text)
            pieces = self.split(tail + head)
            ends = np.cumsum([len(p) for p in pieces]) - len(tail)   # in the right half's offsets
            known = ends >= 0 if whole else (ends >= 0) & (np.arange(len(ends)) < len(ends) - 1)
            at = np.flatnonzero(known & np.isin(ends, y_ends))
            if len(at):
                break
            w *= 2
        pieces = pieces[:at[0] + 1]
        cut = int(ends[at[0]])
        k = int(np.searchsorted(y_ends, cut))                        # pieces of y that the seam took
        first = y.ids[:int(y.counts[0])].tolist()
        ids = []
        for p in pieces:
            if p == tail and len(pieces) == 1:
                ids.append(tail_ids)
            elif len(pieces) == 1 and k == 1 and len(p) == len(tail) + cut:
                ids.append(self.join_ids(tail_ids, first))
            else:
                ids.append(self.piece(p))
        return Parts(x.text + y.text,
                     np.concatenate([x.lengths[:-1], [len(p) for p in pieces], y.lengths[k:]]).astype(np.int64),
                     np.concatenate([x.counts[:-1], [len(i) for i in ids], y.counts[k:]]).astype(np.int64),
                     np.concatenate([x.ids[:len(x.ids) - int(x.counts[-1])],
                                     np.array([i for x_ in ids for i in x_], dtype=np.uint32),
                                     y.ids[int(y.counts[:k].sum()):]]).astype(np.uint32))

    def join_all(self, parts: list[Parts]) -> np.ndarray:
        """All leaves of a text, joined pairwise level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0].ids if parts else np.zeros(0, np.uint32)


class Parts:
    """A text, its pieces' lengths and numbers of ids, and all ids."""

    def __init__(self, text: str, lengths: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        self.text, self.lengths, self.counts, self.ids = text, lengths, counts, ids


def has_long_piece(text: str) -> bool:
    """Whether some run without spaces, or of spaces, is long enough to need halves."""
    return len(text) > PIECE_CHARS and (" " * PIECE_CHARS in text or max(map(len, text.split(" "))) > PIECE_CHARS)


_ENCODERS: dict[str, ByteBpe] = {}


def encoder(vocab: str) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    if vocab not in _ENCODERS:
        _ENCODERS[vocab] = ByteBpe(vocab)
    return _ENCODERS[vocab]


def _ids_array(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows).view(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def ids_of(text: Column, vocab: str = VOCAB) -> Column:
    """Ids of texts up to ``LEAF_CHARS`` or without need of a tree (array of int)."""
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        one = encoder(vocab)
        return _ids_array([one.encode(t or "") for t in texts.to_pylist()])
    return encode(text)


def text_of(ids: Column, vocab: str = VOCAB) -> Column:
    """The text that ids stand for; bytes that are no UTF-8 become U+FFFD."""
    @F.arrow_udf(T.StringType())
    def decode(rows: pa.Array) -> pa.Array:
        one, ends = encoder(vocab), rows.offsets.to_numpy()
        flat = rows.values.to_numpy()          # a null list has no values
        return pa.array([one.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())
    return decode(ids)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocab: str = VOCAB, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``(id, ids)`` for every row of ``docs``.

    Texts of up to ``2 * leaf_chars`` characters are encoded where they are.
    Longer ones become rows of one leaf each, which are dealt out, encoded in
    parallel and joined per text; rows are keyed by id and the text's digest,
    and equal rows are encoded once and counted.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    long_text = F.length("text") > 2 * leaf_chars
    short = rows.where(~long_text).select("id", ids_of(F.col("text"), vocab).alias("ids"))

    n = F.length("text")
    depth = F.ceil(F.log2(n / F.lit(leaf_chars))).cast("int")
    size = F.ceil(n / F.pow(F.lit(2), depth)).cast("int")
    leaves = (rows.where(long_text)
              .groupBy("id", F.sha2("text", 256).alias("digest"))
              .agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
              .select("id", "digest", "copies", "text", size.alias("size"))
              .select("id", "digest", "copies", F.posexplode(F.transform(
                  F.sequence(F.lit(0), F.ceil(F.length("text") / F.col("size")).cast("int") - 1),
                  lambda i: F.substring("text", i * F.col("size") + 1, F.col("size")))).alias("leaf", "text"))
              .repartition(F.col("digest"), F.col("leaf")))
    part_type = ("id " + rows.schema["id"].dataType.simpleString()
                 + ", digest string, copies long, leaf int, text string, lengths binary, counts binary, ids binary")

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(vocab)
        for batch in batches:
            parts = [one.parts(t) for t in batch.column("text").to_pylist()]
            extra = [[getattr(p, f).tobytes() for p in parts] for f in ("lengths", "counts", "ids")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "digest", "copies", "leaf", "text")]
                + [pa.array(x, pa.binary()) for x in extra],
                names=["id", "digest", "copies", "leaf", "text", "lengths", "counts", "ids"])

    def join_leaves(group: pa.Table) -> pa.Table:
        one = encoder(vocab)
        row = sorted(group.to_pylist(), key=lambda r: r["leaf"])
        text = "".join(r["text"] for r in row)
        if one._special is not None and one._special.search(text):   # hard seams within the text
            ids = one.encode(text)
        else:
            ids = one.join_all([Parts(r["text"], np.frombuffer(r["lengths"], np.int64),
                                      np.frombuffer(r["counts"], np.int64),
                                      np.frombuffer(r["ids"], np.uint32)) for r in row])
        k = row[0]["copies"]
        return pa.table([pa.array([row[0]["id"]] * k, group.schema.field("id").type), _ids_array([ids] * k)],
                        names=["id", "ids"])

    out_type = "id " + rows.schema["id"].dataType.simpleString() + ", ids array<int>"
    joined = (leaves.mapInArrow(encode_leaves, part_type)
              .groupBy("id", "digest").applyInArrow(join_leaves, out_type))
    return short.unionByName(joined).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", vocab: str = VOCAB) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of its ids."""
    return encoded.withColumn("decoded", text_of(F.col(ids_col), vocab))


def encode_decode_report(docs: DataFrame, vocab: str = VOCAB) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded text."""
    both = decode(encode(docs, vocab=vocab), vocab=vocab)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
