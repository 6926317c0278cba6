"""Best-fit packing by sums of squares (operator 8).

Documents become token sequences of at most ``capacity``.  A document's ids
end with a separator; only a longer one is cut, into full pieces and a last
shorter one.  Each piece is then placed among the open bins where the sum
over gaps of squared counts of open bins per gap becomes smallest; a new bin
is opened only when no open bin has room.  Pieces are placed longest first.

Scale: pieces are sorted by length, numbered through (per-partition counts
give the offsets, one number per partition on the driver) and dealt round
robin into shards of ``SHARD_TOKENS`` tokens, so each shard has the lengths of
all documents, wherever they lie.  A shard is packed in one task of bounded
memory; no key decides where a piece goes, so repeated rows cannot fill one
task.  The emptiest bins of all shards are unpacked and their pieces packed
again in the same way, in ever fewer shards down to one; where that needs no
fewer bins, the places from before stay.

Cases: a null text counts as empty (its one piece is the separator); equal
rows are packed each on its own; null ids stay null; an empty table gives an
empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo.llm import word_bpe
from pomelo.llm.common import checkpointed

CAPACITY = 2048
SEPARATOR = 0
SHARD_TOKENS = 1024 * CAPACITY
AGAIN = 16                  # bins of a shard whose pieces are packed again, the emptiest


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           separator: int = SEPARATOR, vocab: str = word_bpe.VOCAB, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and the ids themselves if asked for."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = word_bpe.encoder(vocab)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                seq = np.append(one.encode(text or ""), np.uint32(separator)).astype("<u4")
                for k, at in enumerate(range(0, len(seq), capacity)):
                    part = seq[at:at + capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, by the sum-of-squares rule."""
    open_bins = np.zeros(capacity + 1, np.int64)        # per gap: how many open bins have it
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        gap = capacity
        if size < capacity:
            here = open_bins[size:capacity]             # gaps size .. capacity - 1
            change = 2 * (open_bins[:capacity - size] - here) + 2
            change[0] = 1 - 2 * here[0]                 # a bin that becomes full leaves the sum
            change[here == 0] = np.iinfo(np.int64).max
            k = int(change.argmin())
            if here[k]:
                gap = size + k
        if gap == capacity:
            bins[i] = opened
            opened += 1
        else:
            bins[i] = waiting[gap].pop()
            open_bins[gap] -= 1
        offsets[i] = capacity - gap
        if gap > size:
            open_bins[gap - size] += 1
            waiting[gap - size].append(int(bins[i]))
    return bins, offsets


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (checkpointed) numbered through in their order."""
    numbered = rows.withColumn(name, F.monotonically_increasing_id())
    partition = F.shiftright(name, 33)
    counts = numbered.groupBy(partition.alias("p")).count().collect()   # one number per partition
    offsets, total = [], 0
    for r in sorted(counts, key=lambda r: r["p"]):
        offsets.append((r["p"], total))
        total += r["count"]
    table = rows.sparkSession.createDataFrame(offsets, "p long, before long")       # as many rows as partitions
    return (numbered.join(F.broadcast(table), partition == F.col("p"))
            .select(*rows.columns, (F.col("before") + F.col(name).bitwiseAND((1 << 33) - 1)).alias(name)))


def _placed(lengths: DataFrame, capacity: int, shard_tokens: int, first: int = 0) -> DataFrame:
    """``(at, length)`` with ``sequence_id`` (from ``first``) and ``offset``."""
    total = lengths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
    shard_tokens = max(shard_tokens, 4 * capacity)
    shards = max(1, -(-total.tokens // shard_tokens))
    most = -(-total.n // shards)                # pieces of a shard, so its bins too
    few = min(AGAIN, shard_tokens // capacity // 4)

    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        size = pdf["length"].to_numpy()
        bins, offset = place(size, capacity)
        filled = np.bincount(bins, size)
        last = np.zeros(len(filled), bool)
        last[np.argsort(filled, kind="stable")[:few]] = True
        return pd.DataFrame({"at": pdf["at"].to_numpy(), "length": size,
                             "sequence_id": first + pdf["shard"].to_numpy() * most + bins, "offset": offset, "again": last[bins]})

    dealt = _numbered(checkpointed(lengths.orderBy(F.desc("length"), "at")), "place")
    placed = checkpointed(dealt.withColumn("shard", F.col("place") % shards).groupBy("shard").applyInPandas(
        pack_shard, "at long, length long, sequence_id long, offset long, again boolean"))
    again, placed = placed.where("again").drop("again"), placed.where(~F.col("again") | F.lit(shards == 1)).drop("again")
    if shards == 1:
        return placed
    better = _placed(again.select("at", "length"), capacity, shard_tokens, first + shards * most)
    bins = [df.select("sequence_id").distinct().count() for df in (better, again)]
    return placed.unionByName(better if bins[0] < bins[1] else again)


def pack(parts: DataFrame, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``parts`` (any rows with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    parts = checkpointed(parts)
    numbered = parts.select(F.struct(*[F.col(f"`{c}`") for c in parts.columns]).alias("part"),
                            F.monotonically_increasing_id().alias("at"))
    lengths = numbered.select("at", F.col("part.length").cast("long").alias("length"))
    placed = _placed(lengths, capacity, shard_tokens).select("at", "sequence_id", "offset")
    return (numbered.join(placed, "at")
            .select(*[F.col(f"part.`{c}`") for c in parts.columns], "sequence_id", "offset"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(pieces(docs))
