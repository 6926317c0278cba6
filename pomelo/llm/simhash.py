"""SimHash near-duplicates by multi-index hashing (operator 9).

Fingerprints: a bit is 1 if it is set in over half of the XXH64 values of a
text's word shingles.  Two fingerprints link at ``max_bits`` or fewer
differing bits; a component holds what links reach.

Multi-index hashing: a fingerprint has two segments of 32 bits.  Of two
fingerprints with at most three differing bits, one segment differs in at
most one.  So each distinct fingerprint stands in the table of each segment
under its own value (a home), and visits the values of the ball of radius one
around it.  Only bits that are 0 are flipped: of two values one bit apart,
exactly one visits the other.  Visits to values without a home are dropped
by a semi join; what meets in a bucket is verified by complete distance.

Scale: copies fall together before the search.  A bucket of more than
``block`` rows is dealt into blocks, and pairs of blocks are verified in
tasks of their own; a task returns links that span what it found connected,
never all pairs.  Nothing but one checksum row per round reaches the driver.

Cases: null and empty texts have fingerprint zero, linked like any other; a
null id takes no part in the minimum (a component of null ids alone has a
null id); equal rows share everything; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pomelo.llm.common import checkpointed, fresh_names
from pomelo.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS, SEGMENT_BITS, RADIUS = 2, 32, 1
BLOCK = 2048


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text (unsigned)."""
    import xxhash
    h = xxhash.xxh64_intdigest
    w = text.encode().lower().split()      # of bytes: A-Z alone, and the six ASCII white spaces
    if not w:
        return 0
    if len(w) < words:
        values = [h(b" ".join(w), SEED)]
    else:
        values = list(map(h, map(b" ".join, zip(*(w[i:] for i in range(words)))), repeat(SEED)))
    raw = np.array(values, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 1 << 16):  # blocks: the bits of a very long text are 64 times its shingles
        ones += np.unpackbits(raw[at:at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(raw), bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Fingerprints of texts, as signed long."""
    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t or "", words) for t in texts.to_pylist()], dtype=np.uint64)
        return pa.array(values.view(np.int64))
    return of(text)


def spanning_links(values: np.ndarray, home: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect whatever rows of one bucket lie within ``max_bits``.

    Two visitors are not compared: if near, they meet elsewhere at a home.
    """
    homes = np.flatnonzero(home)
    label = np.arange(len(values))
    links = []
    for at in range(0, len(homes), 256):
        some = homes[at:at + 256]
        near = np.bitwise_count(values[some, None] ^ values[None, :]) <= max_bits
        for r, c in zip(*np.nonzero(near)):
            a, b = int(some[r]), int(c)
            while label[a] != a:
                label[a] = label[label[a]]
                a = int(label[a])
            while label[b] != b:
                label[b] = label[label[b]]
                b = int(label[b])
            if a != b:
                label[max(a, b)] = min(a, b)
                links.append((int(values[some[r]]), int(values[c])))
    return links


def links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``nodes (fp long)``, distinct -> ``(a, b)``: links whose components are those of all links."""
    segments = [F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)]
    key = [v + F.lit(s << SEGMENT_BITS) for s, v in enumerate(segments)]
    homes = nodes.select("fp", F.explode(F.array(*key)).alias("key"))
    flips = [F.when(v.bitwiseAND(1 << i) == 0, k + F.lit(1 << i)) for v, k in zip(segments, key) for i in range(SEGMENT_BITS)]
    visits = nodes.select("fp", F.explode(F.filter(F.array(*flips), lambda k: k.isNotNull())).alias("key"))
    visits = visits.join(homes.select("key").distinct(), "key", "left_semi")
    rows = checkpointed(homes.select("key", "fp", F.lit(True).alias("home"))
                        .unionByName(visits.select("key", "fp", F.lit(False).alias("home"))))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (rows.join(sizes, "key").select("key", "fp", "home", blocks.alias("blocks"))
             .select("key", "fp", "home", "blocks", own.alias("own"))
             .select("key", "fp", "home", "own",
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("key", "fp", "home", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))

    def verify(group: pa.Table) -> pa.Table:
        values = group.column("fp").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy(zero_copy_only=False)
        found = spanning_links(values, home)
        flat = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(flat[:, 0]), "b": pa.array(flat[:, 1])})

    return dealt.groupBy("key", "i", "j").applyInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``(id, fp, component_id)`` for every row of ``docs``; fp is the fingerprint as signed long."""
    prints = checkpointed(docs.select(F.col(id_col).alias("id"), fingerprint_of(F.col(text_col)).alias("fp")))
    firsts = prints.groupBy("fp").agg(F.min("id").alias("first"))
    member = _members(firsts, block)
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _members(nodes: DataFrame, block: int) -> DataFrame:
    """``nodes (fp, ...)``, one row per fingerprint, with ``root``: the least fingerprint of the component."""
    roots = components(links(nodes.select("fp"), block)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint as 16 lowercase hex digits, and its component."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, whole, with its own columns.

    Rows of equal id and fingerprint count as repeated; one of them stays.
    Rows of a component whose ids are all null are kept once, too.
    """
    fp, kept_id, kept_fp = fresh_names(docs, "fp", "kept_id", "kept_fp")
    # written with the rows: whole texts are read for their fingerprints once
    marked = checkpointed(docs.withColumn(fp, fingerprint_of(F.col(text_col))))
    prints = (marked.select(F.col(id_col).alias("id"), F.col(fp).alias("fp")))
    # the least id of each fingerprint, and how many rows have it; then the least of each component
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"), F.col("n"))).alias("first")
    nodes = prints.groupBy("id", "fp").agg(F.count(F.lit(1)).alias("n")).groupBy("fp").agg(first)
    best = checkpointed(
        _members(nodes, block).groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.id").alias(kept_id), F.col("first.fp").alias(kept_fp), F.col("first.n").alias("n")))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(fp) == F.col(kept_fp))
    once, repeated = best.where("n = 1").drop("n"), best.where("n > 1").drop("n")
    single = marked.join(once, same, "left_semi")
    several = marked.join(repeated, same, "left_semi").dropDuplicates([id_col, fp])
    return single.unionByName(several).drop(fp)
