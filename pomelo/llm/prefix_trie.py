"""Conversation prefix trie by truncation peeling.

Conversations are sequences of turns; every distinct sequence of first turns
is a node.  The trie is never built from the root: the peeling descends from
the greatest depth.  At each depth the conversations that end there join the
nodes that survived from below, equal ones are merged into one node with its
aggregates (members, children, leaves, bytes saved), the node is written out,
its last turn is stripped, and what is left regroups one depth higher.  A
node is found and aggregated in the same step, and only nodes that still
have members below travel on.

As Spark jobs:

* A turn is a 16-byte digest of role and text, so texts leave the plan with
  the scan.  A prefix is known by a 16-byte hash chained over its turns; a
  conversation carries the chain of all its prefixes as one binary.
* Conversations that are equal from end to end end at the same node.  Their
  ids meet sorted in one stream per node, which keeps a running digest, a
  count and the least id.  (A SHA-256 over the ids of a node is sequential by
  definition; only 8-byte ids and the end key go there, never turns.)  From
  here on each distinct sequence is one row, however often it was copied.
* Turns that no other sequence shares cannot meet anything, so they are
  stripped where they are: one count per prefix tells how far down a sequence
  is alone (first depth with a count of one), and its nodes down there are
  written without any regrouping.
* The shared part is peeled depth by depth.  Each step is a grouped
  aggregate with map-side combine, so a root or first turn that a third of
  all conversations share is summed in every task first; its result is a
  written table of that depth, read by the next step and by the result, so
  lost executors cost one step at most.  There are as many steps as the
  deepest shared turn, each over the surviving nodes alone.
* A node learns its parent's least member by ``hot_keys.left_join``: parents
  with many children are few and broadcast, the others are joined.

Defined results: null role or text is empty; turns are ordered by ``turn``,
null first, rows of equal ``turn`` by their digest; repeated rows are turns
of their own; rows without a conversation id take no part; a turnless
conversation is a member of the root; without conversations there are no
nodes; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pomelo.llm import hot_keys
from pomelo.llm.common import checkpointed
from pomelo.session import scratch_path

KEY = 16                                     # bytes of a turn's digest and of a prefix's key
NOTHING = hashlib.sha256(b"").hexdigest()


# -- sequences ------------------------------------------------------------------

def sequences(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of ``conversations`` rows: turns in order, each ``(turn, digest, bytes)``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY))
    return (rows.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"),
                    F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def rebuild(seqs: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """Each conversation with its first turns taken from the first one of its block of ``every`` ids.

    How many (0 to ``most``) is drawn from the id; all if that conversation has fewer, none if it is absent."""
    own = seqs.select("conv_id", "turns", (F.col("conv_id") - F.pmod("conv_id", F.lit(every))).alias("first_id"),
                      (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int").alias("h"))
    heads = seqs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, most).alias("head"))
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(heads, "first_id", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _path(digests: Column) -> Column:
    """The keys of all prefixes, chained and concatenated."""
    @F.arrow_udf("binary")
    def run(rows: pa.Array) -> pa.Array:
        out = []
        for turns in rows.to_pylist():
            key, keys = b"", []
            for t in turns:
                key = hashlib.blake2b(key + t, digest_size=KEY).digest()
                keys.append(key)
            out.append(b"".join(keys))
        return pa.array(out, pa.binary())
    return run(digests)


def _suffix_sums(sizes: Column) -> Column:
    @F.arrow_udf("array<long>")
    def run(rows: pa.Array) -> pa.Array:
        sums = [np.cumsum(np.array(r, np.int64)[::-1])[::-1] for r in rows.to_pylist()]
        offsets = np.zeros(len(sums) + 1, np.int32)
        np.cumsum([len(x) for x in sums], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sums) if sums else np.zeros(0, np.int64)))
    return run(sizes)


def _key_at(path: Column, depth: Column) -> Column:
    return F.substring(path, KEY * (depth - 1) + 1, F.lit(KEY))


def _ended(convs: DataFrame) -> DataFrame:
    """``(conv_id, n, ends)`` per distinct sequence: its least conversation, how many end there, digest of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column("end").to_pylist(), b.column("conv_id").to_pylist()))
        done: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[0]):
            digest, n, least = hashlib.sha256(), 0, 0
            for _, conv in group:
                digest.update(f",{conv}".encode() if n else f"{conv}".encode())
                least, n = (least if n else conv), n + 1
            done.append((least, n, digest.hexdigest()))
            if len(done) == 1000:
                yield batch(done)
                done = []
        if done:
            yield batch(done)

    def batch(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))],
                                          names=["conv_id", "n", "ends"])

    end = F.substring("path", -KEY, KEY)
    return (convs.select(end.alias("end"), "conv_id").repartition("end").sortWithinPartitions("end", "conv_id")
            .mapInArrow(run, "conv_id long, n long, ends string"))


# -- the trie -------------------------------------------------------------------

def trie(seqs: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` per node."""
    spark = seqs.sparkSession
    convs = checkpointed(seqs.select("conv_id", _path(F.col("turns.digest")).alias("path"), F.col("turns.bytes").alias("sizes")))
    distinct = checkpointed(_ended(convs).join(convs, "conv_id")
                            .select("*", F.expr(f"cast(octet_length(path) div {KEY} as int)").alias("length"), _suffix_sums(F.col("sizes")).alias("rest")))

    # the depth from which on a sequence shares its prefix with no other one
    keys = F.transform(F.sequence(F.lit(1), F.col("length")), lambda d: F.struct(d.alias("d"), _key_at(F.col("path"), d).alias("key")))
    met = distinct.where("length > 0").select("conv_id", F.inline(keys)).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.min("d").alias("d"))
    alone = met.where("n = 1").groupBy("conv_id").agg(F.min("d").alias("alone"))
    units = (distinct.join(alone, "conv_id", "left").withColumn("alone", F.coalesce("alone", F.col("length") + 1))
             .withColumn("enter", F.col("alone") - 1).withColumn("tailed", F.col("enter") < F.col("length")))
    root = scratch_path(spark, "prefix-trie")
    units.sortWithinPartitions("enter").write.parquet(root + "/units")      # a step reads its own row groups
    units = spark.read.parquet(root + "/units")

    # tails, stripped in place: the top one still has to learn its parent, the others are their own child's parent
    below = F.transform(F.sequence(F.col("alone") + 1, F.col("length")), lambda d: F.struct(
        d.alias("depth"), ((F.col("n") - 1) * F.element_at("rest", d)).alias("saved"),
        F.when(d == F.col("length"), F.col("ends")).alias("ends"), F.when(d == F.col("length"), 0).otherwise(1).alias("n_children")))
    tails = (units.where("length > alone").select("conv_id", "n", F.inline(below))
             .select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n", "n_children", F.lit(1).alias("n_leaves"), "saved", "ends"))
    last = F.col("alone") == F.col("length")
    tops = units.where("tailed").select(
        "conv_id", F.col("alone").alias("depth"), _parent_key(F.col("path"), F.col("enter")).alias("parent"), "n",
        F.when(last, 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"),
        ((F.col("n") - 1) * F.element_at("rest", F.col("alone"))).alias("saved"), F.when(last, F.col("ends")).alias("ends"))

    shared = _peel(units, root + "/shared")
    if shared is None:
        return _shape(tails)
    children = shared.select("conv_id", "depth", F.when(F.col("depth") > 0, _parent_key(F.col("path"), F.col("depth") - 1)).alias("parent"),
                             "n", "n_children", "n_leaves", "saved", "ends").unionByName(tops)
    parents = shared.select(_parent_key(F.col("path"), F.col("depth")).alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    total = shared.agg(F.sum("n_children")).first()[0]
    known = hot_keys.left_join(children.withColumnRenamed("n_children", "nc"), "parent", ["conv_id", "depth"], parents, "n_children", total)
    return _shape(known.withColumnRenamed("nc", "n_children").unionByName(tails.withColumn("parent", F.lit(None).cast("string"))))


def _parent_key(path: Column, depth: Column) -> Column:
    """The key of the node at ``depth`` as a string."""
    return F.when(depth == 0, "root").otherwise(F.hex(_key_at(path, depth)))


def _peel(units: DataFrame, base: str) -> DataFrame | None:
    """The shared nodes, peeled from the greatest shared depth to the root; a written table per depth."""
    spark = units.sparkSession
    deepest = units.agg(F.max("enter")).first()[0]
    if deepest is None:
        return None
    entering = units.select(
        "enter", "conv_id", "n", F.expr(f"substring(path, 1, {KEY} * enter)").alias("path"),
        F.slice("sizes", F.lit(1), F.col("enter")).alias("sizes"),
        F.when(F.col("tailed"), 1).otherwise(0).cast("long").alias("n_children"),
        F.when(F.col("tailed"), 1).otherwise(0).cast("long").alias("n_leaves"),
        F.when(F.col("tailed"), (F.col("n") - 1) * F.element_at("rest", F.least("alone", "length"))).otherwise(0).cast("long").alias("saved"),
        F.when(~F.col("tailed"), F.col("ends")).alias("ends"))
    survivors, columns = None, None
    for depth in range(deepest, -1, -1):
        here = entering.where(F.col("enter") == depth).drop("enter")
        if survivors is not None:
            here = here.unionByName(survivors)
        key = F.substring("path", -KEY, KEY) if depth else F.lit(b"")
        text = F.element_at(F.first("sizes"), depth) if depth else F.lit(0)
        node = here.groupBy(key.alias("key")).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.first("path").alias("path"), F.first("sizes").alias("sizes"),
            F.sum("n_children").alias("n_children"),
            F.when(F.sum("n_children") == 0, 1).otherwise(F.sum("n_leaves")).alias("n_leaves"),
            (F.sum("saved") + (F.sum("n") - 1) * text).alias("saved"), F.max("ends").alias("ends"))
        node = node.drop("key")
        columns = node.schema
        node.write.parquet(f"{base}/depth={depth}")
        survivors = spark.read.schema(columns).parquet(f"{base}/depth={depth}").select(
            "conv_id", "n", F.expr(f"substring(path, 1, {KEY * max(depth - 1, 0)})").alias("path"),
            F.slice("sizes", 1, max(depth - 1, 0)).alias("sizes"),
            F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends"))
    return spark.read.schema(columns.add("depth", T.IntegerType())).parquet(base)


def _shape(nodes: DataFrame) -> DataFrame:
    return nodes.select(*[F.col(a).cast("long").alias(b) for a, b in
                          (("conv_id", "conv_id"), ("depth", "depth"), ("parent_conv_id", "parent_conv_id"), ("n", "n_convs"),
                           ("n_children", "n_children"), ("n_leaves", "n_leaves"), ("saved", "saved_tokens"))],
                        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))


def report(rows: DataFrame) -> DataFrame:
    """The trie of the rebuilt ``conversations``."""
    return trie(rebuild(sequences(rows)))


def oracle() -> str:
    """DuckDB SQL of ``report`` over ``conversations``: sums over members in place of peeling."""
    return """
        WITH tab AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t
            FROM (SELECT range AS i FROM range(0, 256))),
        own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        conv AS (
            SELECT conv_id, n, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                   lambda s: CAST(ord(s) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 9 AS h
            FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id), tab),
        turns AS (
            SELECT c.conv_id, b.pos AS d, b.role, b.text FROM conv c
            JOIN own b ON b.conv_id = c.conv_id - (c.conv_id % 5 + 5) % 5 AND b.pos <= c.h
            UNION ALL
            SELECT o.conv_id, o.pos - c.h + least(c.h, coalesce(f.n, 0)), o.role, o.text FROM own o
            JOIN conv c ON c.conv_id = o.conv_id AND o.pos > c.h
            LEFT JOIN conv f ON f.conv_id = c.conv_id - (c.conv_id % 5 + 5) % 5),
        keyed AS (
            SELECT conv_id, d, strlen(text) AS bytes,
                   sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
                          OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM turns
            UNION ALL SELECT conv_id, 0, 0, '' FROM conv),
        linked AS (
            SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY d) AS parent,
                   lead(key) OVER (PARTITION BY conv_id ORDER BY d) AS child FROM keyed),
        node AS (
            SELECT key, any_value(d) AS d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n,
                   count(DISTINCT child) AS n_children,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (child IS NULL), '')) AS ends
            FROM linked GROUP BY key),
        sums AS (
            SELECT l.key,
                   sum(CASE WHEN l.conv_id <> n.conv_id THEN l.bytes ELSE 0 END) OVER w AS saved,
                   sum(CASE WHEN l.conv_id = n.conv_id AND n.n_children = 0 THEN 1 ELSE 0 END) OVER w AS leaves
            FROM linked l JOIN node n ON n.key = l.key
            WINDOW w AS (PARTITION BY l.conv_id ORDER BY l.d DESC)),
        total AS (SELECT key, sum(saved) AS saved, sum(leaves) AS leaves FROM sums GROUP BY key)
        SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children,
               CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
        FROM node n JOIN total t ON t.key = n.key LEFT JOIN node p ON p.key = n.parent
    """
