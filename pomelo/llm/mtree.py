"""Exact top-k by inner product with M-trees searched best first (operator 10).

Inner products become distances: with ``M`` the greatest norm of all vectors,
a vector x stands as (x, sqrt(M^2 - |x|^2)) and a query q as (q, 0), so that
their squared distance is |q|^2 + M^2 - 2 q.x, least where the product is
greatest.  Scores are integers throughout; distances only decide what to skip,
with a margin for rounding.

An M-tree has pages of up to ``PAGE`` entries.  An entry is a routing object
with its covering radius, or in a leaf a vector, and its distance to the
page's own routing object.  A search takes the page of the least possible
distance first, skips entries by the stored distances alone where the triangle
inequality allows, and ends when no page can hold anything better.

Scale: every vector goes to the nearest of a bounded number of pivots (a
sample by id hash of at most ``PIVOTS``; exactness does not depend on it), and
a cell is dealt into trees of about ``TREE`` vectors, so no cell or crowd of
equal vectors fills a task.  Cells and trees are numbered along a chain of near
pivots, and queries are put into blocks along it.  A query first searches one
tree of its own cell, which bounds its k-th score.  With that bound it is held
against the roots (routing object and covering radius of every tree, one row a
tree, in blocks) and goes only to the trees that can hold something better; a
tree goes only to the blocks that ask for it.  Trees and queries meet in groups
of bounded size, and a meeting returns at most k rows per query.  Where the
vectors have clusters, what is shuffled grows with the vectors; of vectors
without any, such as random directions, every ball reaches every query, and
trees and queries all meet, in blocks.

Cases: vectors that are null or hold null or non-finite components, and rows
without an id, take no part; of several rows of one id the least vector
counts once; a shorter vector counts as filled up with zeros; ties go to the
smaller id; with fewer than k candidates all are returned; an empty table
gives an empty result.  Products must stay below 2^63.
"""

from __future__ import annotations

import heapq
import io
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pomelo.llm.common import checkpointed

K = 10
SCALE = 1024
PAGE = 64               # entries of a node
TREE = 4096             # vectors of a tree, about
PIVOTS = 1024           # at most so many cells
GROUP_TREES, GROUP_QUERIES = 4, 1024
GROUP_ROOTS = 4096


class Tree:
    """One M-tree in flat arrays."""

    FIELDS = ("ids", "vectors", "extra", "first", "entry", "far", "radius", "child", "center", "cover")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, extra: np.ndarray) -> Tree:
        """From ids, integer vectors and each vector's additional coordinate."""
        whole = np.column_stack([vectors, extra]).astype(np.float64)
        nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def distance(rows: np.ndarray, to: int) -> np.ndarray:
            return np.sqrt(((whole[rows] - whole[to]) ** 2).sum(1))

        def add(rows: np.ndarray, parent: int) -> int:
            """A node over ``rows``, under routing object ``parent``; its number."""
            at = len(nodes)
            nodes.append(())
            if len(rows) <= PAGE:
                nodes[at] = (rows, distance(rows, parent), np.zeros(len(rows)), np.full(len(rows), -1))
                return at
            heads = rows[np.unique(np.linspace(0, len(rows) - 1, min(PAGE, -(-len(rows) // (PAGE // 2)))).astype(int))]
            near = np.stack([distance(rows, h) for h in heads])
            owner = near.argmin(0)
            if np.bincount(owner).max() > 0.9 * len(rows):       # equal vectors: any even deal is as good
                owner = np.arange(len(rows)) * len(heads) // len(rows)
            entries = []
            for h, head in enumerate(heads):
                mine = rows[owner == h]
                if len(mine):
                    entries.append((head, float(near[h][owner == h].max()), add(mine, int(head))))
            head, radius, child = zip(*entries)
            head = np.array(head)
            nodes[at] = (head, distance(head, parent), np.array(radius), np.array(child))
            return at

        # the tree's own routing object is the vector nearest to the mean
        center = int(((whole - whole.mean(0)) ** 2).sum(1).argmin())
        add(np.arange(len(ids)), center)
        first = np.cumsum([0] + [len(n[0]) for n in nodes])
        entry, far, radius, child = (np.concatenate([n[i] for n in nodes]) for i in range(4))
        small = next((t for t in (np.int16, np.int32) if np.abs(vectors).max(initial=0) <= np.iinfo(t).max), np.int64)
        return cls(ids=ids, vectors=vectors.astype(small), extra=extra, first=first, entry=entry.astype(np.int64),
                   far=far, radius=radius, child=child.astype(np.int64), center=np.int64(center),
                   cover=distance(np.arange(len(ids)), center).max())

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            tree = cls(**{f: arrays[f] for f in cls.FIELDS})
        tree.vectors = tree.vectors.astype(np.int64)
        return tree


def reach_of(norms, floor):
    """The distance of a score of ``floor`` from a query, ``norms`` being |q|^2 + M^2; a margin covers rounding."""
    return np.sqrt(np.maximum(norms - 2.0 * floor, 0.0)) * (1 + 1e-9) + 1e-6


def search(trees: list[Tree], own: int, query: np.ndarray, norm: float, k: int, least: int | None) -> list[tuple[int, int]]:
    """The k best ``(score, id)`` of all trees, best first; only scores of ``least`` or more are wanted."""
    norms = int(query @ query) + norm
    best: list[tuple[int, int]] = []           # a heap of (score, -id): the worst on top
    order = count()

    def reach() -> float:
        """The greatest distance still of use."""
        floor = best[0][0] if len(best) == k else least
        if floor is None:
            return np.inf
        if least is not None:
            floor = max(floor, least)
        return float(reach_of(norms, floor))

    queue = [(0.0, next(order), t, 0, None) for t in trees]
    while queue:
        nearest, _, tree, node, to_parent = heapq.heappop(queue)
        limit = reach()
        if nearest > limit:
            break
        at = slice(tree.first[node], tree.first[node + 1])
        entry, radius, child = tree.entry[at], tree.radius[at], tree.child[at]
        if to_parent is not None:              # by stored distances alone
            use = np.abs(to_parent - tree.far[at]) - radius <= limit
            entry, radius, child = entry[use], radius[use], child[use]
        if not len(entry):
            continue
        rows = tree.vectors[entry]
        d = min(rows.shape[1], len(query))
        scores = rows[:, :d] @ query[:d]
        if child[0] < 0:
            floor = best[0][0] if len(best) == k else least
            keep = np.ones(len(scores), bool) if floor is None else scores >= floor
            for s, i in zip(scores[keep].tolist(), tree.ids[entry[keep]].tolist()):
                if i == own or (least is not None and s < least):
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        else:
            to = np.sqrt(np.maximum(norms - 2.0 * scores, 0.0))
            for lower, far, c in zip((to - radius).tolist(), to.tolist(), child.tolist()):
                if lower <= limit:
                    heapq.heappush(queue, (max(lower, 0.0), next(order), tree, c, far))
    return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    ends, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=0)) if width is None else width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)] = flat[ends[0]:ends[-1]]
    return out


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null where the vector takes no part."""
    good = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.when(vector.isNotNull() & F.forall(vector, good),
                  F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _nearest(vector: Column, pivots: np.ndarray) -> Column:
    @F.arrow_udf(T.IntegerType())
    def nearest(vectors: pa.Array) -> pa.Array:
        x = _matrix(pa.chunked_array([vectors]), pivots.shape[1]).astype(np.float64)
        far = (pivots ** 2).sum(1) - 2 * x @ pivots.T
        return pa.array(far.argmin(1).astype(np.int32))
    return nearest(vector)


def _chain(pivots: np.ndarray) -> list[int]:
    """The pivots in an order where each is followed by the nearest of the rest."""
    order, left = [0], np.ones(len(pivots), bool)
    while len(order) < len(pivots):
        left[order[-1]] = False
        far = ((pivots - pivots[order[-1]]) ** 2).sum(1)
        order.append(int(np.where(left, far, np.inf).argmin()))
    return order


def _query_blocks(counts: dict[int, int], cells: list[int], size: int) -> list[tuple[int, int, int]]:
    """``(cell, first block, blocks)``: neighbours share a block up to ``size`` queries, a larger cell has several."""
    out, block, room = [], -1, 0
    for cell in cells:
        n = counts.get(cell, 0)
        if n > size:
            blocks = -(-n // size)
            out.append((cell, block + 1, blocks))
            block, room = block + blocks, 0
        elif n:
            if n > room:
                block, room = block + 1, size
            out.append((cell, block, 1))
            room -= n
    return out


def _route(roots: DataFrame, queries: DataFrame, n_trees: int, norm: float) -> DataFrame:
    """The trees within reach of every query, but for the one it has searched.

    ``(query_id, v, size, least, block, g, numbers)``, a row per group of trees."""
    shards = -(-n_trees // GROUP_ROOTS)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, groups, numbers = [], [], []
        if left.num_rows and right.num_rows:
            number = left.column("number").to_numpy()
            by_number = np.argsort(number)
            number = number[by_number]
            center = _matrix(left.column("center"))[by_number].astype(np.float64)
            cover = left.column("cover").to_numpy()[by_number]
            first = np.flatnonzero(np.r_[True, np.diff(number // GROUP_TREES) > 0])
            whole = _matrix(right.column("v"), center.shape[1]).astype(np.float64)
            norms = (whole * whole).sum(1) + norm
            least, head = right.column("least").to_pylist(), right.column("head").to_numpy()
            for i, q in enumerate(whole):
                far = np.sqrt(np.maximum(norms[i] - 2.0 * (center @ q), 0.0))
                use = number != head[i]
                if least[i] is not None:
                    use &= far - cover <= reach_of(norms[i], least[i]) + 1e-9 * (far + cover)
                for part in np.split(number[use], np.searchsorted(np.flatnonzero(use), first[1:])):
                    if len(part):
                        rows.append(i)
                        groups.append(int(part[0]) // GROUP_TREES)
                        numbers.append(part.tolist())
        return (right.select(["query_id", "v", "size", "least", "block"]).take(pa.array(rows, pa.int64()))
                .append_column("g", pa.array(groups, pa.int32()))
                .append_column("numbers", pa.array(numbers, pa.list_(pa.int32()))))

    sharded = roots.select("number", "center", "cover", F.expr(f"number div {GROUP_ROOTS}").cast("int").alias("shard"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asking = queries.select("block").distinct().withColumn("shard", every)
    left = sharded.join(asking, "shard").select("number", "center", "cover", "shard", F.col("block").alias("block"))
    return (left.groupBy("shard", "block").cogroup(queries.withColumn("shard", every).groupBy("shard", "block"))
            .applyInArrow(run, "query_id long, v array<long>, size int, least long, block int, g int, numbers array<int>"))


def _meet(trees: DataFrame, queries: DataFrame, keys: list[str], norm: float, k: int) -> DataFrame:
    """Search of every query in those trees of its group that it names: ``(query_id, vec_id, score)``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            forest = {n: Tree.unpack(b) for n, b in zip(left.column("number").to_pylist(), left.column("tree").to_pylist())}
            rows = _matrix(right.column("v"))
            for own, q, n, least, numbers in zip(right.column("query_id").to_pylist(), rows, right.column("size").to_pylist(),
                                                 right.column("least").to_pylist(), right.column("numbers").to_pylist()):
                found += [(own, i, s) for s, i in search([forest[t] for t in numbers], own, q[:n], norm, k, least)]
        ids, vecs, scores = (np.array(c, np.int64) for c in (zip(*found) if found else ((), (), ())))
        return pa.table({"query_id": ids, "vec_id": vecs, "score": scores})

    # columns of their own: the blocks that ask come from the queries
    trees = trees.select(*[F.col(c).alias(c) for c in trees.columns])
    return (trees.groupBy(*keys).cogroup(queries.groupBy(*keys))
            .applyInArrow(run, "query_id long, vec_id long, score long"))


def top_k(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = K, scale: int = SCALE, tree_rows: int = TREE) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows where ``queries`` (a condition on ``id``) holds."""
    spark = vectors.sparkSession
    rows = (vectors.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("v"))
            .where("v is not null").groupBy("id").agg(F.min("v").alias("v")))
    rows = checkpointed(rows)
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    total, norm, width = rows.agg(F.count(F.lit(1)), F.max(square), F.max(F.size("v"))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    n_pivots = min(PIVOTS, -(-total // tree_rows))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()     # a bounded sample
    pivots = np.array([list(r.v) + [0] * (width - len(r.v)) for r in sample], np.float64).reshape(len(sample), width)
    cells = checkpointed(rows.select("id", "v", _nearest(F.col("v"), pivots).alias("cell"),
                                     F.monotonically_increasing_id().alias("at")))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()    # at most PIVOTS rows
    n_of, chain = {r.cell: r.n for r in sizes}, _chain(pivots)
    deal, at = [], 0
    for cell in (c for c in chain if c in n_of):
        parts = -(-n_of[cell] // tree_rows)
        deal.append((cell, parts, at))
        at += parts
    n_trees = at
    parts = F.broadcast(spark.createDataFrame(deal, "cell int, parts int, before int"))   # at most PIVOTS rows

    def build(group: pa.Table) -> pa.Table:
        v = _matrix(group.column("v"))
        extra = np.sqrt(np.maximum(norm - (v * v).sum(1), 0).astype(np.float64))
        tree = Tree.build(group.column("id").to_numpy(), v, extra)
        return pa.table({c: group.column(c).slice(0, 1) for c in ("number", "head")}
                        | {"center": pa.array([v[tree.center]], pa.list_(pa.int64())), "cover": pa.array([float(tree.cover)]),
                           "tree": pa.array([tree.pack()], pa.binary())})

    trees = checkpointed(
        cells.join(parts, "cell")
        .select("id", "v", (F.col("before") + (F.col("at") % F.col("parts"))).cast("int").alias("number"),
                F.col("before").alias("head"))
        .groupBy("number").applyInArrow(build, "number int, head int, center array<long>, cover double, tree binary"))

    asked = cells.where(queries).join(parts.select("cell", F.col("before").alias("head")), "cell")
    counts = {r.cell: r.n for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.broadcast(spark.createDataFrame(_query_blocks(counts, chain, GROUP_QUERIES),
                                               "cell int, start int, blocks int"))           # at most PIVOTS rows
    asked = checkpointed(asked.join(blocks, "cell").select(
        F.col("id").alias("query_id"), "v", F.size("v").alias("size"), "head",
        (F.col("start") + F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int").alias("block")))

    # one tree of the own cell bounds each query's k-th score
    heads = asked.select(F.col("head").alias("number"), "block").distinct()
    home = checkpointed(_meet(
        trees.select("number", "tree").join(heads, "number"),
        asked.select("query_id", "v", "size", "block", F.col("head").alias("number"), F.lit(None).cast("long").alias("least"),
                     F.array("head").alias("numbers")), ["number", "block"], norm, k))
    least = (home.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
             .select("query_id", F.when(F.col("n") >= k, F.col("score")).alias("least")))
    bounded = asked.join(least, "query_id", "left")
    routed = checkpointed(_route(trees, bounded, n_trees, norm))
    grouped = trees.select("number", "tree", F.expr(f"number div {GROUP_TREES}").cast("int").alias("g"))
    away = _meet(grouped.join(routed.select("g", "block").distinct(), "g"), routed, ["g", "block"], norm, k)
    found = home.unionByName(away)
    ranked = found.selectExpr(
        "query_id", "vec_id", "score",
        "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank")
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
