"""Exact top-k inner products by best-first search of M-trees.

Vectors are quantised to integers.  Each scan partition packs its rows into
trees of bounded size: leaves are pages of vectors, inner nodes hold pivots with
covering radii and the distance to their parent's pivot.  Inner product becomes
a metric search by one more coordinate: with M the largest norm in a tree,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x,
so the nearest are those of the largest product.  A node whose lower bound on the
distance (triangle inequality, first over the stored parent distance, which costs
nothing, then over its own pivot) cannot reach the k-th best is never opened;
bounds are rounded outwards and products are computed exactly, so ties survive.

Queries travel in blocks of bounded size, and a block is searched for as a whole:
each query keeps bounds of its own, while products of a page with the queries that
reach it are one matrix product.  Each block first goes to one tree only,
another one for each block, which gives every query a k-th score to beat.  What
other trees can matter is told from a few numbers first (the block's centre and
spread, the root's pivot and radius), then by each query, to which end a block is
sent to a list of roots at once.  A task holds one tree, which is sent once, and
the blocks that reach it stream past it.  Each meeting gives at most k + 1 rows per query, which
a ranked window merges.

How much the bounds avoid depends on the vectors: on well-separated groups most
products, on directions without structure in many dimensions next to none, as all
distances are alike; the result is exact either way.

Edge cases: vectors that are null or hold null or non-finite components take no
part, nor do rows with a null id; only vectors of the query's dimension are
compared; a query leaves out its own row once, so other rows of its id count;
ties go to the smaller id, equal rows stay apart; an empty table gives none; finite
components so large that a product would not fit in 64 bits are an error, never a
wrong score;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.scratch import Scratch

TREE_ROWS, PAGE_ROWS, FANOUT, BLOCK_QUERIES = 16_384, 128, 16, 512
#: Trees in a list that a block of queries is joined with at once.
TREE_LIST = 64
#: Bytes of the vectors of a tree or of a block of queries at most, whatever their dimension.
PACK_BYTES = 1 << 24
#: Scores to beat travel from here upwards, so that a missing one is -1; lower than any score.
_LOWEST, _NOTHING = -(1 << 61), -(1 << 62)


class MTree:
    """A tree over the rows of an integer matrix."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE_ROWS, fanout: int = FANOUT):
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.top = float(norms.max()) if len(ids) else 0.0
        full = np.column_stack([vectors.astype(np.float64), np.sqrt(np.maximum(0.0, self.top - norms))])
        self.pivot: list[np.ndarray] = []
        self.radius: list[float] = []
        self.to_parent: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.rows: list[tuple[int, int]] = []
        order: list[np.ndarray] = []
        self._fill = 0
        rng = np.random.default_rng(len(ids))

        def grow(rows: np.ndarray, pivot: np.ndarray, parent: np.ndarray | None) -> int:
            distance = np.sqrt(((full[rows] - pivot) ** 2).sum(axis=1))
            me = len(self.radius)
            self.pivot.append(pivot)
            self.radius.append(float(distance.max()))
            self.to_parent.append(0.0 if parent is None else float(np.sqrt(((pivot - parent) ** 2).sum())))
            self.children.append(None)
            self.rows.append((0, 0))
            if rows.size <= page:
                self.rows[me] = self._fill, self._fill + rows.size
                self._fill += rows.size
                order.append(rows)
                return me
            picks = rows[rng.choice(rows.size, fanout, replace=False)]
            seeds = np.unique(full[picks], axis=0)
            gaps = ((full[rows] ** 2).sum(axis=1)[:, None] - 2 * full[rows] @ seeds.T + (seeds**2).sum(axis=1)[None, :])
            nearest = gaps.argmin(axis=1)
            parts = [(rows[nearest == k], seeds[k]) for k in range(len(seeds)) if (nearest == k).any()]
            if max(p.size for p, _ in parts) > 0.9 * rows.size:  # copies of few vectors: pages without a choice
                parts = [(rows[a : a + max(page, -(-rows.size // fanout))], pivot) for a in range(0, rows.size, max(page, -(-rows.size // fanout)))]
            self.children[me] = np.array([grow(p, s, pivot) for p, s in parts])
            return me

        if len(ids):
            grow(np.arange(len(ids)), full.mean(axis=0), None)
            at = np.concatenate(order)
        else:
            at = np.zeros(0, np.int64)
        self.ids, self.vectors = ids[at], vectors[at]
        self.leaf_gap = np.zeros(len(at))
        for n, c in enumerate(self.children):
            if c is None:
                a, b = self.rows[n]
                self.leaf_gap[a:b] = np.sqrt(((full[at[a:b]] - self.pivot[n]) ** 2).sum(axis=1))
        self.pivots = np.array(self.pivot)
        self.radii, self.parents = np.array(self.radius), np.array(self.to_parent)
        del self.pivot, self.radius, self.to_parent, self._fill

    def root(self) -> tuple[np.ndarray, float, float]:
        """The root's pivot, its covering radius and the largest norm (squared)."""
        return self.pivots[0], float(self.radii[0]), self.top

    def search(self, query: np.ndarray, k: int, beat: int | None = None) -> tuple[list[tuple[int, int]], int]:
        """The k largest (score, id), of scores not under ``beat``, with ties to smaller ids, and how many products were computed."""
        _, ids, scores, computed = self.search_block(query[None, :], k, None if beat is None else np.array([beat]))
        return list(zip(scores.tolist(), ids.tolist(), strict=True)), computed

    def search_block(self, queries: np.ndarray, k: int, beat: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same for the rows of ``queries``: number of the query, id and score of each row found, and how many products were computed.

        One best-first search serves all: a node is opened for those queries only
        whose bounds still reach it, each with its own distance to the node's pivot.
        """
        none, m = np.zeros(0, np.int64), len(queries)
        if not len(self.ids) or not m:
            return none, none, none, 0
        x = np.column_stack([queries.astype(np.float64), np.zeros(m)])
        own = (x**2).sum(axis=1)
        slack = 1e-6 * (1.0 + np.sqrt(own) + np.sqrt(self.top))
        floor = np.full(m, _NOTHING) if beat is None else np.maximum(beat, _NOTHING)
        reach = np.full(m, np.inf)
        held = floor > _NOTHING
        reach[held] = self._reach(own[held], floor[held])
        scores_of, ids_of = np.full((m, k), _NOTHING), np.zeros((m, k), np.int64)
        exact = np.sqrt(own.max() * self.top) < 2**52
        computed = opened = 0
        all_of = np.arange(m)
        gaps = self._gaps(x, own, np.zeros(1, np.int64))[:, 0]
        bounds = np.maximum(0.0, gaps - self.radii[0]) - slack
        heap = [(float(bounds.min()), opened, 0, all_of, gaps, bounds)]
        while heap:
            _, _, node, which, gaps, bounds = heapq.heappop(heap)
            still = bounds <= reach[which]
            which, gaps = which[still], gaps[still]
            if not which.size:
                continue
            children = self.children[node]
            if children is not None:
                # stored distances first, which cost nothing
                free = np.abs(gaps[:, None] - self.parents[children]) - self.radii[children] - slack[which, None] <= reach[which, None]
                some = free.any(axis=0)
                children, free = children[some], free[:, some]
                if children.size:
                    gaps = self._gaps(x[which], own[which], children)
                    bounds = np.maximum(0.0, gaps - self.radii[children]) - slack[which, None]
                    free &= bounds <= reach[which, None]
                    for n, child in enumerate(children.tolist()):
                        go = free[:, n]
                        if go.any():
                            opened += 1
                            heapq.heappush(heap, (float(bounds[go, n].min()), opened, child, which[go], gaps[go, n], bounds[go, n]))
                continue
            a, b = self.rows[node]
            near = np.abs(gaps[:, None] - self.leaf_gap[a:b]) - slack[which, None] <= reach[which, None]
            which, rows = which[near.any(axis=1)], np.flatnonzero(near.any(axis=0)) + a
            computed += which.size * rows.size
            if exact:
                scores = (queries[which].astype(np.float64) @ self.vectors[rows].astype(np.float64).T).astype(np.int64)
            else:
                scores = queries[which] @ self.vectors[rows].T
            q, r = np.nonzero(scores >= np.maximum(floor, scores_of[:, -1])[which, None])
            if not q.size:
                continue
            met = which[np.unique(q)]
            by = np.concatenate([which[q], np.repeat(met, k)])
            score = np.concatenate([scores[q, r], scores_of[met].ravel()])
            name = np.concatenate([self.ids[rows[r]], ids_of[met].ravel()])
            order = np.lexsort((name, -score, by))
            first = np.searchsorted(by[order], met)
            best = order[first[:, None] + np.arange(k)]
            scores_of[met], ids_of[met] = score[best], name[best]
            met = met[scores_of[met, -1] > _NOTHING]
            reach[met] = np.minimum(reach[met], self._reach(own[met], scores_of[met, -1]))
        n, at = np.nonzero(scores_of > _NOTHING)
        return n, ids_of[n, at], scores_of[n, at], int(computed)

    def _reach(self, own: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The distances at which these scores lie."""
        return np.sqrt(np.maximum(0.0, own + self.top - 2.0 * scores))

    def _gaps(self, x: np.ndarray, own: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Distances of queries to the pivots of nodes; what cancels in the squares is within the slack."""
        pivots = self.pivots[nodes]
        return np.sqrt(np.maximum(0.0, own[:, None] - 2.0 * (x @ pivots.T) + (pivots**2).sum(axis=1)))


def quantise(batch: pa.RecordBatch, key: str, column: str, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of the valid rows, one pair for each dimension."""
    lists = batch.column(column)
    by_size: dict[int, tuple[list, list]] = {}
    ids = batch.column(key).to_pylist()
    offsets = lists.offsets.to_numpy()
    flat = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64)
    valid = np.asarray(lists.is_valid())
    finite = np.append(0, np.cumsum(~np.isfinite(flat)))
    for i, own in enumerate(ids):
        a, b = offsets[i], offsets[i + 1]
        if own is not None and valid[i] and finite[b] == finite[a]:
            held = by_size.setdefault(int(b - a), ([], []))
            held[0].append(own)
            held[1].append(flat[a:b])
    for own, rows in by_size.values():
        whole = np.floor(scale * np.array(rows))
        if whole.size and np.abs(whole).max() ** 2 * whole.shape[1] >= 2.0**60:
            raise ValueError(f"vectors of {whole.shape[1]} components up to {np.abs(whole).max() / scale:.3g}: their products do not fit in a score of 64 bits")
        yield np.array(own, np.int64), whole.astype(np.int64)


def _packed(frame: DataFrame, key: str, column: str, scale: int, rows: int, make, schema: str) -> DataFrame:
    """Rows of ``frame`` packed by dimension: size, and what ``make(ids, vectors)`` says of every ``rows`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def pack(size: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(size), strict=True))
            return pa.RecordBatch.from_pylist([{"size": size, **make(ids, vectors)}], wanted)

        for batch in batches:
            for ids, vectors in quantise(batch, key, column, scale):
                size = vectors.shape[1]
                most = max(1, min(rows, PACK_BYTES // (8 * max(1, size))))
                for a in range(0, len(ids), most):
                    held.setdefault(size, []).append((ids[a : a + most], vectors[a : a + most]))
                    if sum(len(x[0]) for x in held[size]) >= most:
                        yield pack(size)
        for size in list(held):
            yield pack(size)

    kinds = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    wanted = pa.schema([("size", pa.int64()), *((c.split()[0], kinds[c.split()[1]]) for c in schema.split(", "))])
    return frame.select(key, column).mapInArrow(run, "size long, " + schema)


def _tree_row(ids: np.ndarray, vectors: np.ndarray) -> dict:
    tree = MTree(ids, vectors)
    pivot, radius, top = tree.root()
    return {"pivot": pivot.tolist(), "radius": radius, "top": top, "body": pickle.dumps(tree)}


def _block_row(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """A block of queries with the figures that prune trees for all of them: their centre (with the coordinate that queries have as 0) and how far from it they are."""
    centre = vectors.mean(axis=0)
    spread = float(np.sqrt(((vectors - centre) ** 2).sum(axis=1)).max())
    return {"centre": [*centre.tolist(), 0.0], "spread": spread, "many": len(ids), "body": pickle.dumps((ids, vectors))}


def _met(pairs: DataFrame, trees: DataFrame, blocks: DataFrame, k: int, partitions: int) -> DataFrame:
    """Per pair of a block and a tree and query n of the block: query_id, own (its product with itself), vec_id, score, and the products computed (once a block)."""
    index = trees.select("tree", F.lit(-1).cast("long").alias("block"), "body", F.lit(None).cast("binary").alias("beat"))
    sent = pairs.join(blocks.select("block", "body"), "block").select("tree", "block", "body", "beat")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, current = None, None
        for batch in batches:
            for number, block, body, beat in zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist(), batch.column("body"), batch.column("beat").to_pylist(), strict=True):
                if number != current:  # the tree stands before its blocks
                    tree, current = pickle.loads(body.as_py()), number
                    continue
                ids, rows = pickle.loads(body.as_py())
                least = None if beat is None else np.frombuffer(beat, np.int64)
                n, found, scores, products = tree.search_block(rows, k, least if least is None else np.where(least < 0, _NOTHING, least + _LOWEST))
                own, zero = (rows**2).sum(axis=1), np.zeros(n.size, np.int64)
                cols = [zero + block, n, ids[n], own[n], found, scores, zero]
                last = [block, -1, 0, 0, 0, 0, products]
                yield pa.RecordBatch.from_arrays([pa.array(np.append(c, x)) for c, x in zip(cols, last, strict=True)], ["block", "n", "query_id", "own", "vec_id", "score", "products"])

    dealt = index.unionAll(sent).repartition(partitions, "tree").sortWithinPartitions("tree", "block")
    return dealt.mapInArrow(run, "block long, n long, query_id long, own long, vec_id long, score long, products long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, key: str = "vec_id", column: str = "embedding", scratch: Scratch | None = None, products: list | None = None) -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id, score, for the ``k`` largest integer inner products.

    ``queries`` are rows of ``vectors``; each leaves out its own row.  ``products``, if given, gets the number of products computed.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "mtree")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = _packed(vectors, key, column, scale, TREE_ROWS, _tree_row, "pivot array<double>, radius double, top double, body binary")
    trees = scratch.keep(trees.withColumn("tree", F.monotonically_increasing_id()), "trees")
    blocks = _packed(queries, key, column, scale, BLOCK_QUERIES, _block_row, "centre array<double>, spread double, many long, body binary")
    blocks = scratch.keep(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    # trees are dealt into lists of about LIST trees, so that blocks meet them by many keys
    lists = max(1, -(-trees.count() // TREE_LIST))
    roots = trees.select("size", "tree", "pivot", "radius", "top", F.pmod(F.xxhash64("tree"), F.lit(lists)).cast("int").alias("list"))
    small = blocks.select("size", "block", "centre", "spread", "many")
    # each block begins with a tree of its own, by hash, of a list of its own
    own_list = small.select("size", "block", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(lists)).cast("int").alias("list"))
    first = own_list.join(roots.select("size", "list", "tree"), ["size", "list"]).groupBy("block").agg(F.min_by("tree", F.xxhash64("tree", "block")).alias("tree"))
    first = scratch.keep(first, "first")
    seed = scratch.keep(_met(first.withColumn("beat", F.lit(None).cast("binary")), trees, blocks, k + 1, partitions), "seed")
    order = Window.partitionBy("block", "n").orderBy(F.desc("score"), "vec_id")
    ranked = seed.where("n >= 0").withColumn("at", F.row_number().over(order))
    # with the query's own row among k + 1, the last of them is one that the k-th of the others must reach
    beat = ranked.where(F.col("at") == k + 1).groupBy("block").agg(F.collect_list(F.struct("n", "score")).alias("beat"), F.max(F.col("own") - 2 * F.col("score")).alias("lean"), F.count(F.lit(1)).alias("told"))
    beat = scratch.keep(beat, "beat")
    # by small columns first: no query of a block is nearer to a pivot than the block's centre less its spread, none reaches farther than the one with most to gain
    told = small.join(first.withColumnRenamed("tree", "seeded"), "block", "left").join(beat.drop("beat"), "block", "left")
    met = told.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1)))).join(roots, ["size", "list"]).where("seeded is null or tree <> seeded")
    gap = F.sqrt(F.aggregate(F.zip_with("centre", "pivot", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v))
    reach = F.when(F.col("told") == F.col("many"), F.sqrt(F.greatest(F.lit(0.0), F.col("lean") + F.col("top")))).otherwise(float("inf"))
    met = met.where(gap - F.col("spread") - F.col("radius") <= reach + 1e-6 * (1.0 + gap + F.col("spread") + F.sqrt("top")))
    met = met.groupBy("block", "list").agg(F.collect_list(F.struct("tree", "pivot", "radius", "top")).alias("roots"))
    # then by each query: a block's body goes to a list of trees once
    reached = met.join(blocks.select("block", "body"), "block").join(beat.select("block", "beat"), "block", "left").select("block", "body", "beat", "roots")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, rows = pickle.loads(batch.column("body")[i].as_py())
                least = np.full(len(ids), -1, np.int64)
                for x in batch.column("beat")[i].as_py() or ():
                    least[x["n"]] = x["score"] - _LOWEST
                own = (rows.astype(np.float64) ** 2).sum(axis=1)
                block, kept = batch.column("block")[i].as_py(), []
                for root in batch.column("roots")[i].as_py():
                    pivot, top = np.array(root["pivot"]), root["top"]
                    gap = np.sqrt(((rows - pivot[:-1]) ** 2).sum(axis=1) + pivot[-1] ** 2)
                    reach = np.where(least < 0, np.inf, np.sqrt(np.maximum(0.0, own + top - 2.0 * (least + _LOWEST).astype(np.float64))))
                    if (gap - root["radius"] <= reach + 1e-7 * (1.0 + np.sqrt(own) + np.sqrt(top))).any():
                        kept.append(root["tree"])
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array([block] * len(kept), pa.int64()), pa.array(kept, pa.int64()), pa.array([least.tobytes()] * len(kept), pa.binary())], ["block", "tree", "beat"])

    pairs = reached.mapInArrow(prune, "block long, tree long, beat binary")
    found = scratch.keep(_met(pairs, trees, blocks, k + 1, partitions), "found").unionAll(seed)
    if products is not None:
        products.append(found.agg(F.sum("products")).first()[0] or 0)
    # the query's own row goes once: among rows alike in id and score any one is it
    ranked = found.where("n >= 0").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    is_own = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    ranked = ranked.withColumn("mine", F.min(F.when(is_own, F.col("at"))).over(Window.partitionBy("block", "n")))
    rank = F.col("at") - F.when(F.col("at") > F.col("mine"), 1).otherwise(0)
    out = ranked.where(F.col("mine").isNull() | (F.col("at") != F.col("mine"))).withColumn("rank", rank.cast("int"))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
