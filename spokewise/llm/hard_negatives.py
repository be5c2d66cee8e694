"""Hard-negative mining with anchor spanning-tree bounds (operator 12).

Scores are inner products of whole-number vectors. An anchor's positives are
its best other rows of the same label; hard negatives of a positive are the
best rows of other labels whose score lies in a window set by the positive's
score.

Anchors are dealt into blocks of about ``BLOCK``; a spanning tree (Prim, by
distance) is built once per block. Rows are dealt into chunks, and a task
gets one block and one chunk, so no task and never the driver holds all
anchors or all rows. In a task the root's scores are computed. For every other
anchor of the tree, level by level,

    score(parent, row) -+ |anchor - parent| * |row|

bounds its scores, where the parent's score is itself an interval if it was
not computed. Only rows whose interval overlaps what the anchor still looks
for are scored: for positives, rows of its label that may reach the worst of
the best so far; for negatives, rows of another label that may lie in the
window of a positive and above the worst of the best so far there. Bounds are
widened by more than the rounding error, so results are exact.

A task passes on its own best few per anchor (or per anchor and positive),
with ties; ranks over all tasks decide. What is shuffled: each row once per
block of anchors (twice in all), each anchor once per chunk of rows.

Defined results: rows with a null id, a null label, a null or empty vector, or a null
or non-finite entry take no part, nor do vectors of another length than the
commonest. An id counts once: of rows with the same id the one with
the smallest label, then vector, is used (so repeated rows change nothing).
Ties go to the smaller id. An anchor without positives or a positive without
negatives gives no rows; a table without usable rows gives none. Entries must
fit 25 bits after scaling, else the run fails. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokewise.llm.common import written
from spokewise.llm.vectors import commonest_length, finite, scaled

BLOCK = 2048        # anchors of a tree, about
CHUNK = 16_384      # rows of a chunk, about (fewer where there would be fewer chunks than shuffle partitions)
LEAST_CHUNK = 1024
SLICE = 2048        # rows scored at a time; bounds of a slice take BLOCK * SLICE * 16 bytes
BITS = 25
OUT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
TREE = "block int, pos int, parent int, edge double, anchor_id long, label long, x array<int>"


# ------------------------------------------------------------------ the tree

def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's tree over the rows of ``x``: order from the root on, parent's place in that order, edge lengths."""
    n = len(x)
    x = x.astype(np.float64)
    order, parent, edge = np.zeros(n, int), np.full(n, -1), np.zeros(n)
    near, nearest = np.full(n, np.inf), np.full(n, -1)
    left = np.ones(n, bool)
    at = 0
    for place in range(n):
        order[place], left[at] = at, False
        parent[place], edge[place] = nearest[at], 0.0 if place == 0 else np.sqrt(near[at])
        gap = x - x[at]
        dist = np.einsum("ij,ij->i", gap, gap)
        closer = left & (dist < near)
        near[closer], nearest[closer] = dist[closer], place
        if place + 1 < n:
            at = int(np.argmin(np.where(left, near, np.inf)))
    return order, parent, edge


def _tree_of_block(table: pa.Table) -> pa.Table:
    table = table.sort_by("anchor_id")
    order, parent, edge = spanning_tree(_matrix(table.column("x")))
    n = len(order)
    dealt = table.take(pa.array(order))
    return pa.table({"block": dealt.column("block"), "pos": pa.array(np.arange(n), pa.int32()),
                     "parent": pa.array(parent, pa.int32()), "edge": pa.array(edge),
                     "anchor_id": dealt.column("anchor_id"), "label": dealt.column("label"), "x": dealt.column("x")})


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), -1)


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    depth = np.zeros(len(parent), int)
    for i in range(1, len(parent)):     # parents come before their children
        depth[i] = depth[parent[i]] + 1
    return [np.flatnonzero(depth == d) for d in range(depth.max() + 1)] if len(parent) else []


class Anchors:
    """A block's anchors in the order of their tree."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("pos")
        self.ids = table.column("anchor_id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.x = _matrix(table.column("x"))
        self.parent, self.edge = table.column("parent").to_numpy(), table.column("edge").to_numpy()
        self.levels = _levels(self.parent)

    def scores(self, x: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
               ) -> tuple[np.ndarray, np.ndarray]:
        """(scores, computed) of each anchor with the rows ``x``; computed where ``wanted`` by the bounds."""
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        largest = max(int(np.abs(x).max(initial=0)), int(np.abs(self.x).max(initial=0)))
        exact = np.float64 if largest ** 2 * x.shape[1] < 2 ** 53 else np.int64
        rows, mine = x.astype(exact), self.x.astype(exact)
        low = np.empty((len(self.ids), len(x)))
        high = np.empty_like(low)
        score = np.zeros(low.shape, np.int64)
        done = np.zeros(low.shape, bool)
        for depth, nodes in enumerate(self.levels):
            if depth == 0:
                need = np.ones((len(nodes), len(x)), bool)
            else:
                up = self.parent[nodes]
                reach = self.edge[nodes][:, None] * norm * (1 + 1e-9)
                low[nodes] = low[up] - reach - 1e-9 * np.abs(low[up]) - 1e-3
                high[nodes] = high[up] + reach + 1e-9 * np.abs(high[up]) + 1e-3
                need = wanted(nodes, low[nodes], high[nodes])
            if need.mean() > 0.1:
                got = (mine[nodes] @ rows.T).astype(np.int64)
                score[nodes] = np.where(need, got, 0)
            else:
                for i, node in enumerate(nodes):
                    at = np.flatnonzero(need[i])
                    score[node, at] = (rows[at] @ mine[node]).astype(np.int64)
            done[nodes] = need
            low[nodes] = np.where(need, score[nodes], low[nodes])
            high[nodes] = np.where(need, score[nodes], high[nodes])
        return score, done


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id."""
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]


def _row_slices(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    ids, labels, x = rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("x"))
    for at in range(0, len(ids), SLICE):
        yield ids[at:at + SLICE], labels[at:at + SLICE], x[at:at + SLICE]


# ------------------------------------------------------------------ what a task finds

def positives_of(anchors: Anchors, rows: pa.Table, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor id, ids, scores) of the best rows of the anchor's label among ``rows``."""
    empty = (np.empty(0, np.int64), np.empty(0, np.int64))
    best = [empty] * len(anchors.ids)
    worst = np.full(len(anchors.ids), -np.inf)
    for ids, labels, x in _row_slices(rows):
        fitting = (anchors.labels[:, None] == labels) & (anchors.ids[:, None] != ids)
        score, done = anchors.scores(x, lambda nodes, low, high: fitting[nodes] & (high >= worst[nodes][:, None]))
        found = done & fitting
        for i in np.flatnonzero(found.any(axis=1)):
            at = np.flatnonzero(found[i])
            best[i] = _best(np.concatenate([best[i][0], ids[at]]), np.concatenate([best[i][1], score[i, at]]), k)
            if len(best[i][0]) == k:
                worst[i] = best[i][1][-1]
    return [(int(a), *b) for a, b in zip(anchors.ids, best, strict=True)]


def windows_of(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores ``s`` with ``low p <= 100 s <= high p``, as (first, last)."""
    return -((-low * positive) // 100), (high * positive) // 100


def negatives_of(anchors: Anchors, rows: pa.Table, positives: list[np.ndarray], k: int, low: int, high: int
                 ) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor place, positive place, ids, scores) of the best rows of another label in each positive's window."""
    most = max(map(len, positives), default=0)
    first = np.full((len(positives), most), np.inf)
    last = np.full((len(positives), most), -np.inf)       # an empty window where there are fewer positives
    for i, p in enumerate(positives):
        first[i, :len(p)], last[i, :len(p)] = windows_of(p, low, high)
    best = {}
    floor = first.copy()                                   # rises to the worst of the best so far
    for ids, labels, x in _row_slices(rows):
        fitting = anchors.labels[:, None] != labels

        def wanted(nodes, lo, hi, fitting=fitting):
            inside = np.zeros(lo.shape, bool)
            for j in range(most):
                inside |= (hi >= floor[nodes, j][:, None]) & (lo <= last[nodes, j][:, None])
            return inside & fitting[nodes]

        score, done = anchors.scores(x, wanted)
        found = done & fitting
        for j in range(most):
            hit = found & (score >= floor[:, j][:, None]) & (score <= last[:, j][:, None])
            for i in np.flatnonzero(hit.any(axis=1)):
                at = np.flatnonzero(hit[i])
                old = best.get((i, j), (np.empty(0, np.int64), np.empty(0, np.int64)))
                best[i, j] = _best(np.concatenate([old[0], ids[at]]), np.concatenate([old[1], score[i, at]]), k)
                if len(best[i, j][0]) == k:
                    floor[i, j] = max(floor[i, j], best[i, j][1][-1])
    return [(i, j, *b) for (i, j), b in sorted(best.items())]


# ------------------------------------------------------------------ on Spark

def _dealt(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int):
    """Each block of anchors with each chunk of rows, as cogroups."""
    chunk = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(chunks)).cast("int")
    rows = rows.withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    anchors = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return anchors.groupBy("block", "chunk").cogroup(rows.groupBy("block", "chunk"))


def _leading(df: DataFrame, keys: list[str], id_col: str, score: str, k: int, rank: str) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(id_col))
    return df.withColumn(rank, F.row_number().over(by)).where(F.col(rank) <= k)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256) -> DataFrame:
    """Hard negatives (``OUT``) of the anchors: rows whose ``100 * score`` lies from ``low`` to ``high`` times the
    positive's score. ``is_anchor`` is a condition on a column ``id``."""
    spark = df.sparkSession
    usable = (df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).alias("v"))
              .where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
              .select("id", F.struct("label", scaled(F.col("v"), scale, bits=BITS).cast("array<int>").alias("x")).alias("r")))
    rows = written(usable.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.x"), "negatives-rows")
    dims = commonest_length(rows, "x", F.lit(1))
    rows = rows.where(F.size("x") == dims)
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    if not n_anchors:
        return spark.createDataFrame([], OUT)
    blocks = -(-n_anchors // BLOCK)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(-(-n // CHUNK), min(parallel, -(-n // LEAST_CHUNK)))

    anchors = rows.where(is_anchor).select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
                                           F.col("id").alias("anchor_id"), "label", "x")
    trees = written(anchors.groupBy("block").applyInArrow(_tree_of_block, TREE), "negatives-trees")

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found = positives_of(Anchors(left), right, positives) if left.num_rows and right.num_rows else []
        return pa.table({"anchor_id": pa.array([a for a, i, _ in found for _ in i], pa.int64()),
                         "positive_id": pa.array([int(p) for _, i, _ in found for p in i], pa.int64()),
                         "positive_score": pa.array([int(s) for _, _, v in found for s in v], pa.int64())})

    near = _dealt(rows, trees, blocks, chunks).applyInArrow(
        find_positives, "anchor_id long, positive_id long, positive_score long")
    near = written(_leading(near, ["anchor_id"], "positive_id", "positive_score", positives, "place"), "negatives-near")

    with_positives = trees.join(
        near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score")))
                                      .alias("p")), "anchor_id", "left").select(
        *trees.columns, F.transform("p", lambda r: r["positive_id"]).alias("p_ids"),
        F.transform("p", lambda r: r["positive_score"]).alias("p_scores"))

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        if left.num_rows and right.num_rows:
            left = left.sort_by("pos")
            p_ids = [v or [] for v in left.column("p_ids").to_pylist()]
            p_scores = [np.array(v or [], np.int64) for v in left.column("p_scores").to_pylist()]
            anchors = Anchors(left)
            for i, j, ids, scores in negatives_of(anchors, right, p_scores, negatives, low, high):
                for c, v in (("anchor_id", int(anchors.ids[i])), ("positive_id", p_ids[i][j]),
                             ("positive_score", int(p_scores[i][j]))):
                    out[c] += [v] * len(ids)
                out["negative_id"] += ids.tolist()
                out["negative_score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    hard = _dealt(rows, with_positives, blocks, chunks).applyInArrow(
        find_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    hard = _leading(hard, ["anchor_id", "positive_id"], "negative_id", "negative_score", negatives, "rank")
    return hard.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                       "positive_score", "negative_score")
