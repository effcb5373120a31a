"""Exact top-k by inner product with a dual-tree search over cover trees.

The data stay where they are: every task builds a cover tree over the vectors of
its partition, and one over a block of queries that is broadcast. The pair of
trees is walked together, best pair first; a pair of nodes is dropped when the
largest inner product that their centres and covering radii allow is below the
worst k-th score of the query node. Each task returns at most k rows per query.
The query set grows with the data, so it is cut into blocks of fixed size, and
each block is one pass, ranked and stored before the next one is sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import cut, positions, written

SCALE = 1024
BLOCK = 4096
_LEAF = 256
_QUERY_LEAF = 64
_FANOUT = 16
_EXACT = float(1 << 53)


class CoverTree:
    """Nodes with a centre (one of the points), a covering radius and children.

    A node's points are covered by children whose centres are points at least half
    the node's radius apart; a node with few points, or of equal points, is a leaf.
    Where a cover of half the radius needs too many centres, as with points that are
    all equally far from each other, the first few centres cover with the radius
    they reach: bounds use the true radii, so results do not depend on it.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.points = points
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.members: list[np.ndarray] = []
        if len(points):
            everyone = np.arange(len(points))
            first = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
            todo = [(self._node(first, everyone), everyone)]
            while todo:
                node, members = todo.pop()
                if len(members) <= leaf or self.radius[node] == 0:
                    self.members[node] = members
                    continue
                for centre, own in self._cover(self.centre[node], members, self.radius[node] / 2):
                    child = self._node(centre, own)
                    self.children[node].append(child)
                    todo.append((child, own))

    def _node(self, centre: int, members: np.ndarray) -> int:
        away = np.sqrt(((self.points[members] - self.points[centre]) ** 2).sum(1))
        self.centre.append(centre)
        self.radius.append(float(away.max()))
        self.children.append([])
        self.members.append(members[:0])
        return len(self.centre) - 1

    def _cover(self, centre: int, members: np.ndarray, reach: float) -> list[tuple[int, np.ndarray]]:
        """Farthest-first centres until all members are within ``reach`` of one."""
        points = self.points[members]
        nearest = np.sqrt(((points - self.points[centre]) ** 2).sum(1))
        owner = np.zeros(len(members), np.int64)
        centres = [centre]
        while len(centres) < _FANOUT and nearest[far := int(nearest.argmax())] > reach:
            away = np.sqrt(((points - points[far]) ** 2).sum(1))
            closer = away < nearest
            owner[closer] = len(centres)
            nearest[closer] = away[closer]
            centres.append(int(members[far]))
        return [(c, members[owner == i]) for i, c in enumerate(centres) if (owner == i).any()]


def dual_search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, id, score) of the k best per query, ties to smaller ids.

    Rows with the query's own id take no part. Both sides hold whole numbers.
    """
    limit = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    exact = limit < _EXACT
    # Sums beyond 2**53 are taken in Python's integers.
    left, right = (queries, data) if exact else tuple(np.vectorize(int, otypes=[object])(m) if m.size else m for m in (queries, data))
    q_tree, d_tree = CoverTree(queries, _QUERY_LEAF), CoverTree(data, _LEAF)
    q_norm, d_norm = (np.sqrt((t.points[t.centre] ** 2).sum(1)) if t.centre else np.zeros(0) for t in (q_tree, d_tree))
    empty = np.zeros(0, np.int64)
    best_ids = [empty] * len(queries)
    best_scores: list[np.ndarray] = [empty] * len(queries)
    worst = np.full(len(queries), -np.inf)
    # Bounds are rounded; scores beyond 2**53 are compared as floats here.
    slack = limit * 1e-9 + 1e-6
    below: list[np.ndarray] = [m for m in q_tree.members]
    for node in range(len(q_tree.centre) - 1, -1, -1):
        if q_tree.children[node]:
            below[node] = np.concatenate([below[c] for c in q_tree.children[node]])

    def reach(q: int, nodes: np.ndarray) -> np.ndarray:
        """The largest inner product between points under q and under each node."""
        centres = d_tree.points[[d_tree.centre[n] for n in nodes]]
        radii = np.array([d_tree.radius[n] for n in nodes])
        rq = q_tree.radius[q]
        middle = centres @ q_tree.points[q_tree.centre[q]]
        return middle + q_norm[q] * radii + d_norm[nodes] * rq + rq * radii

    def compare(q: int, nodes: np.ndarray) -> None:
        rows = np.concatenate([d_tree.members[n] for n in nodes])
        members = q_tree.members[q]
        table = left[members] @ right[rows].T
        if exact:
            table = table.astype(np.int64)
        else:
            table = np.vectorize(lambda s: min(max(int(s), -(2**63)), 2**63 - 1), otypes=[np.int64])(table)
        for query, scores in zip(members, table):
            hopeful = np.flatnonzero((scores >= worst[query]) & (ids[rows] != query_ids[query]))
            if not len(hopeful):
                continue
            all_ids = np.concatenate([best_ids[query], ids[rows[hopeful]]])
            all_scores = np.concatenate([best_scores[query], scores[hopeful]])
            if len(all_ids) > k:
                keep = all_scores >= np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k]
                all_ids, all_scores = all_ids[keep], all_scores[keep]
            order = np.lexsort((all_ids, ~all_scores))[:k]
            best_ids[query], best_scores[query] = all_ids[order], all_scores[order]
            if len(order) == k:
                worst[query] = np.nextafter(float(all_scores[order[-1]]), -np.inf)

    # Each entry: a query node and data nodes that may still hold answers for it.
    todo: list[tuple[int, np.ndarray]] = [(0, np.zeros(1, np.int64))] if q_tree.centre and d_tree.centre else []
    while todo:
        q, nodes = todo.pop()
        while len(nodes):
            bound = reach(q, nodes)
            alive = bound + slack >= worst[below[q]].min(initial=np.inf)
            nodes, bound = nodes[alive], bound[alive]
            if not len(nodes):
                break
            leaves = np.array([not d_tree.children[n] for n in nodes])
            if q_tree.children[q] and (leaves.all() or q_tree.radius[q] >= max(d_tree.radius[n] for n in nodes)):
                todo += [(c, nodes) for c in q_tree.children[q]]
                break
            if not q_tree.children[q] and leaves.all():
                # Most promising leaves first, and the bound is checked again after each few.
                order = np.argsort(-bound, kind="stable")
                compare(q, nodes[order[:8]])
                nodes = nodes[order[8:]]
                continue
            # Open the data nodes that are not leaves.
            inner = nodes[~leaves]
            opened = np.array([c for n in inner for c in d_tree.children[n]], np.int64)
            if not q_tree.children[q] and leaves.any():
                compare(q, nodes[leaves])
                nodes = opened
            else:
                nodes = np.concatenate([nodes[leaves], opened])
    counts = [len(b) for b in best_ids]
    rows = np.repeat(np.arange(len(queries)), counts)
    return rows, np.concatenate([empty, *best_ids]), np.concatenate([empty, *best_scores])


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows with an id whose vector is there and finite throughout."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine
    )


def _whole(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).reshape(len(rows), width)


def _by_width(ids: np.ndarray, column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Distinct rows as (ids, whole numbers) per vector length."""
    widths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = {}
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        own, points = np.ascontiguousarray(ids[rows], np.int64), _whole(column, rows, width) + 0.0
        packed = np.ascontiguousarray(np.concatenate([own[:, None], points.view(np.int64)], 1))
        _, first = np.unique(packed.view(np.dtype((np.void, packed.shape[1] * 8))).ravel(), return_index=True)
        out[width] = (own[first], points[first])
    return out


def top_k(queries: DataFrame, data: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``data`` per query.

    Both frames have ``vec_id`` and ``embedding``. Components become
    floor(1024 * x). Vectors that are null or have null or non-finite components
    take no part, nor do rows without an id or a row with the query's own id.
    Repeated rows count once. Vectors of another length than the query's are not
    compared with it. Scores beyond a long are held at its ends.
    """
    asked = cut(usable(queries, "vec_id", "embedding").distinct())
    placed = cut(positions(asked.withColumn("_all", F.lit(0)), ["_all"], ["vec_id"]))
    last = placed.agg(F.max("_pos")).first()[0]
    if last is None:
        return placed.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.col("vec_id").alias("score"))
    done = []
    for start in range(0, last + 1, block):
        held = placed.where((F.col("_pos") >= start) & (F.col("_pos") < start + block)).select("vec_id", "embedding").toArrow()
        ids = held.column("vec_id").to_numpy()
        shared = data.sparkSession.sparkContext.broadcast(_by_width(ids, held.column("embedding").combine_chunks()))
        ranked = _ranked(_scan(data, shared, k), k)
        if last < block:
            return ranked
        # Ranked to the end and stored, so that one block of queries is held at a time.
        done.append(written(ranked))
        shared.destroy()
    return reduce(DataFrame.union, done)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _scan(data: DataFrame, shared: Broadcast, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        own = _by_width(table.column(0).to_numpy(), table.column(1).combine_chunks())
        for width, (query_ids, queries) in shared.value.items():
            if width not in own:
                continue
            ids, points = own[width]
            rows, got, scores = dual_search(queries, query_ids, points, ids, k)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[rows]), pa.array(got), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return usable(data, "vec_id", "embedding").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
