"""Exact inner-product top-k of every query over a corpus of vectors.

Scores are quantised to 1e-9 before ranking, so the order in which a dot
product was summed never decides a rank; equal scores go to the smaller id.

Queries that fit one block of bounded rows and bytes are sent to every task and the corpus
is read in place, without a shuffle of it; a task keeps k rows per query while it streams
through its partition. A hundredth of a large corpus is ranked first: the k-th score over any
slice is a lower bound of the final k-th score, so later tasks drop what is below it. This
cuts the rows shuffled and never changes the result.

More queries do not pass the driver: both sides are dealt to blocks by a hash of their ids, and
every pair of a query block and a corpus block is ranked by one task (a cogroup), which leaves
k rows per query. Blocks are bounded in rows and bytes, so a task holds two of them whatever
the tables' sizes; what is moved is each side times the number of blocks of the other one.
In a task only scores that reach the k-th best so far are looked at again. They are first made in
single precision, whose error has a bound; what may be among the k best is scored in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.session import stored

SCALE = 1e9
# Rows of both sides whose scores are made at a time.
_QUERY_STEP, _FIRST, _MOST = 256, 1024, 8192
# Rows held beyond twice k before scores are settled, and scores settled at a time.
_SPARE, _EXACT = 64, 256
# Longer vectors and larger norms are scored in double precision throughout.
_LONGEST, _LARGEST = 1 << 16, 1e15
# More than one block of queries is dealt to at least so many, the corpus to at least so many.
_LEAST_BLOCKS, _LEAST_CORPUS_BLOCKS = 16, 2


def _matrix(column: pa.Array | pa.ChunkedArray, as_is: bool = False) -> np.ndarray:
    """[rows, dim] float64 view of a list column of equal-length vectors; ``as_is`` leaves float32."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if column.null_count:
        raise ValueError("a vector is null")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if rows and (lengths != lengths[0]).any():
        raise ValueError("all vectors of one side must have the same dimension")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not (as_is and flat.dtype == np.float32):
        flat = flat.astype(np.float64, copy=False)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def _local_topk(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best scores and their ids (score desc, id asc), unsorted."""
    n = scores.shape[1]
    if n <= k:
        return scores, np.broadcast_to(ids, scores.shape) if ids.ndim == 1 else ids
    kth = np.partition(scores, n - k, axis=1)[:, n - k]
    pick = np.argpartition(scores, n - k, axis=1)[:, n - k :]
    tied = np.flatnonzero((scores >= kth[:, None]).sum(axis=1) > k)
    for row in tied:
        row_ids = ids if ids.ndim == 1 else ids[row]
        pick[row] = np.lexsort((row_ids, -scores[row]))[:k]
    best = np.take_along_axis(scores, pick, axis=1)
    return best, ids[pick] if ids.ndim == 1 else np.take_along_axis(ids, pick, axis=1)


class _Running:
    """k best rows per query over the blocks of one task.

    Scores are made in single precision where norms allow it, which is twice as fast: they are wrong by no more than
    ``_slack``, so all that may be among the k best is kept, and only what is left of a call's rows is scored in
    double precision.
    """

    def __init__(self, qids: np.ndarray, queries: np.ndarray, floors: np.ndarray | None, k: int, skip_self: bool):
        self.qids, self.queries, self.k, self.skip_self = qids, queries, k, skip_self
        self.floors, self.norms, self.single = floors, _norms(queries), None
        # Per part of the queries: scores, ids, and the row of the call's vectors that a score is still to be made of (or -1).
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * -(-len(qids) // _QUERY_STEP)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Slices grow with what was seen, so that each adds about k new rows per query."""
        if not len(ids) or not self.parts:
            return
        slack = _slack(self.norms, _norms(vectors), vectors.shape[1])
        kind = np.float64 if slack is None else np.float32
        if slack is not None and self.single is None:
            self.single = self.queries.astype(np.float32, copy=False)
        queries = self.queries if slack is None else self.single
        at, step = 0, max(_FIRST, 2 * self.k) if self.parts[0] is None else _MOST
        while at < len(ids):
            wide = vectors[at : at + step].astype(kind, copy=False).T
            for part in range(len(self.parts)):
                here = slice(part * _QUERY_STEP, (part + 1) * _QUERY_STEP)
                scores = queries[here].astype(kind, copy=False) @ wide
                self._keep(part, here, scores, ids[at : at + step], at, None if slack is None else slack[here])
                held = self.parts[part]
                if held[0].shape[1] > 2 * self.k + _SPARE:
                    self._settle(part, vectors)
            at, step = at + step, min(_MOST, at + step)
        for part in range(len(self.parts)):
            self._settle(part, vectors)

    def _keep(self, part: int, here: slice, scores: np.ndarray, ids: np.ndarray, at: int, slack: np.ndarray | None) -> None:
        """Put what may be among the k best rows with those held before."""
        qids, held, n, k = self.qids[here], self.parts[part], scores.shape[1], self.k
        off = np.zeros(len(qids)) if slack is None else slack
        low = np.full(len(qids), -np.inf) if self.floors is None else self.floors[here]
        if held is None:
            scores[~np.isfinite(scores)] = -np.inf
            if self.skip_self:
                scores[qids[:, None] == ids] = -np.inf
            held = (np.zeros((len(qids), 0)), np.zeros((len(qids), 0), ids.dtype), np.zeros((len(qids), 0), np.int64))
            if n >= k:
                low = np.maximum(low, np.partition(scores, n - k, axis=1)[:, n - k] - off)
        elif held[0].shape[1] >= k:
            low = np.maximum(low, _nth(held[0], k) - off)
        # Scores are quantised after this look, so it leaves them room of a quantum (or some last digits).
        room = low - off - 1 / SCALE - 1e-14 * np.abs(low)
        near = scores >= np.nextafter(room.astype(scores.dtype), scores.dtype.type(-np.inf))[:, None]
        row, col = np.divmod(_true(near), n)
        found = scores[row, col].astype(np.float64)
        fine = np.isfinite(found)
        if self.skip_self:
            fine &= qids[row] != ids[col]
        row, col, found = row[fine], col[fine], found[fine]
        if slack is None:
            found = np.rint(found * SCALE) / SCALE
        count = np.bincount(row, minlength=len(qids))
        if len(row):
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            few = [np.full((len(qids), count.max()), fill, kind) for fill, kind in ((-np.inf, np.float64), (0, ids.dtype), (-1, np.int64))]
            for matrix, values in zip(few, (found, ids[col], -1 if slack is None else at + col)):
                matrix[row, place] = values
            held = tuple(np.concatenate(both, axis=1) for both in zip(held, few))
        if slack is None:
            held = _cut(held, k)
        elif held[0].shape[1] > k:
            # What is too far below the k-th score to be among them goes.
            least = _nth(held[0], k) - 2 * off - 1 / SCALE
            held[0][held[0] < least[:, None]] = -np.inf
            wide = max(k, int(np.isfinite(held[0]).sum(axis=1).max()))
            if wide < held[0].shape[1]:
                pick = np.argpartition(held[0], held[0].shape[1] - wide, axis=1)[:, -wide:]
                held = tuple(np.take_along_axis(matrix, pick, axis=1) for matrix in held)
        self.parts[part] = held

    def _settle(self, part: int, vectors: np.ndarray) -> None:
        """Score in double precision what was not yet, and keep k rows per query."""
        scores, ids, at = self.parts[part]
        row, col = np.nonzero((at >= 0) & np.isfinite(scores))
        for i in range(0, len(row), _EXACT):
            r, c = row[i : i + _EXACT], col[i : i + _EXACT]
            own, other = self.queries[part * _QUERY_STEP + r], vectors[at[r, c]]
            exact = np.einsum("ij,ij->i", own.astype(np.float64, copy=False), other.astype(np.float64, copy=False))
            scores[r, c] = np.rint(exact * SCALE) / SCALE
        if self.floors is not None:
            scores[scores < self.floors[part * _QUERY_STEP : (part + 1) * _QUERY_STEP][:, None]] = -np.inf
        self.parts[part] = _cut((scores, ids, np.full(at.shape, -1)), self.k)

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for part, held in enumerate(self.parts):
            if held is None:
                continue
            start = part * _QUERY_STEP
            row, col = np.nonzero(np.isfinite(held[0]))
            yield self.qids[start + row], held[1][row, col], held[0][row, col]


def _norms(vectors: np.ndarray) -> np.ndarray:
    steps = range(0, len(vectors), _MOST)
    squares = [np.einsum("ij,ij->i", v, v) for v in (vectors[i : i + _MOST].astype(np.float64, copy=False) for i in steps)]
    return np.sqrt(np.concatenate([np.zeros(0), *squares]))


def _slack(norms: np.ndarray, others: np.ndarray, dim: int) -> np.ndarray | None:
    """How far a score in single precision may be from the true one, per query: by rounding of both vectors, of the
    products and of their sum. None where it does not hold: very long vectors, large norms, values that are no numbers."""
    most = float(others.max())
    if dim > _LONGEST or not (most < _LARGEST and float(norms.max()) < _LARGEST):
        return None
    return 1.1 * (dim + 4) * 2.0**-24 * norms * most


def _nth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest number of each row."""
    n = scores.shape[1]
    return np.partition(scores, n - k, axis=1)[:, n - k]


def _true(mask: np.ndarray) -> np.ndarray:
    """Places of the few true values of a mask, eight looked at a time."""
    flat = mask.ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    some = np.flatnonzero(flat.view(np.uint64))
    which, bit = np.nonzero(flat.reshape(-1, 8)[some])
    return some[which] * 8 + bit


def _cut(held: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    scores, ids = _local_topk(held[0], held[1], k)
    return scores, np.array(ids), np.full(scores.shape, -1)


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _final_rank(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("cid"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _kth(ranked: DataFrame, k: int) -> DataFrame:
    """Score at rank k, null for queries that found fewer."""
    return ranked.groupBy("qid").agg(F.when(F.count("*") == k, F.min("score")).alias("low"))


def _scan(corpus: DataFrame, shipped: Broadcast, k: int, skip_self: bool) -> DataFrame:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_q, vectors_q, low = shipped.value
        running = _Running(ids_q, vectors_q, low, k, skip_self)
        for batch in batches:
            running.add(_ids(batch.column(0)), _matrix(batch.column(1), True))
        for qid, cid, score in running.rows():
            yield pa.RecordBatch.from_arrays(
                [pa.array(qid, pa.int64()), pa.array(cid, pa.int64()), pa.array(score, pa.float64())],
                names=["qid", "cid", "score"],
            )

    return corpus.mapInArrow(kernel, "qid bigint, cid bigint, score double")


def _cells(queries: DataFrame, corpus: DataFrame, blocks: int, corpus_blocks: int, k: int, skip_self: bool) -> DataFrame:
    """The k best rows of every query in every block of the corpus."""

    def kernel(cell_q: pa.Table, cell_c: pa.Table) -> pa.Table:
        running = _Running(_ids(cell_q.column("qid")), _matrix(cell_q.column("vec"), True), None, k, skip_self)
        if cell_q.num_rows and cell_c.num_rows:
            running.add(_ids(cell_c.column("cid")), _matrix(cell_c.column("vec"), True))
        found = list(running.rows())
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        qid, cid, score = (np.concatenate(part) for part in zip(empty, *found))
        return pa.table({"qid": pa.array(qid, pa.int64()), "cid": pa.array(cid, pa.int64()), "score": pa.array(score, pa.float64())})

    q_block, c_block = F.pmod(F.xxhash64("qid"), F.lit(blocks)), F.pmod(F.xxhash64("cid"), F.lit(corpus_blocks))
    # Cell number: query block times the number of corpus blocks plus the corpus block.
    q = queries.select("*", F.explode(F.sequence(F.lit(0), F.lit(corpus_blocks - 1))).alias("_c")).select("qid", "vec", (q_block * corpus_blocks + F.col("_c")).cast("int").alias("_cell"))
    c = corpus.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b")).select("cid", "vec", (F.col("_b") * corpus_blocks + c_block).cast("int").alias("_cell"))
    # A task per cell: few bytes are much work here, so tasks are neither merged by size nor dealt two cells by a hash.
    q, c = (side.repartitionById(blocks * corpus_blocks, "_cell") for side in (q, c))
    return q.groupBy("_cell").cogroup(c.groupBy("_cell")).applyInArrow(kernel, "qid bigint, cid bigint, score double")


def exact_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    qid: str = "qid",
    cid: str = "cid",
    vector: str = "embedding",
    exclude_self: bool = False,
    block_rows: int = 16_384,
    block_bytes: int = 128 << 20,
    floor_rows: int = 65_536,
) -> DataFrame:
    """Rows (qid, cid, score, rank), rank 1..k by score desc, cid asc.

    Queries and corpus ids must be unique BIGINTs. All rows are returned when
    the corpus has fewer than k. ``block_rows`` and ``block_bytes`` bound the
    matrix that is broadcast; both are checked before it is collected. More queries stay on the
    executors: they meet the corpus in pairs of blocks of about four times as many rows at most, of
    as many bytes, and the ranking is written to the shared folder. ``floor_rows`` is the smallest
    slice worth ranking first when the queries are broadcast (0: none).
    """
    q = queries.select(F.col(qid).cast("bigint").alias("qid"), F.col(vector).alias("vec"))
    c = corpus.select(F.col(cid).cast("bigint").alias("cid"), F.col(vector).alias("vec"))
    context = c.sparkSession.sparkContext
    size = q.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    if not size["n"]:
        return _final_rank(c.sparkSession.createDataFrame([], "qid bigint, cid bigint, score double"), k)
    dim = max(1, size["dim"] or 1)
    if size["n"] > max(1, min(block_rows, block_bytes // (8 * dim))):
        most = max(1, min(4 * block_rows, block_bytes // (8 * dim)))
        q, c = stored(q), stored(c)
        blocks, corpus_blocks = max(_LEAST_BLOCKS, -(-size["n"] // most)), max(_LEAST_CORPUS_BLOCKS, -(-c.count() // most))
        return stored(_final_rank(_cells(q, c, blocks, corpus_blocks, k, exclude_self), k))
    slice_ = None
    if floor_rows and c.count() > 4 * floor_rows:
        # Any slice gives a valid lower bound, so which rows it holds is free. It is read once.
        slice_ = c.where(F.pmod(F.xxhash64("cid"), F.lit(100)) == 0)
    own = q.toArrow()
    qids, matrix, floors = _ids(own.column("qid")), _matrix(own.column("vec"), True), None
    if slice_ is not None:
        shipped = context.broadcast((qids, matrix, None))
        low = {r.qid: r.low for r in _kth(_final_rank(_scan(slice_, shipped, k, exclude_self), k), k).collect()}
        shipped.unpersist()
        floors = np.array([low[int(i)] if low.get(int(i)) is not None else -np.inf for i in qids])
    return _final_rank(_scan(c, context.broadcast((qids, matrix, floors)), k, exclude_self), k)
