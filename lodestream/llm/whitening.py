"""Whitening of embeddings by eigenvectors refined in mixed precision.

Vectors become whole numbers, so sums and the covariance are exact and do not
depend on how the rows are spread or on a task that is run again. Every task adds up
its own matrix of products; the matrices are added row by row in a shuffle, and
only one matrix of the vectors' width reaches the driver. There float32
eigenvectors are the start, and Ogita-Aishima iterations in extended precision
correct them by matrix products; eigenvalues too close for an iteration are
solved again inside their own subspace.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.llm.shared import written

SCALE = 256
# Partial sums travel as four longs of 40 bits, the last with the sign.
_BITS, _DIGITS = 40, 4
_ROUNDS = 40
# Gaps must exceed what is off the diagonal by this much, so that corrections are small.
MARGIN = 32


# --- eigenvectors --------------------------------------------------------------


def _orders(values: np.ndarray) -> np.ndarray:
    return np.argsort(-values, kind="stable")


def refine(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: (eigenvalues, better eigenvectors, bound below which gaps are not told apart).

    With R = I - X'X and S = X'AX the correction E solves, to first order, the
    equations that make X + XE orthogonal and diagonal. Pairs whose eigenvalues
    are too close only get the orthogonal part.
    """
    r = np.eye(len(matrix), dtype=matrix.dtype) - vectors.T @ vectors
    s = vectors.T @ (matrix @ vectors)
    # Equal rounding on both sides of the diagonal keeps the correction orthogonal.
    s, r = (s + s.T) / 2, (r + r.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    rest = s - np.diag(values)
    bound = MARGIN * (np.sqrt((rest * rest).sum()) + np.abs(values).max(initial=0) * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > bound
    step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return values, vectors + vectors @ step, float(bound)


def _clusters(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Runs of sorted eigenvalues whose neighbours are no more than the bound apart."""
    order = _orders(values)
    breaks = np.flatnonzero(np.abs(np.diff(values[order])) > bound) + 1
    return [c for c in np.split(order, breaks) if len(c) > 1]


def orthogonal(vectors: np.ndarray) -> np.ndarray:
    """The nearest orthonormal columns, by Newton-Schulz steps."""
    eye = np.eye(vectors.shape[1], dtype=vectors.dtype)
    for _ in range(3):
        vectors = vectors @ (1.5 * eye - vectors.T @ vectors / 2)
    return vectors


def _solved_inside(matrix: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sub-solve of a cluster: eigenvectors of the matrix inside the subspace of ``basis``.

    The middle of the cluster is taken off first, so that its small differences count.
    """
    inner = basis.T @ (matrix @ basis)
    inner = (inner + inner.T) / 2 - np.eye(basis.shape[1], dtype=basis.dtype) * (np.trace(inner) / basis.shape[1])
    size = np.abs(inner).max()
    if not size:
        return basis
    return basis @ orthogonal(np.linalg.eigh((inner / size).astype(np.float64))[1].astype(basis.dtype))


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, to double precision.

    The first entry of greatest size of every vector is positive.
    """
    high = matrix.astype(np.longdouble)
    scale = np.abs(high).max(initial=0)
    if not scale:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    high = high / scale
    vectors = np.linalg.eigh(high.astype(np.float32))[1].astype(np.longdouble)
    tiny = np.finfo(np.longdouble).eps * len(matrix)
    for _ in range(_ROUNDS):
        values, better, bound = refine(high, vectors)
        better = orthogonal(better)
        change, vectors = np.abs(better - vectors).max(), better
        # Gaps below the bound are then no more than rounding.
        if change <= 16 * tiny or bound <= 16 * MARGIN * tiny:
            break
        for cluster in _clusters(values, bound):
            vectors[:, cluster] = _solved_inside(high, vectors[:, cluster])
    vectors = orthogonal(vectors)
    values = (np.diag(vectors.T @ (high @ vectors)) * scale).astype(np.float64)
    order = _orders(values)
    vectors = (vectors / np.sqrt((vectors * vectors).sum(0)))[:, order]
    peak = vectors[np.abs(vectors).argmax(0), np.arange(len(matrix))]
    return values[order], (vectors * np.where(peak < 0, -1, 1)).astype(np.float64)


# --- exact sums ------------------------------------------------------------------


def exact_products(x: np.ndarray) -> np.ndarray:
    """X'X of whole numbers as Python integers."""
    width = x.shape[1]
    out = np.zeros((width, width), object)
    if not x.size:
        return out
    largest = max(1, int(x.max()), -int(x.min()))
    if largest < 1 << 26:
        # Products of floats below 2^53 are exact, so BLAS may do them.
        rows = max(1, (1 << 53) // (largest * largest))
        for at in range(0, len(x), rows):
            part = x[at : at + rows].astype(np.float64)
            out += (part.T @ part).astype(np.int64).astype(object)
        return out
    if largest < 1 << 62:
        digits = [x & 0x1FFFFF, x >> 21 & 0x1FFFFF, x >> 42]
        for i, one in enumerate(digits):
            for j, other in enumerate(digits):
                for at in range(0, len(x), 1 << 11):
                    product = one[at : at + (1 << 11)].astype(np.float64).T @ other[at : at + (1 << 11)].astype(np.float64)
                    out += product.astype(np.int64).astype(object) * (1 << 21 * (i + j))
        return out
    return x.astype(object).T @ x.astype(object)


_PART = "i int, n bigint, digits array<bigint>"
_ARROW = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("digits", pa.list_(pa.int64()))])


def _part(i: int, n: int, values: np.ndarray) -> pa.RecordBatch:
    """A row of sums, digit by digit, so that many of them can be added as longs."""
    last = _DIGITS - 1
    digits = [int(v) >> _BITS * k if k == last else (int(v) >> _BITS * k) & ((1 << _BITS) - 1) for k in range(_DIGITS) for v in values]
    return pa.RecordBatch.from_pylist([{"i": i, "n": n, "digits": digits}], schema=_ARROW)


def _totals(parts: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Row i → (n, sums) over all parts. The rows of one i meet in a task that adds them as they come."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for frame in frames:
            for i, n, digits in frame.itertuples(index=False):
                own = sums.setdefault(i, [0, 0])
                own[0], own[1] = own[0] + n, own[1] + digits
        for i, (n, digits) in sums.items():
            yield pd.DataFrame({"i": [i], "n": [n], "digits": [digits]})

    rows = parts.repartition("i").mapInPandas(run, _PART).collect()
    out = {}
    for r in rows:
        digits = np.array(r["digits"], object).reshape(_DIGITS, -1)
        out[r["i"]] = r["n"], sum(d * (1 << _BITS * k) for k, d in enumerate(digits))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def sums_of(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """(n, per-dimension sums) of the whole vectors ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                n += len(x)
                total += (x >> 32).sum(0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)
        if n:
            yield _part(0, n, total)

    return _totals(fit.select("x").mapInArrow(run, _PART)).get(0, (0, np.zeros(width, object)))


def covariance_of(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance of ``x``, divisor n, as correctly rounded doubles.

    Vectors are centred at the whole number nearest their mean before they are
    multiplied, and the half at most that is left of the mean is taken out of the exact sums.
    """
    width = len(sums)
    near = np.array([(2 * int(s) + n) // (2 * n) for s in sums], object)
    shift = near.astype(np.int64)  # between the least and the greatest entry, so a long

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width), object), 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                small = max(int(x.max()), -int(x.min()), *map(abs, map(int, near))) < 1 << 61
                total += exact_products(x - shift if small else x.astype(object) - near)
                seen += batch.num_rows
        for i in range(width if seen else 0):
            yield _part(i, seen, total[i])

    rows = _totals(fit.select("x").mapInArrow(run, _PART))
    left = [int(s) - n * int(c) for s, c in zip(sums, near)]
    return np.array([[float(Fraction(n * int(rows[i][1][j]) - left[i] * left[j], n * n)) for j in range(width)] for i in range(width)])


# --- on Spark --------------------------------------------------------------------


def whole(vector: Column, width: int | None = None) -> Column:
    """floor(256 * c) of every entry as a long; filled with zeros up to ``width``."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))
    if width is None:
        return x
    return F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(x)))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _whitener(fit: DataFrame, n: int, sums: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, projection with 1/sqrt(e) in it, explained) of the first components that vary."""
    matrix = covariance_of(fit, n, sums)
    values, vectors = eigen(matrix)
    floor = len(values) * np.finfo(np.float64).eps * max(values.max(initial=0), 0)
    count = min(components, int((values > floor).sum()))
    mean = np.array([float(Fraction(int(s), n)) for s in sums])
    trace = float(sum(Fraction(v) for v in np.diag(matrix)))
    chosen = values[:count]
    return mean, vectors[:, :count] / np.sqrt(chosen), chosen / trace if count else chosen


def whiten(vectors: DataFrame, components: int = 4, vector: str = "embedding") -> DataFrame:
    """Rows of ``vectors`` as ``_row`` with n, deviation (DECIMAL(38, 0)), identity_error and
    ``components``, an array of (component, whitened, explained).

    Rows whose vector is null or has null or non-finite entries are left out. An entry
    c counts as x = floor(256 * c), held at the ends of a long; shorter vectors count
    as ending in zeros. The fit list has every different x once: n of them, with sums S.
    Components are the unit eigenvectors of its covariance by falling eigenvalue e, the
    entry of greatest size positive; those without variance (e no more than rounding)
    are left out, so that a table with one different vector has none. ``whitened`` is x - S/n along the
    component over sqrt(e), ``explained`` e over the trace, ``deviation`` the sum of
    (n x - S)^2, exact, null beyond 38 digits. ``identity_error`` is measured on the whitened
    fit list: the largest entry of its covariance less the identity.
    """
    rows = vectors.select(F.struct("*").alias("_row"), F.col(vector).alias("_v")).where(usable(F.col("_v")))
    width = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    empty = "array<struct<component: int, whitened: double, explained: double>>"
    if not width:
        return rows.select(
            "_row", F.lit(1).cast("bigint").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
            F.lit(None).cast("double").alias("identity_error"), F.array().cast(empty).alias("components"),
        )
    x = whole(F.col("_v"), width)
    fit = written(rows.select(x.alias("x")).distinct())
    n, sums = sums_of(fit, width)
    mean, turn, explained = _whitener(fit, n, sums, components)
    held = vectors.sparkSession.sparkContext.broadcast((mean, turn))
    error = _identity_error(fit, held, n, turn.shape[1])
    names = F.lit([float(e) for e in explained]) if len(explained) else F.array().cast("array<double>")
    made = rows.withColumn("_x", x).withColumn("_w", _projected(held)(F.col("_x")))
    parts = F.zip_with("_w", names, lambda w, e: F.struct(w.alias("whitened"), e.alias("explained")))
    numbered = F.transform(parts, lambda p, i: F.struct((i + 1).cast("int").alias("component"), p["whitened"].alias("whitened"), p["explained"].alias("explained")))
    return made.select(
        "_row", F.lit(n).cast("bigint").alias("n"), _deviation(n, sums)(F.col("_x")).try_cast("decimal(38,0)").alias("deviation"),
        F.lit(error).cast("double").alias("identity_error"), numbered.cast(empty).alias("components"),
    )


def _projected(held):
    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        mean, turn = held.value
        out = (np.stack(x.to_numpy()).astype(np.float64) - mean) @ turn if len(x) else np.zeros((0, turn.shape[1]))
        return pd.Series(list(out), dtype=object)

    return project


def _deviation(n: int, sums: np.ndarray):
    """Sum over dimensions of (n x - S)^2, as text: in longs where they hold it, else in Python's integers."""
    widest = max(abs(int(s)) for s in sums)

    @F.pandas_udf("string")
    def deviation(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        points = np.stack(x.to_numpy())
        largest = max(int(points.max()), -int(points.min()))
        if len(sums) * (n * largest + widest) ** 2 < 1 << 63:
            z = points * n - sums.astype(np.int64)
            return pd.Series((z * z).sum(1)).astype(str)
        z = points.astype(object) * n - sums
        return pd.Series((z * z).sum(1)).map(str)

    return deviation


def _identity_error(fit: DataFrame, held, n: int, count: int) -> float | None:
    """Largest entry of the whitened fit list's covariance less the identity, from all its vectors."""
    if not count:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, turn = held.value
        total, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            if batch.num_rows:
                w = (_matrix(batch.column(0), len(mean)).astype(np.float64) - mean) @ turn
                total += w.sum(0)
                products += w.T @ w
        cells = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "value"])

    cells = fit.select("x").mapInArrow(run, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value")).orderBy("cell").collect()
    values = np.array([r["value"] for r in cells])
    middle, products = values[:count] / n, values[count:].reshape(count, count) / n
    return float(np.abs(products - np.outer(middle, middle) - np.eye(count)).max())


def components_of(vectors: DataFrame, components: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    A deviation that no long holds is null.
    """
    rows = whiten(vectors, components)
    return rows.select(
        F.col("_row.vec_id").alias("vec_id"), "n", F.col("deviation").try_cast("bigint").alias("deviation"), "identity_error", F.inline("components")
    ).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
