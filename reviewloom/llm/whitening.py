"""Whitening of vectors by the leading eigenvectors of their covariance, found by slicing its spectrum."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from reviewloom.session import materialize

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Scaled entries beyond this are treated like infinite ones, so that every whole number stays exact in a double.
LARGEST = 2.0**52
EPS = np.finfo(float).eps


# the spectrum of one symmetric matrix

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix that has the same inertia under every shift, so that the
    LDL' factors of a shifted matrix take d steps: Householder reflections from both sides keep the eigenvalues."""
    a = np.array(matrix, float)
    for k in range(len(a) - 2):
        x = a[k + 1:, k]
        norm = np.sqrt(x @ x)
        if norm == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.sqrt(v @ v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = 0
        a[k + 1, k] = -np.copysign(norm, x[0])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each shift, how many eigenvalues lie above it: the positive pivots of the LDL' factors of the shifted
    matrix (Sylvester's law of inertia), all shifts at a time."""
    least = np.finfo(float).tiny * max(1.0, (off * off).max() if len(off) else 0)
    pivot = diagonal[0] - shifts
    above = (pivot > 0).astype(int)
    with np.errstate(over="ignore"):
        for d, e in zip(diagonal[1:], off):
            pivot = np.where(np.abs(pivot) < least, -least, pivot)
            pivot = d - shifts - e * e / pivot
            above += pivot > 0
    return above


def _slices(diagonal: np.ndarray, off: np.ndarray, k: int, width: float) -> np.ndarray:
    """(low, high) around each of the ``k`` largest eigenvalues: halved together by counts until each holds a
    single one with room to its neighbours, or is no wider than ``width``."""
    reach = np.abs(off)
    radius = np.append(reach, 0) + np.append(0, reach)
    low = np.full(k, (diagonal - radius).min() - width)
    high = np.full(k, (diagonal + radius).max() + width)
    number = np.arange(1, k + 1)
    while (high - low > width).any():
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        over = counts_above(diagonal, off, middle) >= number
        low, high = np.where(over, middle, low), np.where(over, high, middle)
        apart = np.append(low[:-1] - high[1:], np.inf)
        apart = np.minimum(apart, np.append(np.inf, apart[:-1]))
        if (apart >= 4 * (high - low)).all():
            inside = counts_above(diagonal, off, low) - counts_above(diagonal, off, high)
            if (inside == 1).all():
                break
    return np.stack([low, high], axis=1)


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, vectors as columns) of the ``k`` largest eigenvalues of a symmetric matrix.

    Inertia counts of shifted matrices isolate each eigenvalue in an interval of its own. From its middle,
    Rayleigh quotient iteration converges cubically to the eigenvector; a result outside its interval (it
    belongs to another eigenvalue) sends the interval back to be halved. Eigenvalues too close to be told
    apart in double precision share their interval: their invariant subspace is iterated as a whole and
    split by its own small matrix. Afterwards counts just below and above every value certify its number.
    """
    d = len(matrix)
    k = min(k, d)
    scale = np.abs(matrix).max()
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(d)[:, :k]
    a = matrix / scale
    diagonal, off = tridiagonal(a)
    width = 8 * d * EPS
    bounds = _slices(diagonal, off, k, width)
    start = np.random.default_rng(d).normal(size=(d, d))
    values, vectors = np.zeros(k), np.zeros((d, k))
    i = 0
    while i < k:
        j = i + 1
        while j < k and bounds[j, 1] >= bounds[j - 1, 0] - width:
            j += 1
        low, high = bounds[j - 1, 0], bounds[i, 1]
        below, above = counts_above(diagonal, off, np.array([low - width, high + width]))
        inside = max(int(below - above), j - i)
        if inside == 1:
            values[i], vectors[:, i] = _rayleigh(a, diagonal, off, i + 1, low, high, start[:, 0], vectors[:, :i])
        else:  # a cluster; of its last one perhaps only a part is asked for
            own, basis = _cluster(a, (low + high) / 2, start[:, :inside], vectors[:, :i])
            values[i:j], vectors[:, i:j] = own[:j - i], basis[:, :j - i]
        i = j
    _certify(diagonal, off, values, 64 * d * EPS)
    return values * scale, vectors


def _solve(a: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(a - shift)^-1 right; a shift that is an eigenvalue to the last bit is moved by one."""
    shifted = a - shift * np.eye(len(a))
    try:
        found = np.linalg.solve(shifted, right)
        if np.isfinite(found).all():
            return found
    except np.linalg.LinAlgError:
        pass
    return np.linalg.solve(shifted + EPS * np.eye(len(a)), right)


def _rayleigh(a, diagonal, off, number, low, high, start, before) -> tuple[float, np.ndarray]:
    """Value and unit vector of the eigenvalue ``number``, the only one between ``low`` and ``high``."""
    width = 8 * len(a) * EPS
    while True:
        x, least = start, np.inf
        for _ in range(2):  # inverse iteration from the middle turns the start towards the one eigenvector
            x = _solve(a, (low + high) / 2, x)
            x /= np.sqrt(x @ x)
        for _ in range(10):
            quotient = x @ (a @ x)
            residual = a @ x - quotient * x
            size = np.sqrt(residual @ residual)
            if size >= least:
                break
            least, value, found = size, quotient, x
            x = _solve(a, quotient, x)
            x /= np.sqrt(x @ x)
        if low - width <= value <= high + width or high - low <= width:
            found = found - before @ (before.T @ found)
            return value, found / np.sqrt(found @ found)
        middle = (low + high) / 2
        if counts_above(diagonal, off, np.array([middle]))[0] >= number:
            low = middle
        else:
            high = middle


def _cluster(a, shift, start, before) -> tuple[np.ndarray, np.ndarray]:
    """Values (falling) and orthonormal vectors of the eigenvalues next to ``shift``, as many as ``start`` has columns."""
    basis = start
    for _ in range(4):
        basis = _solve(a, shift, basis)
        basis -= before @ (before.T @ basis)
        basis, _ = np.linalg.qr(basis)
    own, turn = np.linalg.eigh(basis.T @ a @ basis)
    return own[::-1], (basis @ turn)[:, ::-1]


def _certify(diagonal, off, values, margin) -> None:
    """Raises unless every value has as many eigenvalues above it as its number says."""
    number = np.arange(1, len(values) + 1)
    least, most = counts_above(diagonal, off, values - margin), counts_above(diagonal, off, values + margin)
    if not ((least >= number) & (most < number)).all():
        raise ArithmeticError("eigenvalues are not numbered as the inertia counts say")


# the fit over all vectors

@dataclass(frozen=True)
class Whitening:
    """The fit: number of vectors, exact sums, unit eigenvectors as columns with falling ``values``, and the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _matrix(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, whole numbers) of the usable vectors of an Arrow column: ``d`` entries, none null or out of range."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), d), False).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(fits)
    flat = column.filter(pa.array(fits)).flatten().cast(pa.float64())
    entries = np.floor(SCALE * flat.to_numpy(zero_copy_only=False).reshape(len(rows), d))
    usable = (np.abs(entries) <= LARGEST).all(axis=1)  # false for NaN, which nulls become
    return rows[usable], entries[usable].astype(np.int64) + SHIFT


def _sums(d: int):
    """(i, n, total) of each task: exact sums of the whole numbers, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            rows, numbers = _matrix(batch.column(0), d)
            if len(rows):
                large = float(np.abs(numbers).max()) * len(rows) >= 2.0**62
                own = (numbers.astype(object) if large else numbers).sum(axis=0)
                sums = [a + int(b) for a, b in zip(sums, own)]
                n += len(rows)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(x) for x in sums])], ["i", "n", "total"])

    return run


def _products(centred):
    """(i, cells): row i of the sum of a task's products of ``centred`` (batch) with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = centred(batch)
            if len(rows):
                own = rows.T @ rows
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "cells"])

    return run


def _covariance(parts: DataFrame, d: int, n: int) -> np.ndarray:
    """The d x d sums over the rows of all tasks, divided by ``n``; d x d numbers are what reaches the driver."""
    cells = parts.select("i", F.posexplode("cells").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    found = np.zeros((d, d))
    for row in cells.collect():
        found[row.i, row.j] = row.x / n
    return (found + found.T) / 2


def _split_centre(n: int, sums) -> tuple[np.ndarray, np.ndarray]:
    """S / n as a whole number and the rest of n parts of it, both exact."""
    whole = np.array([s // n for s in sums], np.int64)
    return whole, np.array([s % n for s in sums], np.int64)


def dimension(vectors: DataFrame) -> int:
    """The length that most vectors have, of equally frequent ones the largest; 0 without vectors."""
    found = vectors.select(F.size("embedding").alias("d")).filter("d > 0").groupBy("d").agg(F.count("*").alias("n")).agg(
        F.max(F.struct("n", "d"))["d"]).first()[0]
    return found or 0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable ``vectors`` (embedding); None if there are none.

    One pass sums the whole numbers exactly, a second one multiplies them centred. Each task adds up one
    matrix of d x d, the tasks' matrices are added by Spark, and the eigenvectors of that one matrix are
    found on the driver. Sums are stored before they are read, so that a repeated task cannot change them.
    """
    column = vectors.select(F.col("embedding").cast("array<double>").alias("embedding"))
    d = dimension(column)
    if not d:
        return None
    parts = materialize(column.mapInArrow(_sums(d), "i int, n long, total string"), "sums")
    totals = {r.i: r for r in parts.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    if not totals:
        return None
    n, sums = totals[0].n, tuple(int(totals[i].total) for i in range(d))
    whole, rest = _split_centre(n, sums)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (_matrix(batch.column(0), d)[1] - whole) - rest / n

    covariance = _covariance(materialize(column.mapInArrow(_products(centred), "i int, cells array<double>"), "products"), d, n)
    values, found = leading_eigenpairs(covariance, components)
    return Whitening(n, sums, values, found, float(np.trace(covariance)))


def _deviation(apart: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """The exact sums of (n * apart - rest)^2; None where a long can't hold them."""
    rough = ((n * apart.astype(float) - rest) ** 2).sum(axis=1)
    exact = ((n * apart - rest) ** 2).sum(axis=1).tolist()
    for i in np.flatnonzero(rough > 2.0**62):
        found = sum((n * int(a) - int(b)) ** 2 for a, b in zip(apart[i], rest))
        exact[i] = found if found < 1 << 63 else None
    return exact


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, whitened (one entry a component, by falling eigenvalue) of the usable rows of ``vectors``.

    A component without variance (its eigenvalue is rounding error) is null. ``deviation`` is the sum over the
    dimensions of (n * x - S)^2, null where that is beyond a long.
    """
    d, n = len(model.sums), model.n
    whole, rest = _split_centre(n, model.sums)
    real = model.values > d * EPS * (model.values[0] if len(model.values) else 0)
    scale = np.where(real, 1 / np.sqrt(np.where(real, model.values, 1)), np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers = _matrix(batch.column(1), d)
            apart = numbers - whole
            flat = (((apart - rest / n) @ model.vectors) * scale).ravel()
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(_deviation(apart, rest, n), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, mask=np.isnan(flat)))],
                ["vec_id", "deviation", "whitened"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        run, "vec_id long, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the covariance of ``rows`` (whitened) minus the identity; None without components.

    The columns are summed first, so that they are centred before they are multiplied."""
    real = np.flatnonzero(model.values > len(model.sums) * EPS * (model.values[0] if len(model.values) else 0))
    if not len(real):
        return None
    first = rows.select(*[F.sum(F.get("whitened", F.lit(int(c)))).alias(f"c{c}") for c in real]).first()
    mean, k = np.array(first, float) / model.n, len(model.values)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[:, real] - mean

    parts = materialize(rows.select("whitened").mapInArrow(_products(centred), "i int, cells array<double>"), "products")
    return float(np.abs(_covariance(parts, len(real), model.n) - np.eye(len(real))).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row of ``vectors``
    (vec_id, embedding) and component, from 1 by falling eigenvalue.

    Defined cases: null vectors, and those that hold null, NaN, infinite or, scaled, non-exact entries, are
    left out; so are vectors whose length is not the usual one (:func:`dimension`). A null vec_id takes part,
    rows that repeat count each. A component without variance has null in ``whitened``; vectors that are all
    equal have null in ``explained`` and ``identity_error`` too. With fewer dimensions than components there
    are as many as dimensions. An empty table gives an empty result; other columns are not read.
    """
    model = fit(vectors, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = materialize(whiten(vectors, model), "whitened")
    explained = [float(x) / model.trace if model.trace > 0 else None for x in model.values]
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("c", "whitened"))
    return each.select(
        "vec_id", (F.col("c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("c")).alias("explained"),
        F.lit(identity_error(rows, model)).cast("double").alias("identity_error"))
