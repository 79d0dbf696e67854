"""Operator 13: whitening of embeddings by mixed-precision refined eigenvectors.

1. Entries become integers, x = floor(64 c) + 1000000; a vector is packed into bytes, so
   equal vectors are equal bytes. The fit list is each distinct vector once, stored.
2. One pass counts n and the sums S per dimension; a second multiplies the centred
   vectors y = n x - S, which are whole numbers too. Their products are exact: y is split
   into digits of ``DIGIT`` bits, so that float64 matrix products of ``ROWS`` rows stay
   below 2 ** 53, and sums are carried in digits of whole numbers through task and
   shuffle. The result is n ** 3 times the covariance V (divisor n).
3. The d x d matrix V goes to the driver (its size depends on the dimension alone), which
   takes eigenvectors of its float32 form and corrects them by Ogita and Aishima's
   iterations in extended precision: with R = I - X'X and S = X'VX, X becomes X + XE,
   E[i, j] = (S[i, j] + l[j] R[i, j]) / (l[j] - l[i]). Eigenvalues nearer than the error
   that is left form a cluster: there E is R / 2, which only makes X orthogonal, and the
   small eigenproblem of the cluster's own block, shifted by its mean and scaled, is
   solved by itself and turned into X. Each iteration squares the error, so clusters fall
   apart until only eigenvalues equal to rounding are left together.
4. Every row is projected; the covariance of the projected fit list (mean first, then
   centred products) gives ``identity_error``.

Defined cases: rows whose vector is null, or holds a null, non-finite or (beyond 2 ** 56)
unrepresentable entry, are dropped, and so are vectors whose length is not the table's
(its commonest length, of equals the greatest). Repeated rows and null vec_ids are kept
and get a result each. A component without variance has ``whitened`` null and stays out
of ``identity_error``; with no variance at all ``explained`` is null. ``deviation`` is null
where it does not fit a long. No rows, no result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored

SCALE, SHIFT = 64, 1_000_000  # fixed values of the contract
COMPONENTS = 16
LARGEST = 2.0 ** 56  # 64 c stays below 2 ** 62
DIGIT, ROWS = 20, 4096  # 2 * DIGIT + log2(ROWS) <= 53
MOST_STEPS, SMALL = 30, 1e-10
_MASK = (1 << DIGIT) - 1
_WIDTHS = [np.dtype(t) for t in ("<i1", "<i2", "<i4", "<i8")]


# --- integer vectors ------------------------------------------------------------------
def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    entries = F.col("embedding").cast("array<double>")
    whole = F.forall(entries, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))  # NaN is greatest
    return embeddings.select("vec_id", entries.alias("embedding")).filter(F.col("embedding").isNotNull() & whole)


def dimension(rows: DataFrame) -> int | None:
    """The commonest length of vectors, of equals the greatest."""
    counts = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return counts and counts["d"]


def pack(vectors: np.ndarray) -> list[bytes]:
    """Bytes per row of integers (less SHIFT), in the least width that holds the row."""
    x = np.floor(SCALE * vectors).astype(np.int64)
    least, greatest = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    out: list[bytes] = [b""] * len(x)
    left = np.ones(len(x), bool)
    for width in _WIDTHS:
        info = np.iinfo(width)
        fit = left & (least >= info.min) & (greatest <= info.max)
        left &= ~fit
        some = np.flatnonzero(fit)
        data, size = x[some].astype(width).tobytes(), x.shape[1] * width.itemsize
        for k, i in enumerate(some.tolist()):
            out[i] = data[k * size:(k + 1) * size]
    return out


def unpack(packed: list[bytes], d: int) -> np.ndarray:
    """Rows of integers x."""
    out = np.empty((len(packed), d), np.int64)
    sizes = np.fromiter(map(len, packed), np.int64, len(packed))
    for width in _WIDTHS:
        some = np.flatnonzero(sizes == d * width.itemsize)
        out[some] = np.frombuffer(b"".join([packed[i] for i in some.tolist()]), width).reshape(len(some), d)
    return out + SHIFT


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def packed_rows(rows: DataFrame, d: int) -> DataFrame:
    """vec_id, x (packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(pack(_matrix(batch, d)), pa.binary())], ["vec_id", "x"])

    kept = rows.filter(F.size("embedding") == d).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return kept.mapInArrow(run, "vec_id long, x binary")


# --- exact sums -----------------------------------------------------------------------
def sums(fit: DataFrame, d: int) -> tuple[int, list[int], int]:
    """n, sums per dimension, and the greatest |x - SHIFT|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, most = 0, [0] * d, 0
        for batch in batches:
            x = unpack(batch.column("x").to_pylist(), d) - SHIFT
            if len(x):
                most = max(most, int(np.abs(x).max()))
                exact = x if most < 1 << 40 else x.astype(object)  # a batch holds fewer than 2 ** 23 rows
                n, total = n + len(x), [a + int(b) for a, b in zip(total, exact.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([most] * d, pa.int64()),
                pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "n", "most", "total"])

    found = fit.mapInArrow(run, "i int, n long, most long, total decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.max("most").alias("most"), F.sum("total").alias("total")).orderBy("i").collect()  # d rows
    if not found:
        return 0, [0] * d, 0
    n = found[0]["n"]
    return n, [int(r["total"]) + SHIFT * n for r in found], max(r["most"] for r in found)


class Centred:
    """n x - S as whole numbers."""

    def __init__(self, n: int, total: list[int], most: int):
        self.n = n
        self.bound = n * most + max(map(abs, (t - SHIFT * n for t in total)), default=0)  # of any entry
        self.dtype = np.int64 if self.bound < 1 << 62 else object
        self.total = np.array([t - SHIFT * n for t in total], self.dtype)

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - SHIFT).astype(self.dtype) * self.n - self.total

    @property
    def digits(self) -> int:
        return self.bound.bit_length() // DIGIT + 1


def split(y: np.ndarray, digits: int) -> list[np.ndarray]:
    """float64 digits, lowest first; only the last carries a sign."""
    out = []
    for _ in range(digits - 1):
        out.append((y & _MASK).astype(np.float64))
        y = y >> DIGIT
    return [*out, y.astype(np.float64)]


def products(fit: DataFrame, d: int, centred: Centred) -> list[list[int]]:
    """Sum of y y' over the fit list, exact."""
    digits = centred.digits
    places = 2 * digits  # one more for the carry
    names = [f"p{k}" for k in range(places)]
    row, column = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((places, d, d), np.int64)
        some = False
        for batch in batches:
            packed = batch.column("x").to_pylist()
            for at in range(0, len(packed), ROWS):
                part = split(centred.of(unpack(packed[at:at + ROWS], d)), digits)
                some = True
                for i in range(digits):
                    for j in range(i, digits):
                        g = part[i].T @ part[j]
                        held[i + j] += (g if i == j else g + g.T).astype(np.int64)
                for k in range(places - 1):  # every place but the last within DIGIT bits again
                    held[k + 1] += held[k] >> DIGIT
                    held[k] &= _MASK
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int32()), pa.array(column, pa.int32()), *[pa.array(h[row, column]) for h in held]],
                ["i", "j", *names])

    schema = "i int, j int, " + ", ".join(f"{p} long" for p in names)
    found = fit.mapInArrow(run, schema).groupBy("i", "j").agg(*[F.sum(p).alias(p) for p in names]).collect()  # d x d
    out = [[0] * d for _ in range(d)]
    for r in found:
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = sum(r[p] << (DIGIT * k) for k, p in enumerate(names))
    return out


def extended(value: int) -> np.longdouble:
    """A whole number to the full extended precision."""
    head = int(float(value))
    return np.longdouble(head) + np.longdouble(float(value - head))


# --- eigenvectors ---------------------------------------------------------------------
def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Runs of two or more sorted values that lie within ``gap`` of their neighbour."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refine_step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction of the approximate eigenvectors ``x`` of ``a`` (both extended):
    better vectors, eigenvalues, size of the correction."""
    d = len(a)
    r = np.eye(d, dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    size = lambda m: np.sqrt((m * m).sum())
    gap = 2 * (size(s - np.diag(values)) + np.abs(values).max() * size(r))
    together = np.eye(d, dtype=bool)
    clusters = _clusters(values, gap)
    for c in clusters:
        together[np.ix_(c, c)] = True
    apart = values[None, :] - values[:, None]
    apart[together] = 1
    e = np.where(together, r / 2, (s + values[None, :] * r) / apart)
    better = x + x @ e
    for c in clusters:
        own = better[:, c]
        block = own.T @ (a @ own)
        mean = np.trace(block) / len(c)
        block = (block + block.T) / 2 - mean * np.eye(len(c), dtype=x.dtype)
        scale = np.abs(block).max()
        if scale > 0:
            turn = np.linalg.eigh((block / scale).astype(np.float64))[1].astype(x.dtype)
            better[:, c] = own @ turn
    return better, values, float(np.abs(e).max())


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns, their largest entry positive)
    of a symmetric matrix in extended precision."""
    d = len(a)
    scale = np.abs(a).max() if d else 0
    if not scale:
        return np.zeros(d), np.eye(d)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    small = 0
    for _ in range(MOST_STEPS):
        x, values, correction = refine_step(a, x)
        small = small + 1 if correction < SMALL else 0
        if small == 2:  # convergence is quadratic; the second turn sees clusters fallen apart
            break
    for _ in range(2):  # rounding over the gap of near eigenvalues is what is left
        x = x + x @ (np.eye(d, dtype=x.dtype) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) * scale
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(d)])
    return values, (x * np.where(sign < 0, -1, 1))


# --- the operator ---------------------------------------------------------------------
class Model:
    """Whitening of integer vectors: components that have variance come first."""

    def __init__(self, centred: Centred, gram: list[list[int]], components: int):
        d, n = len(gram), centred.n
        self.centred, self.components = centred, min(components, d)
        v = np.array([[extended(g) for g in row] for row in gram], np.longdouble).reshape(d, d) / np.longdouble(n) ** 3
        values, vectors = eigen(v)
        trace = extended(sum(gram[i][i] for i in range(d))) / np.longdouble(n) ** 3
        values, vectors = values[:self.components], vectors[:, :self.components]
        # what is left of a component without variance is rounding
        self.live = int((values > trace * d * np.finfo(np.longdouble).eps * 8).sum()) if trace > 0 else 0
        self.explained = [float(e / trace) if k < self.live else 0.0 for k, e in enumerate(values)] if trace > 0 else None
        self.vectors = (vectors[:, :self.live] / np.sqrt(values[:self.live])).astype(np.float64)

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """rows x live components of centred whole numbers n x - S."""
        return (y.astype(np.float64) / self.centred.n) @ self.vectors


def identity_error(fit: DataFrame, d: int, model: Model) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = model.live
    if not k:
        return None
    n, centred = model.centred.n, model.centred

    def parts(value) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = 0.0
            for batch in batches:
                packed = batch.column("x").to_pylist()
                for at in range(0, len(packed), ROWS):
                    held = held + value(model.whiten(centred.of(unpack(packed[at:at + ROWS], d))))
            if np.ndim(held):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(np.size(held)), pa.int32()), pa.array(np.ravel(held))], ["i", "v"])

        return fit.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))

    mean = np.array([r["v"] for r in parts(lambda w: w.sum(axis=0)).orderBy("i").collect()]) / n  # k numbers
    found = parts(lambda w: (w - mean).T @ (w - mean)).orderBy("i").collect()  # k x k numbers
    covariance = np.array([r["v"] for r in found]).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row and component."""
    rows = usable(embeddings)
    d = dimension(rows)
    if not d:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    whole = packed_rows(rows, d)
    fit = stored(whole.select("x").distinct())
    n, total, most = sums(fit, d)
    centred = Centred(n, total, most)
    model = Model(centred, products(fit, d, centred), components)
    error = identity_error(fit, d, model)
    count, live = model.components, model.live
    square = np.int64 if d * centred.bound ** 2 < 1 << 63 else object

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, vec_ids = batch.column("x").to_pylist(), batch.column("vec_id")
            for at in range(0, len(packed), ROWS):
                y = centred.of(unpack(packed[at:at + ROWS], d))
                m = len(y)
                deviation = (y.astype(square) ** 2).sum(axis=1).tolist()
                white = np.full((m, count), np.nan)
                white[:, :live] = model.whiten(y)
                again = np.repeat(np.arange(m), count)
                explained = [None] * count if model.explained is None else model.explained
                yield pa.RecordBatch.from_arrays([
                    vec_ids.slice(at, m).take(pa.array(again)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, n, np.int64)),
                    pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()).take(pa.array(again)),
                    pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                    pa.array(explained * m, pa.float64()), pa.array([error] * (m * count), pa.float64())],
                    [c.split()[0] for c in RESULT.split(", ")])

    return whole.mapInArrow(run, RESULT)

