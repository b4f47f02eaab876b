"""Embedding whitening by spectral divide and conquer with QDWH polar decompositions.

The covariance is added up by Spark in two passes (sums, then centred products). Its eigenvectors
come from polar decompositions: that of V - s I, found by dynamically weighted Halley steps on QR
factorisations, is the matrix sign, (sign + I) / 2 projects on the subspace of the eigenvalues above
s, and a QR factorisation of the projector splits V into two smaller blocks, which are split again
until they are single numbers. Only d x d matrices, d being the length of the vectors, reach the
driver or are broadcast.

Entries c become whole numbers x = floor(64 c) + 1,000,000. Sums of x are exact. Products are taken
of x - S/n, never of x.

Defined results: rows whose vector is null, or holds a null or an entry that is not finite, are
dropped, and so are vectors whose length is not the most frequent one (the longer one of equally
frequent ones). x stays within 2**52 of zero. A component whose eigenvalue is not above
d * 2**-52 of the largest has no defined direction after scaling, so it is left out; one remaining
row, or only equal ones, or an empty table, thus give no rows. ``deviation`` is null where it does
not fit 64 bits. Repeated rows and ids each count. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewise.llm.shared import ready
from duewise.session import staged

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
_LIMIT = float(1 << 52)
_EPS = np.finfo(np.float64).eps


# ---- eigenvectors on the driver, d x d -----------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal (here symmetric) factor of a symmetric matrix by QDWH steps."""
    d = len(a)
    size = np.linalg.norm(a, 2)
    if size == 0:
        return np.eye(d)
    x = a / size
    # A lower bound of the smallest singular value; too small a bound costs a step or two.
    low = max(1.0 / (np.linalg.cond(x, 1) * np.sqrt(d)), _EPS / 4)
    for _ in range(40):
        square = low * low
        root = np.cbrt(4 * (1 - square) / square**2)
        wide = np.sqrt(1 + root)
        weight = wide + 0.5 * np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * wide))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(d)]))
        moved = (b / c) * x + (weight - b / c) / np.sqrt(c) * (q[:d] @ q[d:].T)
        moved = (moved + moved.T) / 2
        step = np.linalg.norm(moved - x)
        x = moved
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        if step < 4 * d * _EPS and 1 - low < 10 * _EPS:
            break
    return x


def _split_basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """An orthogonal matrix whose first ``rank`` columns span the projector's range."""
    # The columns of largest norm, one after another, as in QR with pivots.
    rest, chosen = projector.copy(), []
    for _ in range(rank):
        k = int(np.argmax((rest * rest).sum(0)))
        v = rest[:, k] / np.linalg.norm(rest[:, k])
        rest -= np.outer(v, v @ rest)
        chosen.append(k)
    q, _ = np.linalg.qr(projector @ projector[:, chosen], mode="complete")
    return q


def divide_and_conquer(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric matrix."""
    v = (v + v.T) / 2
    values, vectors = np.empty(len(v)), np.empty_like(v)
    whole = np.linalg.norm(v)
    # What is still to be split: a block, its basis, where its eigenvalues go.
    open_blocks = [(v, np.eye(len(v)), 0)] if len(v) else []
    while open_blocks:
        block, basis, at = open_blocks.pop()
        d = len(block)
        off = block - np.diag(np.diag(block))
        if d == 1 or np.linalg.norm(off) <= _EPS * whole / 4:
            order = np.argsort(-np.diag(block), kind="stable")
            values[at : at + d], vectors[:, at : at + d] = np.diag(block)[order], basis[:, order]
            continue
        # Splitting points: the middle of the diagonal first, then others, until both sides have a part.
        diagonal = np.sort(np.diag(block))
        spread = np.sqrt((off * off).sum(1)).max()
        tries = [np.median(diagonal), diagonal.mean(), *(diagonal[0] - spread + (diagonal[-1] - diagonal[0] + 2 * spread) * f for f in (0.5, 0.25, 0.75, 0.1, 0.9))]
        for s in tries:
            sign = polar_factor(block - s * np.eye(d))
            rank = int(round((np.trace(sign) + d) / 2))
            if not 0 < rank < d:
                continue
            q = _split_basis((sign + np.eye(d)) / 2, rank)
            turned = q.T @ block @ q
            if np.linalg.norm(turned[:rank, rank:]) <= 100 * d * _EPS * whole:
                break
        else:
            # A cluster no point can part: rotate two by two until it is diagonal to working precision.
            turned, q, rank = *_rotated(block), 0
            order = np.argsort(-np.diag(turned), kind="stable")
            values[at : at + d], vectors[:, at : at + d] = np.diag(turned)[order], (basis @ q)[:, order]
            continue
        turned = (turned + turned.T) / 2
        open_blocks.append((turned[:rank, :rank], basis @ q[:, :rank], at))
        open_blocks.append((turned[rank:, rank:], basis @ q[:, rank:], at + rank))
    # One step of refinement: diagonal to first order in the basis found.
    q, _ = np.linalg.qr(vectors)
    turned, more = _rotated(q.T @ v @ q)
    values, vectors = np.diag(turned), q @ more
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _rotated(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A matrix that is nearly diagonal (or small) made so by plane rotations, and their product."""
    a, q, d = block.copy(), np.eye(len(block)), len(block)
    whole = np.linalg.norm(a)
    for _ in range(30):
        large = np.argwhere(np.triu(np.abs(a), 1) > _EPS * np.sqrt(np.abs(np.outer(np.diag(a), np.diag(a)))) + 1e-300 + _EPS**2 * whole)
        if not len(large):
            break
        for i, j in large:
            if a[i, j] == 0:
                continue
            theta = (a[j, j] - a[i, i]) / (2 * a[i, j])
            t = 1.0 / (abs(theta) + np.hypot(1.0, theta)) * (1 if theta >= 0 else -1)
            c = 1 / np.hypot(1.0, t)
            s = t * c
            for m in (a, q):
                left, right = m[:, i].copy(), m[:, j].copy()
                m[:, i], m[:, j] = c * left - s * right, s * left + c * right
            left, right = a[i].copy(), a[j].copy()
            a[i], a[j] = c * left - s * right, s * left + c * right
            a[i, j] = a[j, i] = 0.0
    return a, q


# ---- passes over the rows -------------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of doubles from a column of lists of one length."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _whole(rows: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * np.clip(rows, -_LIMIT, _LIMIT)), SHIFT - _LIMIT, _LIMIT - SHIFT).astype(np.int64) + SHIFT


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that count."""
    rows = embeddings.select("vec_id", F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(
        F.col("vector").isNotNull()
        & ~F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        & (F.size("vector") > 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).select("length").first()
    return rows.where(F.size("vector") == (most.length if most else 0))


def _added(rows: DataFrame, product) -> np.ndarray | None:
    """The sum over all rows of d x d matrices that ``product`` forms of a few thousand rows each."""

    def partial(batches):
        total = None
        for batch in _parts(batches):
            part = product(_matrix(batch.column("vector")))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["line", "sums"]
            )

    lines = rows.select("vector").mapInArrow(partial, "line int, sums array<double>")
    cells = lines.select("line", F.posexplode("sums").alias("place", "value")).groupBy("line", "place").agg(F.sum("value").alias("value"))
    found = cells.collect()  # d x d numbers
    if not found:
        return None
    out = np.zeros((1 + max(r.line for r in found), 1 + max(r.place for r in found)))
    for r in found:
        out[r.line, r.place] = r.value
    return out


def moments(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the exact sums of x per dimension."""

    def partial(batches):
        n, sums = 0, None
        for batch in _parts(batches):
            x = _whole(_matrix(batch.column("vector")))
            part = [int(s) for s in (x >> 26).sum(0)], [int(s) for s in (x & ((1 << 26) - 1)).sum(0)]
            whole = [(h << 26) + low for h, low in zip(*part)]
            sums = whole if sums is None else [a + b for a, b in zip(sums, whole)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"rows": [n], "sums": [[str(s) for s in sums]]})

    sums = rows.select("vector").mapInArrow(partial, "rows long, sums array<string>")
    place = sums.select("rows", F.posexplode("sums").alias("place", "text"))
    found = place.groupBy("place").agg(F.sum("rows").alias("n"), F.sum(F.col("text").cast("decimal(38,0)")).alias("s")).orderBy("place").collect()
    return (int(found[0].n), [int(r.s) for r in found]) if found else (0, [])


def whitener(rows: DataFrame, components: int = COMPONENTS) -> dict | None:
    """n, sums, eigenvalues, eigenvectors (rows) and shares of up to ``components`` components, or None."""
    n, sums = moments(rows)
    if not n:
        return None
    mean = np.array([s / n for s in sums])

    def centred(m):
        x = _whole(m) - mean
        return x.T @ x

    v = _added(rows, centred) / n
    values, vectors = divide_and_conquer(v)
    keep = min(components, int((values > len(values) * _EPS * max(values[0], 0)).sum())) if values[0] > 0 else 0
    if not keep:
        return None
    return {"n": n, "sums": sums, "mean": mean, "values": values[:keep], "vectors": vectors[:, :keep].T, "shares": values[:keep] / np.trace(v)}


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error."""
    spark = embeddings.sparkSession
    ready(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = staged(usable(embeddings, vector), "vectors")
    fit = whitener(rows, components)
    if fit is None:
        return spark.createDataFrame([], schema)
    n, sums, mean = fit["n"], fit["sums"], fit["mean"]
    turn = fit["vectors"].T / np.sqrt(fit["values"])
    shares, k = fit["shares"], len(fit["shares"])
    # The whitened vectors' own mean is zero but for rounding; it is taken off all the same.
    drift = _added(rows, lambda m: ((_whole(m) - mean) @ turn).sum(0, keepdims=True))[0] / n

    def products(m):
        w = (_whole(m) - mean) @ turn - drift
        return w.T @ w

    error = float(np.abs(_added(rows, products) / n - np.eye(k)).max())
    top = np.array([float(s) for s in sums])

    def deviation(x: np.ndarray) -> list[int | None]:
        most = (np.abs(n * x.astype(np.float64) - top) ** 2).sum(1)
        out = []
        if max(abs(s) for s in sums) < 1 << 61 and np.abs(x).max(initial=0) * n < 1 << 61 and most.max(initial=0) < 1 << 62:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
        for row in x.tolist():
            exact = sum((n * c - s) ** 2 for c, s in zip(row, sums))
            out.append(exact if exact < 1 << 63 else None)
        return out

    def project(batches):
        for batch in _parts(batches, 1024):
            x = _whole(_matrix(batch.column("vector")))
            white = (x - mean) @ turn
            repeat = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(batch.column("vec_id"), pa.array(repeat)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(repeat), n, np.int64)),
                    pc.take(pa.array(deviation(x), pa.int64()), pa.array(repeat)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(repeat), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").mapInArrow(project, schema)
