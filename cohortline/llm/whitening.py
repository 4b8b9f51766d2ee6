"""Whitening of embeddings by a bidiagonal qd solver.

Two passes over the vectors reach the spectrum. The first sums them as whole
numbers. In the second every task reduces its centred rows, block by block, to a
triangular factor R by QR, and the factors are combined in a tree until one is
left: ``R'R`` is the scatter of all rows, and the scatter itself, whose rounding
would square the condition, is never formed. Householder reflections from both
sides make R bidiagonal; the dqds iteration finds its singular values to high
relative accuracy; a twisted factorisation of ``B'B - s^2`` gives each singular
vector, and the reflections carry it back to a whitening direction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import settle, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Triangular factors that are stacked at a time.
FAN_IN = 32
_EPS = np.finfo(float).eps
# Entries beyond this cannot be told apart from overflow.
_LARGEST = 1 << 62


# Singular values and vectors of a small triangular matrix


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of ``Q' r P``, and P as a product of reflections."""
    a, d = np.array(r, float), r.shape[1]
    right = np.eye(d)
    for k in range(d):
        v = _mirror(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k < d - 2:
            v = _mirror(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, 2 * v)
                right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, 2 * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _mirror(x: np.ndarray) -> np.ndarray | None:
    """Unit vector of the reflection that takes ``x`` to a multiple of the first axis."""
    size = np.abs(x).max(initial=0)
    if not size or not np.abs(x[1:]).max(initial=0):
        return None
    v = x / size
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One transform of the squares ``q, e`` by a shift; the last array holds the pivots less the shift."""
    n = len(q)
    out_q, out_e, pivots = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
    d = q[0] - shift
    for i in range(n - 1):
        pivots[i] = d
        out_q[i] = d + e[i]
        ratio = q[i + 1] / out_q[i] if out_q[i] else np.inf
        out_e[i] = e[i] * ratio if e[i] else 0.0
        d = d * ratio - shift if d or out_q[i] else q[i + 1] - shift
    pivots[-1] = out_q[-1] = d
    return out_q, out_e, pivots


def _smallest_bound(q: np.ndarray, e: np.ndarray) -> float:
    """A lower bound of the least eigenvalue of ``B'B`` by Gershgorin discs of its symmetric form."""
    off = np.sqrt(e * q[:-1])
    centre = q.copy()
    centre[1:] += e
    radius = np.zeros(len(q))
    radius[:-1] += off
    radius[1:] += off
    return float((centre - radius).min())


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of a bidiagonal matrix by falling size, by the dqds iteration.

    A shift that makes a pivot negative is too large: it is cut to what the
    pivots before showed to be safe, at last to zero, where dqd never fails.
    """
    n = len(diagonal)
    if not n:
        return np.empty(0)
    scale = max(np.abs(diagonal).max(), np.abs(above).max(initial=0))
    if not scale:
        return np.zeros(n)
    found: list[float] = []
    work = [((diagonal / scale) ** 2, (above / scale) ** 2, 0.0)]
    while work:
        q, e, moved = work.pop()
        shift, rounds = 0.0, 0
        while len(q):
            if len(q) == 1:
                found.append(max(q[0] + moved, 0.0))
                break
            # Off-diagonals that no longer count cut the matrix.
            small = np.flatnonzero(e <= _EPS**2 * np.minimum(q[:-1] + moved, q[1:] + moved))
            zero = np.flatnonzero(e <= (_EPS * _EPS) * max(q.max(), e.max()) * _EPS)
            cuts = np.unique(np.concatenate([small, zero]))
            if len(cuts):
                bounds = [0, *(cuts + 1).tolist(), len(q)]
                for a, b in zip(bounds, bounds[1:]):
                    work.append((q[a:b], e[a : b - 1], moved))
                break
            if rounds and q[0] < q[-1] and rounds % 8 == 0:
                # Graded the wrong way: turn it round, which keeps the singular values.
                flipped = _turned(q, e)
                if flipped is not None:
                    q, e = flipped
            while True:
                new_q, new_e, pivots = _dqds(q, e, shift)
                if np.isfinite(new_q).all() and np.isfinite(new_e).all() and (pivots.min() >= 0 or not shift):
                    break
                shift = shift / 4 if shift > _EPS * q.max() else 0.0
            q, e, moved, rounds = np.maximum(new_q, 0.0), np.maximum(new_e, 0.0), moved + shift, rounds + 1
            # The least pivot bounds the least eigenvalue from above, the discs from below.
            upper, lower = float(max(pivots.min(), 0.0)), max(_smallest_bound(q, e), 0.0)
            corner = q[-1] - e[-1] ** 0.5 * q[-1] ** 0.5
            shift = max(lower, min(0.98 * upper, max(corner, 0.0)) if rounds > 2 else 0.0)
            if rounds > 60 * n:
                raise ArithmeticError("the qd iteration did not converge")
    return np.sqrt(np.sort(np.array(found))[::-1]) * scale


def _turned(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The same matrix read from its other end: ``B'B`` reversed is ``L L'``, factored anew."""
    diagonal, off = q.copy(), e * q[:-1]
    diagonal[1:] += e
    diagonal, off = diagonal[::-1], off[::-1]
    new_q, new_e = np.empty(len(q)), np.empty(len(e))
    new_q[0] = diagonal[0]
    for i in range(len(e)):
        if new_q[i] <= 0:
            return None
        new_e[i] = off[i] / new_q[i]
        new_q[i + 1] = diagonal[i + 1] - new_e[i]
        if new_q[i + 1] <= _EPS * 16 * diagonal[i + 1]:
            return None  # cancellation would spoil small values
    return new_q, new_e


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float, avoid: np.ndarray) -> np.ndarray:
    """Singular vector for a squared singular value, by a twisted factorisation.

    ``avoid`` holds vectors already found for values that cannot be told apart.
    """
    n = len(diagonal)
    q, e = diagonal * diagonal, above * above
    tiny = _EPS * _EPS * max(q.max(), e.max(initial=0), np.finfo(float).tiny)
    # B'B has the entries a_i^2 + b_(i-1)^2 and a_i b_i; B'B - value from both ends.
    top, low = np.empty(n), np.empty(n)
    s = -value
    for i in range(n):
        top[i] = q[i] + s
        if abs(top[i]) < tiny:
            top[i] = -tiny
        if i < n - 1:
            s = s * (e[i] / top[i]) - value
    p = q[-1] - value
    for i in range(n - 1, 0, -1):
        low[i] = e[i - 1] + p
        if abs(low[i]) < tiny:
            low[i] = -tiny
        p = p * (q[i - 1] / low[i]) - value
    low[0] = p
    # The twist at k has the pivot gamma_k; the least one shows where the vector is large.
    shifted, rest = np.empty(n), np.empty(n)
    s = -value
    for i in range(n):
        shifted[i] = s
        if i < n - 1:
            s = s * (e[i] / top[i]) - value
    p = q[-1] - value
    for i in range(n - 1, -1, -1):
        rest[i] = p
        if i:
            p = p * (q[i - 1] / low[i]) - value
    gamma = shifted + rest + value
    couple = diagonal[:-1] * above
    for k in np.argsort(np.abs(gamma), kind="stable"):
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -couple[i] / top[i] * z[i + 1]
        for i in range(k + 1, n):
            z[i] = -couple[i - 1] / low[i] * z[i - 1]
        z /= np.abs(z).max()
        z /= np.sqrt(z @ z)
        for _ in range(2):
            z -= avoid.T @ (avoid @ z)
        left = np.sqrt(z @ z)
        if left > 1e-3:
            return z / left
    raise ArithmeticError("no direction is left for a repeated value")


def right_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of ``r`` by falling size, and its right singular vectors as rows."""
    diagonal, above, right = bidiagonal(r)
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if not scale:
        return np.zeros(n), np.eye(n)
    # Off-diagonals that do not count split the matrix: a vector then lives in one part.
    cut = np.flatnonzero(np.abs(above) <= _EPS * scale * _EPS)
    bounds = [0, *(cut + 1).tolist(), n]
    values, vectors = [], []
    for a, b in zip(bounds, bounds[1:]):
        own, found = diagonal[a:b] / scale, []
        off = above[a : b - 1] / scale
        sizes = singular_values(own, off)
        for i, size in enumerate(sizes):
            # Values this close have vectors that rounding mixes: keep them orthogonal.
            near = [found[j] for j in range(i) if sizes[j] - size <= max(1e-3 * sizes[j], n * _EPS * sizes[0])]
            avoid = np.array(near).reshape(-1, b - a)
            found.append(_twisted(own, off, size * size, avoid))
        whole = np.zeros((b - a, n))
        whole[:, a:b] = np.array(found).reshape(-1, b - a)
        values.append(sizes * scale)
        vectors.append(whole)
    size, vector = np.concatenate(values), np.concatenate(vectors)
    order = np.argsort(-size, kind="stable")
    return size[order], vector[order] @ right.T


# Passes over the vectors


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return np.asarray(lists.flatten()).reshape(len(lists), width)


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``x``, the whole numbers of each vector without null or non-finite entries."""
    c = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )
    whole = F.transform(c, lambda v: F.least(F.greatest(F.floor(v * SCALE) + SHIFT, F.lit(-_LARGEST)), F.lit(_LARGEST)))
    return rows.filter(fine).select(F.col(key), whole.cast("array<long>").alias("x"))


def sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension, as whole numbers."""
    columns = [F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    row = vectors.agg(F.count("*").alias("n"), *columns).first()
    return row["n"], [int(row[f"s{i}"]) for i in range(width)]


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``n * x - S`` as exact whole numbers, in Python's own where 64 bits may not do."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, total.tolist()), default=0) < 1 << 62:
        return n * x - total.astype(np.int64)
    return n * x.astype(object) - total


def triangular_factor(vectors: DataFrame, n: int, total: list[int], fan_in: int = FAN_IN) -> np.ndarray:
    """R of the QR factorisation of all centred rows ``x - S/n``.

    A task holds one factor and one batch. Factors are stacked ``fan_in`` at a
    time, in as many rounds as it takes; the last one has a row per dimension.
    """
    width = len(total)
    whole = np.array(total, object)

    def reduce_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.empty((0, width))
        for part in parts:
            for at in range(0, part.num_rows, 4096):
                block = (_centred(_matrix(part["x"][at : at + 4096], width), n, whole) / n).astype(float)
                r = np.linalg.qr(np.vstack([r, block]), mode="r")
        if len(r):
            yield _factor(r)

    def stack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.empty((0, width))
        for part in parts:
            for packed in part["r"]:
                r = np.linalg.qr(np.vstack([r, np.frombuffer(packed.as_buffer()).reshape(-1, width)]), mode="r")
        if len(r):
            yield _factor(r)

    factors = settle(vectors.select("x").mapInArrow(reduce_rows, "r binary"))
    while (left := factors.count()) > 1:
        factors = settle(factors.repartition(-(-left // fan_in)).mapInArrow(stack, "r binary"))
    first = factors.first()
    r = np.frombuffer(bytes(first["r"])).reshape(-1, width) if first else np.empty((0, width))
    return np.vstack([r, np.zeros((max(width - len(r), 0), width))])


def _factor(r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"r": pa.array([np.ascontiguousarray(r, float).tobytes()], pa.binary())})


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key, n, deviation, whitened, explained, identity_error`` of every valid row.

    Rows whose vector is null or holds a null, NaN or infinite entry are left out;
    so are those whose length is not the most frequent one (of equally frequent
    ones, the longer). ``whitened`` and ``explained`` are arrays over the leading
    components, at most ``components`` or the width; a component without spread
    has null in ``whitened``. ``deviation`` is ``sum (n * x - S)^2``, exact, as
    decimal(38,0) or null beyond it. ``identity_error`` is measured on the
    whitened rows themselves, over the components that have spread. Repeated
    rows and keys count as often as they occur; an empty table gives no rows.
    """
    spark = rows.sparkSession
    schema = (
        f"key {rows.schema[key].dataType.simpleString()}, n long, deviation string, whitened array<double>, "
        "explained array<double>"
    )
    found = settle(valid_vectors(rows.select(F.col(key).alias("key"), F.col(vector).alias("v")), "key", "v"))
    lengths = found.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = lengths["width"] if lengths else 0
    vectors = found.filter(F.size("x") == width)
    n, total = sums(vectors, width)
    r = triangular_factor(vectors, n, total) if n and width else np.empty((0, 0))
    values, directions = right_vectors(r)
    values, directions = values[:components], directions[:components]
    trace = float((r * r).sum())
    flat = values <= max(width, 1) * _EPS * values.max(initial=0)
    gain = np.where(flat, 0.0, np.sqrt(n) / np.where(flat, 1.0, values))
    share = (values * values / trace if trace else np.zeros(len(values))).tolist()
    whole, project = np.array(total, object), directions.T * gain

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            centred = _centred(_matrix(part["x"], width), n, whole)
            exact = (centred.astype(object) ** 2).sum(1) if _squares_overflow(centred) else (centred**2).sum(1)
            z = (centred / n).astype(float) @ project
            mask = np.broadcast_to(flat, z.shape)
            ends = pa.array(np.arange(len(z) + 1) * len(gain), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part["key"],
                    pa.array(np.full(len(z), n)),
                    pa.array([str(v) for v in exact]),
                    pa.ListArray.from_arrays(ends, pa.array(z.ravel(), mask=mask.ravel())),
                    pa.ListArray.from_arrays(ends, pa.array(np.tile(share, len(z)), pa.float64())),
                ],
                ["key", "n", "deviation", "whitened", "explained"],
            )

    done = settle(vectors.mapInArrow(apply, schema)) if n and width else spark.createDataFrame([], schema)
    spread = np.flatnonzero(~flat).tolist()
    pairs = [(i, j) for i in spread for j in spread if i <= j]
    # The aggregate centres both sides before it multiplies.
    off = [F.abs(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) - float(i == j)) for i, j in pairs]
    error = done.agg(F.greatest(*off, F.lit(0.0)).alias("e")).first()["e"] if off else 0.0
    return done.select(
        F.col("key").alias(key),
        "n",
        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        "whitened",
        "explained",
        F.lit(float(error)).alias("identity_error"),
    )


def _squares_overflow(centred: np.ndarray) -> bool:
    if centred.dtype == object:
        return True
    largest = int(np.abs(centred).max(initial=0))
    return largest * largest * max(centred.shape[1], 1) >= 1 << 62


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector and component; ``deviation`` is null where a long cannot hold it."""
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    both: Column = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", both).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error",
    )
