"""Embedding whitening: eigenpairs by FEAST contour integration.

The covariance is exact (sums of integers), the leading eigenvalues are fenced
into intervals by inertia counts, each interval is a Spark task that projects
onto its eigenspace by a quadrature of complex shifted solves and extracts the
components by Rayleigh-Ritz, and the count of every interval is verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage

COMPONENTS = 16
NODES = 8                  # quadrature nodes on the upper half circle
PER_INTERVAL = 6           # eigenvalues that an interval is cut to, about
ROUNDS = 30                # subspace iterations before the subspace is widened
RANK = 1e-13               # an eigenvalue below this share of the trace counts as zero
_HELD = 4e18               # 64 c beyond +-_HELD is held there, so that x fits in 64 bits
_LIMB = 16                 # bits of a limb: products of limbs sum exactly in float64 ...
_ROWS = 1 << 16            # ... over this many rows


# --- integers ------------------------------------------------------------------

def _entry(c):
    scaled = F.least(F.greatest(c.cast("double") * 64, F.lit(-_HELD)), F.lit(_HELD))
    return F.floor(scaled).cast("bigint") + F.lit(1000000)


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not null, not empty and holds finite numbers only,
    with their integer vector ``x`` in place of it, all of the commonest length
    (of equally common ones the least)."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = (vectors.where(F.coalesce(F.forall(column, finite), F.lit(False)) & (F.size(column) > 0))
            .select("vec_id", F.transform(column, _entry).alias("x")))
    dims = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("x") == F.lit(dims[0]["d"] if dims else 0))


def _columns(batch: pa.RecordBatch, at: int) -> np.ndarray:
    col = batch.column(at)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _sum_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the number of vectors and, for each dimension, exact sums of the
    high and low halves of the entries."""
    n, high, low = 0, 0, 0
    for b in batches:
        if b.num_rows:
            x = _columns(b, 0)
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    if n:
        d = len(high)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(high), pa.array(low),
                                          pa.array(np.full(d, n))], ["dim", "high", "low", "n"])


def _limbs(d: np.ndarray) -> list[np.ndarray]:
    """Integers as sums of limbs times powers of 2^_LIMB; one limb if they are small."""
    if not d.size or np.abs(d).max() < 1 << _LIMB:
        return [d.astype(np.float64)]
    mask = (1 << _LIMB) - 1
    return [*((d >> (_LIMB * k) & mask).astype(np.float64) for k in range(3)), (d >> (3 * _LIMB)).astype(np.float64)]


def _sum_products(whole: np.ndarray):
    """Per task the products of the entries less ``whole`` (the mean rounded
    down), summed exactly: rows (power, i, j, value), i <= j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for first in range(0, b.num_rows, _ROWS):
                limbs = _limbs(_columns(b.slice(first, _ROWS), 0) - whole)
                for p, u in enumerate(limbs):
                    for q, v in enumerate(limbs):
                        got = (u.T @ v).astype(np.int64)         # below 2^53: exact
                        total[p + q] = total[p + q] + got if p + q in total else got
        i, j = np.triu_indices(len(whole))
        for power, m in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), power, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(m[i, j])], ["power", "i", "j", "value"])
    return run


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """(n, S, V) of the vectors ``x`` of ``fit``.  Entries are centred by the
    mean rounded down before they are multiplied, and the sums are exact
    integers: the same in any order of rows and tasks.  The driver gets d and
    d (d + 1) / 2 numbers a limb, whatever the number of rows."""
    exact = "decimal(38,0)"
    sums = (map_arrow(fit.select("x"), _sum_entries, "dim int, high bigint, low bigint, n bigint")
            .groupBy("dim").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).cast(exact).alias(c) for c in ("high", "low", "n")])
            .orderBy("dim").collect())
    if not sums:
        return 0, [], np.zeros((0, 0))
    n = int(sums[0]["n"])
    total = [(int(r["high"]) << 32) + int(r["low"]) for r in sums]
    whole, rest = np.array([s // n for s in total], np.int64), [s % n for s in total]
    parts = (map_arrow(fit.select("x"), _sum_products(whole), "power int, i int, j int, value bigint")
             .groupBy("power", "i", "j").agg(F.sum(F.col("value").cast("decimal(20,0)")).cast(exact).alias("value")).collect())
    m: dict[tuple[int, int], int] = {}
    for r in parts:
        m[r["i"], r["j"]] = m.get((r["i"], r["j"]), 0) + (int(r["value"]) << (_LIMB * r["power"]))
    v = np.zeros((len(total), len(total)))
    for (i, j), value in m.items():
        # sum of (x_i - S_i/n)(x_j - S_j/n), over n: one rounding only
        v[i, j] = v[j, i] = (n * value - rest[i] * rest[j]) / (n * n)
    return n, total, v


# --- eigenvalues ------------------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix orthogonally similar to
    the symmetric ``a`` (Householder), so of the same inertia at every shift."""
    t = a.copy()
    for k in range(len(t) - 2):
        x = t[k + 1:, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        u = x / size
        t[k + 1:, :] -= 2 * np.outer(u, u @ t[k + 1:, :])
        t[:, k + 1:] -= 2 * np.outer(t[:, k + 1:] @ u, u)
    return np.diag(t).copy(), np.diag(t, -1).copy()


def above(t: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Inertia counts: how many eigenvalues lie above each shift, by the signs
    of the pivots of the shifted matrix."""
    diag, off = t
    tiny = np.finfo(float).tiny ** 0.5
    pivot = diag[0] - shifts
    count = (pivot > 0).astype(np.int64)
    for i in range(1, len(diag)):
        pivot = diag[i] - shifts - off[i - 1] ** 2 / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def fences(t: tuple[np.ndarray, np.ndarray], wanted: int, floor: float, per: int = PER_INTERVAL) -> list[tuple]:
    """Intervals (low, high, count) that hold the ``wanted`` largest eigenvalues
    above ``floor`` (more, where the last ones cannot be told apart), cut in the
    widest gaps.  Eigenvalues are fenced by bisection with inertia counts, which
    also show that none lies between two intervals."""
    radius = np.abs(np.concatenate([[0], t[1]])) + np.abs(np.concatenate([t[1], [0]]))
    top = float((t[0] + radius).max()) * (1 + 1e-12) + np.finfo(float).tiny
    have = int(above(t, np.array([floor]))[0])
    if not have or not top > floor:
        return []
    # Eigenvalue k (from 0, falling) lies between low[k] and high[k].
    more = min(have, wanted + per)
    low, high = np.full(more, floor), np.full(more, top)
    for _ in range(60):
        mid = (low + high) / 2
        over = above(t, mid) > np.arange(more)
        low, high = np.where(over, mid, low), np.where(over, high, mid)
    value = (low + high) / 2
    gap = np.append(value[:-1] - value[1:], value[-1] - floor if more == have else 0.0)    # below eigenvalue k
    least = 1e-10 * top                                            # closer ones stay together
    out, first = [], 0
    while first < min(wanted, more):
        stop = min(first + per, more)
        cuts = [k for k in range(first, stop) if gap[k] > least]
        while not cuts and stop < more:                            # a cluster wider than an interval
            cuts = [stop] if gap[stop] > least else []
            stop += 1
        cuts = [k for k in cuts if k >= wanted - 1] or cuts
        k = max(cuts, key=lambda c: gap[c], default=None)
        bottom = floor if k is None else value[k] - gap[k] / 2
        # Not much wider than what it holds: the filter tells near from far by the interval's size.
        room = gap[first - 1] / 2 if first else top - value[0]
        edge = value[first] + min(room, max(value[first] - bottom, least))
        known = above(t, np.array([bottom, edge]))
        if known[1] != first:
            raise ArithmeticError(f"{int(known[1])} eigenvalues above {edge}, {first} are fenced")
        out.append((float(bottom), float(edge), int(known[0]) - first))
        first = int(known[0])
    return out


def feast(a: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``a`` between low and high: Gauss-Legendre
    quadrature of (z - A)^-1 on the circle over the interval filters a block of
    vectors, Rayleigh-Ritz takes the pairs out of it, and both are repeated
    until the residuals are at rounding level.  Raises if the count is missed."""
    d = len(a)
    centre, radius = (low + high) / 2, (high - low) / 2
    point, weight = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - point)
    turn = np.exp(1j * angle)
    solve = [np.linalg.inv((centre + radius * z) * np.eye(d) - a) for z in turn]
    scale = np.abs(a).sum(0).max()
    rng = np.random.default_rng(5)
    size = min(d, count + max(4, count // 2))
    while True:
        y = rng.standard_normal((d, size))
        best = np.inf
        for _ in range(ROUNDS):
            q = sum((w / 2 * radius * z * (s @ y)).real for w, z, s in zip(weight, turn, solve))
            q, _ = np.linalg.qr(q)
            ritz, u = np.linalg.eigh(q.T @ a @ q)
            y = q @ u
            inside = (ritz > low) & (ritz <= high)
            rest = a @ y[:, inside] - y[:, inside] * ritz[inside]
            off = float(np.abs(rest).max(initial=0.0)) / scale
            done = inside.sum() == count and (off < 4e-16 or off < 1e-12 and off > best / 2 or size == d)
            if done or size == d:
                break                                              # at rounding level
            best = off if inside.sum() == count else np.inf
        if done:
            return ritz[inside], y[:, inside]
        if size == d:
            raise ArithmeticError(f"{int(inside.sum())} eigenvalues found between {low} and {high}, inertia says {count}")
        size = min(d, 2 * size)


def _solve(a: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, count in zip(*(b.column(c).to_pylist() for c in range(3))):
                value, vector = feast(a, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array([v.tobytes() for v in vector.T], pa.binary())],
                                                 ["value", "vector"])
    return run


def components(spark, v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the ``wanted`` largest
    eigenvalues of ``v`` that are not zero, falling; the largest entry of each
    vector is positive.  Every interval is a task of its own."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    a = v / trace
    t = tridiagonal(a)
    cuts = fences(t, wanted, RANK)
    if not cuts:
        return np.zeros(0), np.zeros((len(v), 0))
    rows = spark.createDataFrame(cuts, "low double, high double, count int").repartition(len(cuts), "low")
    got = map_arrow(rows, _solve(a), "value double, vector binary").collect()     # at most len(v) vectors
    if len(got) != sum(c for _, _, c in cuts):
        raise ArithmeticError("an interval gave fewer components than its inertia count")
    got.sort(key=lambda r: -r["value"])
    vector = np.array([np.frombuffer(r["vector"]) for r in got[:wanted]]).T
    vector = vector / np.linalg.norm(vector, axis=0)
    vector = vector * np.sign(vector[np.abs(vector).argmax(0), np.arange(vector.shape[1])])
    # The Rayleigh quotient, as accurate as the squared error of the vector.
    return np.einsum("ij,ij->j", vector, v @ vector), vector


# --- whitening -----------------------------------------------------------------------

def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole) - rest


def _sum_whitened(whole, rest, w):
    """Per task the products of whitened coordinates, whose mean is zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((w.shape[1], w.shape[1]))
        for b in batches:
            if b.num_rows:
                y = _centred(_columns(b, 0), whole, rest) @ w
                total += y.T @ y
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         ["i", "j", "value"])
    return run


def deviations(t: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """sum over dimensions of (n x - S)^2, exact, for x = whole + t and
    S = n whole + rest: 64-bit sums where they cannot overflow, else integers
    of any size."""
    big = int(np.abs(t).max(initial=0))
    if len(rest) * (n * (big + 1)) ** 2 < 1 << 63:
        return ((n * t - np.array(rest, np.int64)) ** 2).sum(1).tolist()
    if len(rest) * (big + 1) * max(big + 1, n) < 1 << 62:
        square, cross = (t * t).sum(1).tolist(), (t @ np.array(rest, np.int64)).tolist()
        own = sum(r * r for r in rest)
        return [n * n * s - 2 * n * c + own for s, c in zip(square, cross)]
    return [sum((n * e - r) ** 2 for e, r in zip(row, rest)) for row in t.tolist()]


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _whiten(n, whole, rest, w, explained, error):
    share = np.array([r / n for r in rest])
    k = w.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 4096):
                part = b.slice(first, 4096)
                x = _columns(part, 1)
                far = [v if v < 1 << 63 else None for v in deviations(x - whole, n, rest)]
                y = _centred(x, whole, share) @ w
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(x) * k, n)), pa.array(far, pa.int64()).take(at), pa.array(y.ravel()),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                    [c.split()[0] for c in _OUT.split(", ")])
    return run


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every row of ``vectors`` (vec_id, embedding): one
    row per vector and component (numbered from 1 by falling eigenvalue).

    Vectors that are null, empty or hold null or non-finite entries give no
    rows.  Entries c become x = floor(64 c) + 1000000; the covariance, its
    components and ``identity_error`` are those of the distinct x vectors, each
    once, so copies in any number weigh like one.  ``deviation`` is the exact
    sum of (n x - S)^2, null where it exceeds 64 bits (from some ten million
    distinct vectors of entries near 1 on).  There are as many components as
    eigenvalues above 1e-13 of the trace, ``wanted`` at most: none for one
    distinct vector, for equal ones or for an empty table, which give no rows.
    Vectors of another length than the commonest give no rows.  Repeated rows
    and null ids are kept as they are; of ties between eigenvalues any basis of
    their space is taken, the same for all rows.  64 c beyond 4e18 is held there.

    Copies are collapsed before the shuffle, on the mapping side; what reaches
    the driver are d sums, d^2/2 products and the components."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors)
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    n, total, v = covariance(fit)
    value, vector = components(spark, v, wanted) if n else (np.zeros(0), np.zeros((0, 0)))
    if not len(value):
        return spark.createDataFrame([], _OUT)
    w = vector / np.sqrt(value)
    whole, rest = np.array([s // n for s in total], np.int64), [s % n for s in total]
    share = np.array([r / n for r in rest])
    parts = (map_arrow(fit, _sum_whitened(whole, share, w), "i int, j int, value double")
             .groupBy("i", "j").agg(F.sum("value").alias("value")).collect())            # a number per pair of components
    error = max(abs(r["value"] / n - (r["i"] == r["j"])) for r in parts)
    return map_arrow(rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "x"),
                     _whiten(n, whole, rest, w, value / float(np.trace(v)), error), _OUT)
