"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed. A block of directions Q is improved by a polynomial in V: each degree is
one pass over the vectors that sums X'(XQ) with X centred, the polynomial is the Chebyshev one of the interval that holds
the unwanted eigenvalues, which it damps while it lifts the wanted ones. QR makes the block orthonormal again and a
Rayleigh-Ritz step turns it to the best eigenvectors it holds; rounds follow until the residuals certify the wanted ones.
The lower end of the unwanted interval comes from a few Lanczos steps, its upper end is the block's smallest Ritz value.

Vectors are taken as integers, x = floor(1024 c) + 100000 for an entry c. Sums of x are exact, and x - S/n is rounded once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import written

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Directions in the block beyond the wanted ones: more of them mean fewer passes.
GUARD = 24
#: Passes that bound the spectrum from below.
LANCZOS_STEPS = 8
#: Highest degree of a round's polynomial, and the most that it may lift one wanted direction above another.
DEGREE = 10
SPREAD = 1e10
#: A residual below this share of the largest eigenvalue certifies an eigenvector; where rounding keeps it higher, a
#: round that no longer helps ends the iteration if all residuals are below the second share.
CERTIFIED = 2e-14
ROUNDED = 1e-11
MAX_ROUNDS = 200
#: Integers of a packed block.
BLOCK = 1 << 18
#: Sums of x are carried in two parts so that neither overflows.
_LOW = 27
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _matrices(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, x as a matrix of longs) of an Arrow list column: usable rows only, in bounded pieces."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    length = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0))
    values = pc.list_flatten(vectors)
    c = np.asarray(pc.fill_null(values.cast(pa.float64()), np.nan))
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(c * SCALE)
        bad = ~(np.abs(scaled) < _EXACT)
    ends = np.cumsum(length)
    bad_before = np.concatenate(([0], np.cumsum(bad)))
    usable = (length > 0) & (bad_before[ends] == bad_before[ends - length])
    for d in np.unique(length[usable]).tolist():
        rows = np.flatnonzero(usable & (length == d))
        step = max(1, BLOCK // d)
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            x = scaled[(ends[part] - d)[:, None] + np.arange(d)].astype(np.int64) + SHIFT
            yield d, part, x


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(d, len(x), x.astype("<i8").tobytes(), (x >> _LOW).sum(axis=0), (x & ((1 << _LOW) - 1)).sum(axis=0)) for d, _, x in _matrices(batch.column(0))]
        if rows:
            yield pa.RecordBatch.from_pydict({k: v for k, v in zip(("d", "n", "x", "high", "low"), map(list, zip(*rows)))}, pa.schema(
                [("d", pa.int32()), ("n", pa.int64()), ("x", pa.binary()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))]))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double precision, each entry rounded once: n x - S is exact."""
    return _apart(x, n, sums).astype(np.float64) / n


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs where they hold it, whole numbers of any size elsewhere."""
    if int(np.abs(x).max(initial=0)) * n < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


@dataclass
class Fit:
    """What the iteration found: n vectors of dimension d, exact sums per dimension, directions as columns, their
    eigenvalues by falling size, the trace, the largest residual relative to the first eigenvalue, and the largest
    entry of the whitened covariance minus the identity, measured over all vectors."""
    n: int
    d: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float
    passes: int


class _Vectors:
    """The packed vectors and the passes over them."""

    def __init__(self, blocks: DataFrame, d: int, n: int, sums: list[int]) -> None:
        self.d, self.n, self.sums, self.passes = d, n, sums, 0
        self.rows = blocks.filter(F.col("d") == d).select("x").rdd

    def _total(self, of_block, width: tuple[int, ...]) -> np.ndarray:
        """Sum over all blocks: one array per task, added up in a tree."""
        d, n, sums = self.d, self.n, self.sums

        def task(rows):
            total = np.zeros(width)
            for row in rows:
                total += of_block(_centred(np.frombuffer(row[0], dtype="<i8").reshape(-1, d), n, sums))
            yield total
        self.passes += 1
        return self.rows.mapPartitions(task).treeReduce(np.add, depth=2)

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q."""
        return self._total(lambda x: x.T @ (x @ q), q.shape) / self.n

    def trace(self) -> float:
        return float(self._total(lambda x: np.array([np.einsum("ij,ij->", x, x)]), (1,))[0]) / self.n

    def identity_error(self, weights: np.ndarray) -> float:
        """Largest absolute entry of cov(X weights) - I."""
        k = weights.shape[1]

        def moments(x):
            w = x @ weights
            return np.vstack((w.T @ w, w.sum(axis=0)))
        m = self._total(moments, (k + 1, k)) / self.n
        return float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())


def _lower_bound(vectors: _Vectors, rng: np.random.Generator) -> float:
    """A value below V's eigenvalues, or 0: least Ritz value of a short Lanczos run, less the norm of what is left."""
    q = rng.standard_normal(vectors.d)
    q /= np.linalg.norm(q)
    basis, diagonal, off = [q], [], []
    for _ in range(min(LANCZOS_STEPS, vectors.d)):
        w = vectors.times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        known = np.array(basis).T
        for _ in range(2):  # twice is enough for an orthogonal basis
            w = w - known @ (known.T @ w)
        off.append(float(np.linalg.norm(w)))
        if off[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(w / off[-1])
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off[:-1], 1) + np.diag(off[:-1], -1))
    return max(0.0, float(ritz[0]) - off[-1])


def _degree(top: float, last: float) -> int:
    """Highest degree whose polynomial lifts `top` over `last` by SPREAD at most (both mapped to 1 and beyond)."""
    return max(2, min(DEGREE, int(np.log(SPREAD) / max(1e-9, np.arccosh(top) - np.arccosh(max(1.0, last))))))


def _filtered(vectors: _Vectors, u: np.ndarray, vu: np.ndarray, theta: np.ndarray, wanted: int, low: float) -> np.ndarray:
    """p(V) u, p the Chebyshev polynomial of [low, least Ritz value] by its scaled recurrence; V u is known already."""
    high = float(theta[-1])
    low = min(low, 0.9 * high)
    half, centre = (high - low) / 2, (high + low) / 2
    sigma = first = half / (float(theta[0]) - centre)
    before, now = u, (vu - centre * u) * (sigma / half)
    for _ in range(_degree((float(theta[0]) - centre) / half, (float(theta[wanted - 1]) - centre) / half) - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (vectors.times(now) - centre * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, seed: int = 42) -> Fit | None:
    """Eigenvectors of the covariance of all usable vectors, up to `components`; None where no vector is usable.

    Usable: not null, not empty, no null or non-finite entry (an entry too large for an exact 1024 c counts as one), and
    of the table's usual dimension, which is the most frequent one, the larger on a tie. Repeated rows count each time.
    Directions without variance (eigenvalue below 1e-12 of the trace) are left out: they cannot be whitened.
    Vectors are packed once, as integers, into a table in the shared folder; each pass reads it. The driver holds blocks
    of d x (components + GUARD) numbers, whatever the number of vectors. A block that spans the space needs no filter.
    """
    blocks = written(df.select(vector).mapInArrow(_pack, "d int, n long, x binary, high array<long>, low array<long>"), "whitening")
    sizes = blocks.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if sizes is None:
        return None
    d, n = sizes["d"], sizes["n"]
    sums = [0] * d
    for row in (blocks.filter(F.col("d") == d).select(F.posexplode(F.arrays_zip("high", "low"))).groupBy("pos")
                .agg(F.sum("col.high").alias("high"), F.sum("col.low").alias("low")).collect()):
        sums[row["pos"]] = (row["high"] << _LOW) + row["low"]
    vectors, rng = _Vectors(blocks, d, n, sums), np.random.default_rng(seed)
    trace = vectors.trace()
    if not trace > 0:
        return Fit(n, d, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, 0.0, vectors.passes)
    size = min(d, components + GUARD)
    low = _lower_bound(vectors, rng) if size < d else 0.0
    q = np.linalg.qr(rng.standard_normal((d, size)))[0]
    best, stuck = np.inf, 0
    for _ in range(MAX_ROUNDS):
        vq = vectors.times(q)
        h = q.T @ vq
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        u, vu = q @ turn, vq @ turn
        wanted = max(1, int((theta[:components] > 1e-12 * trace).sum()))
        residual = float(np.linalg.norm(vu[:, :wanted] - u[:, :wanted] * theta[:wanted], axis=0).max() / theta[0])
        stuck = stuck + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if size == d or residual <= CERTIFIED or (residual <= ROUNDED and stuck >= 2) or theta[-1] <= 1e-12 * trace:
            break
        q = np.linalg.qr(_filtered(vectors, u, vu, theta, wanted, low))[0]
    else:
        raise RuntimeError(f"whitening: residual {residual:.1e} after {MAX_ROUNDS} rounds")
    directions, values = u[:, :wanted], theta[:wanted]
    directions = directions / np.linalg.norm(directions, axis=0)
    return Fit(n, d, sums, directions, values, trace, residual, vectors.identity_error(directions / np.sqrt(values)), vectors.passes)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: key, component (from 1), n, deviation, whitened, explained,
    identity_error, residual.

    deviation is the sum over dimensions of (n x - S)^2, exact; null where a long cannot hold it. whitened is x - S/n
    projected on the component over the square root of its eigenvalue, explained the eigenvalue's share of the trace.
    Rows that fit() cannot use are not returned; a null key is kept as null; repeated rows are returned each time; no
    usable vectors, or vectors that are all equal, give no rows. Other columns of df are ignored.
    """
    kind = df.schema[key].dataType
    spark = df.sparkSession
    found = fit(df, vector, components)
    schema = f"`{key}` {kind.simpleString()}, deviation long, whitened array<double>"
    if found is None or not len(found.values):
        rows = spark.createDataFrame([], schema)
        found = found or Fit(0, 0, [], np.zeros((0, 0)), np.zeros(0), 1.0, 0.0, 0.0, 0)
    else:
        n, d, sums, weights = found.n, found.d, found.sums, found.directions / np.sqrt(found.values)

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, at, x in _matrices(batch.column(1)):
                    if dim != d:
                        continue
                    apart = _apart(x, n, sums)
                    near = (apart.astype(np.float64) ** 2).sum(axis=1)
                    if near.max() < 0.9 * _LONG and apart.dtype != object:
                        deviation = pa.array((apart * apart).sum(axis=1), pa.int64())
                    else:
                        whole = (apart.astype(object) ** 2).sum(axis=1)
                        deviation = pa.array([int(v) if v <= _LONG else None for v in whole], pa.int64())
                    w = (apart.astype(np.float64) / n) @ weights
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), deviation, lists], [key, "deviation", "whitened"])
        rows = df.select(key, vector).mapInArrow(apply, schema)
    explained = F.array(*[F.lit(float(v / found.trace)) for v in found.values]) if len(found.values) else F.array().cast("array<double>")
    spread = rows.select(key, "deviation", F.posexplode("whitened").alias("_at", "_whitened"))
    return spread.select(key, (F.col("_at") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation",
                         F.col("_whitened").alias("whitened"), F.element_at(explained, F.col("_at") + 1).alias("explained"),
                         F.lit(float(found.identity_error)).alias("identity_error"), F.lit(float(found.residual)).alias("residual"))
