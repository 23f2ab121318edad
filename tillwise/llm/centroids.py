"""Operator 13, centroid clustering with geometrically tightened drift bounds.

Lloyd's rounds over vectors of whole numbers.  Each vector keeps its cluster and
a lower bound of its distance to every other centroid.  When centroids move,
the bound is loosened not by the full drift of a centroid but by what that drift
can matter inside the cluster: a member lies in the ball around its old centroid
c whose radius is that of the farthest member.  For a centroid that moved from p
to q, take the plane through p, q and c.  Points x with |x - p| - |x - q| = 2a lie
on a hyperbola with foci p and q, inside its asymptotes, so with h = |pq| / 2 and
the angle t of x seen from the middle of pq, off the direction of the move,
|x - p| - |x - q| <= 2 h cos t (and <= 0 beyond a right angle).  The least angle in
the ball is that of c less asin(radius / distance of c); a ball that holds the
middle loosens by the full drift.  A vector whose exact distance to its own
centroid stays below the loosened bound keeps its cluster; all others are
ambiguous and are scanned over all centroids, in exact whole numbers.

The state (vector, cluster, distance, bound) is written once a round, each round
reads it with no shuffle, and only counts, radii and component sums of the
clusters (k x dims numbers) reach the driver.

Defined cases: a vector of another length, null, or with a null, NaN or infinite
component is left out; fewer vectors than clusters give as many centroids as
there are vectors, none an empty result; repeated rows are counted and returned
each; null ids hash as the empty string; of equal hashes the lesser vector comes
first; ties go to the smaller cluster; other columns are not read.  A component
beyond `limit_of(dims)` would not fit in a long squared distance and is an error.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import written

CLUSTERS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = "1"

_STATE = "vec_id bigint, v binary, cluster int, distance bigint, lower double, scans int"
_RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, scans int"
#: Share by which bounds are weakened, far above the rounding of their own working out.
_SLACK = 1e-9


def limit_of(dims: int) -> int:
    """Greatest size of a component: the squared distance of two vectors stays below 2 ** 63."""
    return math.isqrt(((1 << 63) - 1) // (4 * max(dims, 1)))


# ---- exact distances ----------------------------------------------------------------------

def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (n x k) of whole-number vectors: by matrix product where doubles hold them, else in longs."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 53:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2.0 * (xf @ cf.T) + (cf * cf).sum(1)).astype(np.int64)
    return np.stack([((x - one) ** 2).sum(1) for one in c], axis=1)


def own_squares(x: np.ndarray, c: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    gap = x - c[cluster]
    return np.einsum("ij,ij->i", gap, gap)


def scanned(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), its squared distance and a lower bound of the distance to all others."""
    d = squares(x, c)
    cluster = d.argmin(1).astype(np.int32)
    best = d[np.arange(len(d)), cluster]
    if d.shape[1] == 1:
        return cluster, best, np.full(len(d), np.inf)
    return cluster, best, np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(np.float64)) * (1 - _SLACK)


# ---- bounds -------------------------------------------------------------------------------

def drift_in_ball(p: np.ndarray, q: np.ndarray, c: np.ndarray, radius: float) -> float:
    """An upper bound of |x - p| - |x - q| over the ball around c, never above the drift |p - q|."""
    move = q - p
    drift = float(np.sqrt(move @ move))
    if drift == 0:
        return 0.0
    seen = c - (p + q) / 2
    far = float(np.sqrt(seen @ seen))
    if far <= radius:
        return drift
    angle = math.acos(min(1.0, max(-1.0, float(seen @ move) / (far * drift)))) - math.asin(radius / far)
    # a little less than the angle, so that rounding cannot make the bound too small
    return drift * max(0.0, math.cos(max(0.0, angle - _SLACK)))


def loosening(old: np.ndarray, new: np.ndarray, radii: np.ndarray, tight: bool = True) -> np.ndarray:
    """By cluster, how much the distance to any other centroid can have shrunk for its members."""
    out = np.zeros(len(old))
    for a in range(len(old)):
        for j in range(len(old)):
            if j != a:
                by = drift_in_ball(old[j], new[j], old[a], radii[a]) if tight else float(np.linalg.norm(new[j] - old[j]))
                out[a] = max(out[a], by)
    return out * (1 + _SLACK)


# ---- rounds -------------------------------------------------------------------------------

def _packed(x: np.ndarray) -> pa.Array:
    """Vectors as the bytes of little-endian 32-bit numbers (64-bit where the limit does not fit)."""
    x = np.ascontiguousarray(x)
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1] * x.itemsize), len(x), [None, pa.py_buffer(x.tobytes())])
    return fixed.cast(pa.binary())


def _kind(dims: int) -> np.dtype:
    return np.dtype("<i4") if limit_of(dims) < 1 << 31 else np.dtype("<i8")


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _kind(dims)).reshape(-1, dims).astype(np.int64)


def whole(values: np.ndarray, scale: int, dims: int) -> np.ndarray:
    x = np.floor(scale * values)
    if len(x) and np.abs(x).max() > limit_of(dims):
        raise ValueError(f"a component beyond {limit_of(dims)} / {scale} does not fit in a long squared distance")
    return x.astype(np.int64)


def _first(rows: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> DataFrame:
    """State of the first assignment: every vector is scanned."""
    def run(batches):
        for batch in batches:
            ids, values = batch.column(0), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            x = whole(values, scale, dims)
            cluster, best, lower = scanned(x, centroids)
            yield pa.RecordBatch.from_arrays([ids, _packed(x.astype(_kind(dims))), pa.array(cluster), pa.array(best), pa.array(lower), pa.array(np.ones(len(x), np.int32))],
                                             ["vec_id", "v", "cluster", "distance", "lower", "scans"])
    return rows.mapInArrow(run, _STATE)


def _next(state: DataFrame, centroids: np.ndarray, loose: np.ndarray, dims: int) -> DataFrame:
    """State after the centroids moved: only vectors that the bounds leave open are scanned."""
    def run(batches):
        for batch in batches:
            x = _unpacked(batch.column(1), dims)
            cluster, lower, scans = (batch.column(k).to_numpy(zero_copy_only=False).copy() for k in (2, 4, 5))
            best, lower = own_squares(x, centroids, cluster), lower - loose[cluster]
            open_ = np.flatnonzero(np.sqrt(best.astype(np.float64)) * (1 + _SLACK) >= lower)
            if len(open_):
                cluster[open_], best[open_], lower[open_] = scanned(x[open_], centroids)
                scans[open_] += 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster), pa.array(best), pa.array(lower), pa.array(scans)],
                                             ["vec_id", "v", "cluster", "distance", "lower", "scans"])
    return state.mapInArrow(run, _STATE)


def _totals(state: DataFrame, dims: int, k: int) -> tuple[list[int], np.ndarray, list[list[int]]]:
    """Counts, radii and exact component sums of the clusters: summed in each task first, k x dims numbers in all."""
    def run(batches):
        sums, n, far = np.zeros((k, dims), object), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _unpacked(batch.column(0), dims)
            cluster, distance = (batch.column(j).to_numpy(zero_copy_only=False) for j in (1, 2))
            order = np.argsort(cluster, kind="stable")
            seen, at = np.unique(cluster[order], return_index=True)
            if len(seen):
                sums[seen] += np.add.reduceat(x[order], at, axis=0)
                n += np.bincount(cluster, minlength=k)
                far[seen] = np.maximum(far[seen], np.maximum.reduceat(distance[order], at))
        for c in np.flatnonzero(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dims, c, np.int32)), pa.array(np.arange(dims, dtype=np.int32)), pa.array([str(s) for s in sums[c]]),
                 pa.array(np.full(dims, n[c])), pa.array(np.full(dims, far[c]))], ["cluster", "at", "total", "n", "far"])
    parts = state.select("v", "cluster", "distance").mapInArrow(run, "cluster int, at int, total string, n bigint, far bigint")
    rows = parts.groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"), F.max("far").alias("far")).collect()
    n, radii, sums = [0] * k, np.zeros(k), [[0] * dims for _ in range(k)]
    for r in rows:
        n[r.cluster], radii[r.cluster], sums[r.cluster][r.at] = r.n, math.sqrt(r.far) * (1 + _SLACK), int(r.total)
    return n, radii, sums


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: str = SEED, tight: bool = True) -> DataFrame:
    """A row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, scans.

    `scans` counts the assignments (of rounds + 1) in which the vector was compared
    with all centroids; `tight=False` loosens by full drifts, with the same result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    fits = (F.size("x") == dims) & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.where(F.col("x").isNotNull() & F.coalesce(fits, F.lit(False)))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    starts = rows.select(order.alias("order"), "x").orderBy("order", "x").limit(k).collect()
    if not starts:
        return spark.createDataFrame([], _RESULT)
    k = len(starts)
    now = whole(np.array([r.x for r in starts], np.float64), scale, dims)
    state = written(_first(rows, now, dims, scale), "centroids-state")
    for _ in range(rounds):
        n, radii, sums = _totals(state, dims, k)
        new = np.array([[s // n[c] for s in sums[c]] if n[c] else now[c].tolist() for c in range(k)], np.int64)
        loose, now = loosening(now.astype(np.float64), new.astype(np.float64), radii, tight), new
        state = written(_next(state, now, loose, dims), "centroids-state")
    inertia = [0] * k
    for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect():
        inertia[r.cluster] = int(r.total)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    of = lambda values, kind: F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]
    return state.select("vec_id", "cluster", "distance", of(inertia, "bigint").alias("cluster_inertia"), F.lit(sum(inertia)).cast("bigint").alias("inertia"),
                        of(digests, "string").alias("centroid_sha256"), "scans")
