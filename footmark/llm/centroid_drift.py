"""Exact k-means over integer vectors, with geometrically tightened drift bounds.

Each vector keeps its cluster, an upper bound on the distance to its own centroid and a lower bound on
the distance to every other one. When centroids move, the usual lower bound loosens by the largest
drift of another centroid. Here it loosens by less: the vectors of a cluster lie in a sphere around its
old centroid, and in the plane through that centre, the old place p and the new place q of another
centroid, the distance of a point of the sphere shrinks per step along pq by the cosine of the angle
between the step and the direction to the point at most. Seen from a place on pq the sphere spans a
known angle, so the sum of these cosines over pieces of pq bounds the loosening for the whole sphere;
it is below the drift unless the move is straight at the sphere, and negative for a centroid that moves
away. Vectors whose upper bound stays below the lower bound keep their cluster; for the others the own
distance is computed, and what is still ambiguous is scanned against all centroids with integers.

Plan: a round is one map over the vectors with the centroids (k x d numbers) in the closure, written
with the new bounds, and one aggregation that gives a row a cluster and task before the shuffle and k
rows to the driver. The table of the round before is removed when the next one is written.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal
from functools import partial
from math import asin, atan2, cos, hypot, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.common import cut, prepare, quoted, remove
from footmark.llm.vectors import matrices

#: Factor of the components, components of a kept vector, clusters, rounds, salt of the first centroids.
SCALE, DIMS, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Components beyond it are refused: their squared distances are beyond a long.
LARGEST = 1 << 52
#: Pieces of a centroid's way in the bound; slack for rounding, as a part of a distance.
PIECES, SLACK = 16, 1e-9

STATE = "vec_id long, v binary, cluster int, upper double, lower double, scanned boolean, distance long"


def pack(v: np.ndarray) -> list[bytes]:
    """Rows of integers in the smallest type that holds the row (8 to 64 bits)."""
    top = np.maximum(v.max(axis=1), -1 - v.min(axis=1))
    out = [b""] * len(v)
    for kind, least, most in ((np.int8, -1, 127), (np.int16, 127, 32767), (np.int32, 32767, 2147483647), (np.int64, 2147483647, 1 << 63)):
        for i in np.flatnonzero((top > least) & (top <= most)):
            out[i] = v[i].astype(kind).tobytes()
    return out


def unpack(column: pa.Array, d: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), d), dtype=np.int64)
    width = np.array([len(b) // d for b in values])
    for kind in (np.int8, np.int16, np.int32, np.int64):
        rows = np.flatnonzero(width == np.dtype(kind).itemsize)
        out[rows] = np.frombuffer(b"".join(values[i] for i in rows), dtype=kind).reshape(-1, d)
    return out


def _kept_batches(batches, scale, dims):
    for batch in batches:
        for at, m in matrices(batch.column(1)):
            if m.shape[1] != dims:
                continue
            with np.errstate(over="ignore"):
                v = np.floor(scale * m)
            if (np.abs(v) > LARGEST).any():
                raise ValueError(f"components beyond {LARGEST} / {scale}: squared distances don't fit a long")
            yield pa.record_batch([batch.column(0).take(pa.array(at)), pa.array(pack(v.astype(np.int64)), pa.binary())], names=["vec_id", "v"])


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x centroids; Python integers where 64 bits could overflow."""
    top = int(np.abs(v).max(initial=0)) + int(np.abs(centroids).max(initial=0))
    if v.shape[1] * top * top < 1 << 51:      # whole numbers that doubles hold
        a, b = v.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    kind = np.int64 if v.shape[1] * top * top < 1 << 62 else object
    return np.stack([((v.astype(kind) - c.astype(kind)) ** 2).sum(axis=1) for c in centroids], axis=1)


def squared_own(v: np.ndarray, own: np.ndarray) -> np.ndarray:
    top = int(np.abs(v).max(initial=0)) + int(np.abs(own).max(initial=0))
    kind = np.int64 if v.shape[1] * top * top < 1 << 62 else object
    return ((v.astype(kind) - own.astype(kind)) ** 2).sum(axis=1)


def _roots(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(np.float64))


def loosening(c, r: float, p, q, pieces: int = PIECES) -> float:
    """The most that |x - p| - |x - q| can be for an x within ``r`` of ``c``, never below the truth
    and never above |p - q|."""
    c, p, q = (np.array([float(x) for x in y]) for y in (c, p, q))
    way = float(np.linalg.norm(q - p))
    if way == 0.0:
        return 0.0
    e = (q - p) / way
    along = float((c - p) @ e)                         # the centre in the plane: along the way and off it
    off = sqrt(max(0.0, float((c - p) @ (c - p)) - along * along))
    off *= 1 - SLACK
    out = 0.0
    for i in range(pieces):
        t0, t1 = way * i / pieces, way * (i + 1) / pieces
        near = hypot(off, max(t0 - along, along - t1, 0.0))
        if near <= r * (1 + SLACK):
            out += t1 - t0                             # the sphere reaches the way: any direction
        else:
            angle = atan2(off, along - t0) - asin(min(1.0, r * (1 + SLACK) / near))
            out += (t1 - t0) * cos(max(0.0, angle))
    return min(way, out + SLACK * way)


class Moves:
    """What a round's moves do to the bounds of each cluster."""

    def __init__(self, old: np.ndarray, new: np.ndarray, radius: dict[int, float], tight: bool = True):
        k = len(old)
        gap = np.array([[_distance(a, b) for b in new] for a in new])
        drift = np.array([_distance(a, b) for a, b in zip(old, new)])
        self.up = drift * (1 + SLACK)
        self.down = np.zeros(k)
        for i in radius:
            others = [j for j in range(k) if j != i]
            self.down[i] = max((loosening(old[i], radius[i], old[j], new[j]) if tight else drift[j] for j in others), default=0.0)
        np.fill_diagonal(gap, np.inf)
        self.half = gap.min(axis=1) / 2 if k > 1 else np.full(k, np.inf)


def _distance(a, b) -> float:
    return sqrt(sum((int(x) - int(y)) ** 2 for x, y in zip(a, b)))


def _safe(upper, lower):
    """True where the own centroid is surely the only nearest one, rounding allowed for."""
    return upper * (1 + SLACK) < lower * (1 - SLACK)


def _assign_batches(batches, centroids, moves, last):
    """A round's assignment. Without ``moves`` all vectors are scanned (the first round)."""
    k, d = centroids.shape
    for batch in batches:
        v = unpack(batch.column(1), d)
        n = len(v)
        if moves is None:
            cluster, upper, lower = np.zeros(n, dtype=np.int32), np.full(n, np.inf), np.zeros(n)
            doubt = np.arange(n)
        else:
            cluster = batch.column(2).to_numpy().astype(np.int32)
            upper = batch.column(3).to_numpy() + moves.up[cluster]
            lower = np.maximum(batch.column(4).to_numpy() - moves.down[cluster], 0.0)
            other = np.maximum(lower, moves.half[cluster])
            doubt = np.flatnonzero(~_safe(upper, other))
            upper[doubt] = _roots(squared_own(v[doubt], centroids[cluster[doubt]]))
            doubt = doubt[~_safe(upper[doubt], other[doubt])]
        if len(doubt):
            every = squared(v[doubt], centroids)
            best = every.argmin(axis=1).astype(np.int32)       # the first of equal ones
            cluster[doubt] = best
            upper[doubt] = _roots(every[np.arange(len(doubt)), best])
            every = _roots(every)
            every[np.arange(len(doubt)), best] = np.inf
            lower[doubt] = every.min(axis=1) if k > 1 else np.inf
        scanned = np.zeros(n, dtype=bool)
        scanned[doubt] = True
        exact = squared_own(v, centroids[cluster]).tolist() if last else [None] * n
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower),
                               pa.array(scanned), pa.array(exact, pa.int64())],
                              names=["vec_id", "v", "cluster", "upper", "lower", "scanned", "distance"])


def _sum_batches(batches, k, d):
    """A row for each cluster of the task: rows, largest upper bound, sums of the components."""
    count, radius, sums = np.zeros(k, dtype=np.int64), np.zeros(k), [[0] * d for _ in range(k)]
    for batch in batches:
        v, cluster, upper = unpack(batch.column(0), d), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        count += np.bincount(cluster, minlength=k)
        np.maximum.at(radius, cluster, upper)
        for c in np.unique(cluster):
            some = v[cluster == c]
            kind = np.int64 if len(some) * int(np.abs(some).max()) < 1 << 62 else object
            sums[c] = [a + int(b) for a, b in zip(sums[c], some.astype(kind).sum(axis=0))]
    some = np.flatnonzero(count)
    yield pa.record_batch([pa.array(some), pa.array(count[some]), pa.array(radius[some]),
                           *[pa.array([Decimal(sums[c][i]) for c in some], pa.decimal128(38, 0)) for i in range(d)]],
                          names=["cluster", "n", "radius", *[f"s{i}" for i in range(d)]])


def _totals(state: DataFrame, k: int, d: int) -> list:
    """One row a cluster: n, radius, s0, s1, ..."""
    kind = "cluster long, n long, radius double, " + ", ".join(f"s{i} decimal(38,0)" for i in range(d))
    return state.select("v", "cluster", "upper").mapInArrow(partial(_sum_batches, k=k, d=d), kind).groupBy("cluster") \
        .agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(d)]).collect()


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, scale: int = SCALE, dims: int = DIMS,
            k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, tight: bool = True):
    """(state after the last assignment, centroids): the state is a written table of vec_id, v,
    cluster, upper, lower, scanned (whether the vector was ambiguous in the last assignment), distance."""
    spark = vectors.sparkSession
    prepare(spark)
    src = vectors.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), F.col(quoted(vector_col)).cast("array<double>").alias("e"))
    kept = cut(src.mapInArrow(partial(_kept_batches, scale=scale, dims=dims), "vec_id long, v binary"), "kept")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    centroids = unpack(pa.array([bytes(r["v"]) for r in first], pa.binary()), dims)
    if not len(centroids):
        return kept.select("vec_id", "v").selectExpr("*", *[f"CAST(NULL AS {t}) AS {c}" for c, t in (x.split() for x in STATE.split(", ")[2:])]), \
            centroids
    moves, state = None, kept
    for turn in range(rounds + 1):
        new = cut(state.mapInArrow(partial(_assign_batches, centroids=centroids, moves=moves, last=turn == rounds), STATE), "state")
        remove(state)
        state = new
        if turn < rounds:
            old, radius, centroids = centroids, {}, centroids.copy()
            for r in _totals(state, len(old), dims):
                radius[r["cluster"]] = r["radius"] * (1 + SLACK)
                centroids[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]  # exact, floors go down
            moves = Moves(old, centroids, radius, tight)
    return state, centroids


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **how) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; a component x counts as
    floor(scale * x). Repeated rows and null ids are vectors of their own (the id only orders the first
    centroids; a null id hashes as empty, equal hashes go by the vector). With fewer vectors than
    clusters each is a centroid; centroids without vectors stay. Equal distances go to the smaller
    number. No kept vector, no rows. Components beyond 2^52 / scale, and squared distances beyond a long,
    are an error, since no long can be returned for them."""
    state, centroids = cluster(vectors, id_col, vector_col, **how)
    spark = vectors.sparkSession
    sums = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # one row a cluster
    by_cluster = {r["cluster"]: int(r["s"]) for r in sums if r["cluster"] is not None}
    whole = sum(by_cluster.values())
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    table = spark.createDataFrame([(c, s, whole, digest[c]) for c, s in by_cluster.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
