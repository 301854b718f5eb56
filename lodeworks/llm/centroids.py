"""Clustering of integer vectors around centroids, with Shallot search for the nearest one.

Every vector remembers its nearest centroid, its second-nearest one, a bound above the distance to the first and one below
the distance to all others. When centroids have moved, the bounds are widened by how far. A vector whose upper bound is
below its lower one, or below half the distance from its centroid to the next, keeps its centroid unseen. Any other one
looks at the two centroids that it remembers and starts from the closer of them: with u the distance to the start and w the
distance to the second-nearest so far, a centroid further than u + w from the start is no nearer than that second. So
the start's neighbours, sorted by distance, are walked until they leave that ball, which shrinks with every nearer second
found. Bounds are floating-point numbers with a margin, and only leave centroids out; whatever they let through is
compared by squared distances in integers, ties going to the smaller number. The result is that of a full search.

Vectors are never gathered: a round is one pass over the table of vectors with their bounds, which it writes anew, and one
sum by centroid, of which the driver gets one row per centroid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

CENTROIDS = 40
ROUNDS = 5
SIZE = 64
SCALE = 256
SEED = 2
#: Bounds are widened by this share, far above what rounding changes in a few operations.
MARGIN = 1e-12
#: Parts that the sum of one centroid's vectors is taken in first, so that a part's sum fits a long.
PARTS = 64
LONG = (1 << 63) - 1

STATE = "vec_id long, x array<int>, cluster int, second int, upper double, lower double"


def largest(size: int) -> int:
    """Size of the largest component whose squared distances over ``size`` components fit a long."""
    return 1 << max(0, min(30, (62 - (size - 1).bit_length()) // 2 - 1))


def integers(embedding: Column, size: int = SIZE, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null unless there are ``size`` finite ones."""
    vector, top = embedding.cast("array<double>"), float(largest(size))
    usable = (F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bounded = lambda x: F.greatest(F.least(x * scale, F.lit(top)), F.lit(-top))
    return F.when(usable, F.transform(vector, lambda x: F.floor(bounded(x)).cast("int")))


class Shallot:
    """The centroids of one round: their distances, each one's neighbours in order, and how far each has moved."""

    def __init__(self, centroids: np.ndarray, earlier: np.ndarray | None = None):
        self.centroids, k = centroids, len(centroids)
        apart = np.sqrt(np.stack([squared(centroids, c) for c in centroids]).astype(np.float64)) * (1 - MARGIN)
        np.fill_diagonal(apart, -1)  # itself first, also before equal ones
        self.order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.half = self.apart[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if earlier is None else np.sqrt(squared(centroids, earlier).astype(np.float64)) * (1 + MARGIN)
        self.moved = moved
        top = np.sort(np.append(moved, 0))[-2:]
        self.others = np.where(moved == top[1], top[0], top[1]) if (moved == top[1]).sum() == 1 else np.full(k, top[1])

    def search(self, x: np.ndarray, nearest: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        """Brings the four states of vectors ``x`` up to these centroids, in place."""
        upper[:] = (upper + self.moved[nearest]) * (1 + MARGIN)
        lower[:] = (lower - self.others[nearest]) * (1 - MARGIN)
        if len(self.centroids) == 1:
            return
        open_ = np.flatnonzero(upper >= np.maximum(lower, self.half[nearest]))
        if not len(open_):
            return
        # the closer of the two remembered ones is the start, and its distance is known now
        a, b, points = nearest[open_], second[open_], x[open_]
        da, db = squared(points, self.centroids[a]), squared(points, self.centroids[b])
        swap = (db < da) | ((db == da) & (b < a))
        a, b, da, db = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, db, da), np.where(swap, da, db)
        reach = np.sqrt(da.astype(np.float64)) * (1 + MARGIN)
        alone = np.maximum(np.where(swap, -np.inf, lower[open_]), 2 * self.half[a] * (1 - MARGIN) - reach)
        best, best_d, next_, next_d = a.copy(), da.copy(), b.copy(), db.copy()
        live = np.flatnonzero(reach >= alone)
        searched = np.zeros(len(a), dtype=bool)
        searched[live] = True
        for step in range(self.order.shape[1]):
            ball = (reach[live] + np.sqrt(next_d[live].astype(np.float64))) * (1 + MARGIN)
            live = live[self.apart[a[live], step] <= ball]
            if not len(live):
                break
            j = self.order[a[live], step]
            fresh = j != b[live]  # the second's distance is known already
            at, j = live[fresh], j[fresh]
            d = squared(points[at], self.centroids[j])
            first = (d < best_d[at]) | ((d == best_d[at]) & (j < best[at]))
            third = ~first & (d < next_d[at])
            won, placed = at[first], at[third]
            next_[won], next_d[won] = best[won], best_d[won]
            best[won], best_d[won] = j[first], d[first]
            next_[placed], next_d[placed] = j[third], d[third]
        nearest[open_], second[open_] = best, next_
        upper[open_] = np.sqrt(best_d.astype(np.float64)) * (1 + MARGIN)
        lower[open_] = np.where(searched, np.sqrt(next_d.astype(np.float64)) * (1 - MARGIN), alone)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows, in integers."""
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _searched(shallot: Shallot):
    """Arrow function: vectors with their states, brought up to the centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                states = [np.array(c) for c in batch.columns[2:]]
                shallot.search(x, *states)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(s) for s in states]], names=batch.schema.names)

    return run


def _distances(centroids: np.ndarray):
    """Arrow function: (x, cluster) to the squared distance."""

    @F.arrow_udf("long")
    def run(x: pa.Array, cluster: pa.Array) -> pa.Array:
        return pa.array(squared(matrix(x), centroids[np.asarray(cluster)]) if len(x) else [], pa.int64())

    return run


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in that order; those without an id come last."""
    chance = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(chance.asc_nulls_last(), "x").select("x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's vectors' sum over their number, rounded down; a centroid without any stays."""
    size, part = centroids.shape[1], F.pmod(F.xxhash64("vec_id"), F.lit(PARTS))
    parts = state.groupBy("cluster", part.alias("part")).agg(
        F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(size)]
    )
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{i}").cast("decimal(38, 0)")).alias(f"s{i}") for i in range(size)])
    out = centroids.copy()
    for row in sums.collect():  # one row per centroid
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(size)]
    return out


def cluster(
    rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector after ``rounds`` rounds, and the final centroids.

    Usable are vectors of exactly ``size`` components, all finite numbers; the others have no row. Components are
    floor(scale * x), bounded by ``largest(size)`` to either side so that squared distances fit a long (2^27 for 64).
    Rows are clustered each for itself: equal rows, rows of one id and rows without an id all count and all come back.
    With fewer than k usable vectors each is a first centroid. An empty table gives no rows and no centroids.
    Columns other than the two named are not looked at.
    """
    names = F.col(f"`{vec_id}`").cast("long").alias("vec_id"), integers(F.col(f"`{embedding}`"), size, scale).alias("x")
    vectors = rows.select(*names).where(F.col("x").isNotNull())
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), np.zeros((0, size), np.int64)
    unseen = [F.lit(0).alias("cluster"), F.lit(min(1, len(centroids) - 1)).alias("second"), F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower")]
    state, earlier = vectors.select("vec_id", "x", *unseen), None
    for _ in range(rounds):
        state = written(state.mapInArrow(_searched(Shallot(centroids, earlier)), STATE), "centroid-round")
        earlier, centroids = centroids, means(state, centroids)
    state = written(state.mapInArrow(_searched(Shallot(centroids, earlier)), STATE), "centroid-round")
    return state.select("vec_id", "cluster", _distances(centroids)("x", "cluster").alias("distance")), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia and inertia, the distances summed over a vector's cluster and over all
    (2^63 - 1 if the sum is larger), and centroid_sha256, of the final centroid's components joined by commas.
    """
    total = lambda c: F.least(F.sum(c.cast("decimal(38, 0)")), F.lit(LONG).cast("decimal(38, 0)")).cast("long")
    each = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("sum"), total(F.col("distance")).alias("cluster_inertia"))
    texts = F.array(*[F.lit(",".join(map(str, c))) for c in centroids.tolist()])
    told = each.select(
        "cluster", "cluster_inertia", each.agg(total(F.col("sum"))).scalar().alias("inertia"),
        F.sha2(F.get(texts, F.col("cluster")), 256).alias("centroid_sha256"),
    )
    return assigned.join(F.broadcast(told), "cluster")  # one row per centroid
