"""Approximate nearest neighbours by cosine in a hash-prefix forest.

Every vector has a long bit string in each tree: the signs of its products with random directions. A tree is the sorted
array of its strings, and the vectors whose strings share a prefix with a query's string are one range of it. A search goes
down to the longest prefix that any vector shares with the query in each tree, and then up all trees together, one bit at
a time, until their ranges hold enough different candidates. Candidates are compared by their exact cosines.

Rows are dealt to shards by a hash, and each shard has a forest of its own. Queries go to all shards in blocks, and the
best of each shard are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

TREES = 12
BITS = 32
#: Candidates that a search gathers in a shard, as a share of the shard's rows, and at least so many. The share is
#: large because the test vectors have hardly any structure: the nearest of 51,000 is at 64 degrees.
#: See the README for recall at other shares.
SHARE = 0.55
LEAST = 200
SHARD_ROWS = 8_192
#: Queries that meet a shard's forest in one task.
BLOCK = 8_192
SEED = 5


def directions(size: int, trees: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Random directions, the same for every shard and task."""
    return np.random.default_rng(seed).standard_normal((trees, bits, size))


def strings(unit: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """The bit string of every vector in every tree, as a number with the first bit highest."""
    trees, bits, _ = ways.shape
    weights = np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return np.stack([((unit @ ways[t].T) > 0).astype(np.uint64) @ weights for t in range(trees)])


class Forest:
    """Sorted arrays of the strings of one shard's vectors."""

    def __init__(self, unit: np.ndarray, ways: np.ndarray):
        self.ways, self.bits = ways, ways.shape[1]
        keys = strings(unit, ways)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=1)

    def ranges(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query the range of strings with the same first ``level`` bits."""
        free = np.uint64((1 << (self.bits - level)) - 1)
        low = np.stack([np.searchsorted(s, k & ~free, side="left") for s, k in zip(self.sorted, keys, strict=True)])
        high = np.stack([np.searchsorted(s, k | free, side="right") for s, k in zip(self.sorted, keys, strict=True)])
        return low, high

    def candidates(self, unit: np.ndarray, least: int) -> list[np.ndarray]:
        """Rows gathered for each query: at least ``least`` different ones, or all there are."""
        keys, n = strings(unit, self.ways), self.order.shape[1]
        least = min(least, n)
        found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(unit)
        left = np.arange(len(unit))
        for level in range(self.bits, -1, -1):
            low, high = self.ranges(keys[:, left], level)
            enough = np.flatnonzero((high - low).sum(axis=0) >= least)  # ranges of trees may overlap, so they may hold fewer
            done = []
            for i in enough.tolist():
                mark = np.zeros(n, dtype=bool)
                for t in range(len(self.order)):
                    mark[self.order[t, low[t, i] : high[t, i]]] = True
                rows = np.flatnonzero(mark)
                if len(rows) >= least:
                    found[left[i]] = rows
                    done.append(i)
            left = np.delete(left, done)
            if not len(left):
                break
        return found


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by smaller id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors scaled by powers of two so that no square is too large or small; their cosines keep every digit."""
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in column])
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 5, share: float = SHARE, least: int = LEAST, trees: int = TREES, bits: int = BITS,
    shard_rows: int = SHARD_ROWS, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows found with the largest cosines, without the query's id.

    Scores are cosines of the original vectors in double precision; ties go to the smaller vec_id. If there are no
    more than k other rows, all are returned. Vectors (rows or queries) that are null, empty, all zero, of another
    length than most, or that hold a null or a number that is not finite take no part, nor do null ids. Equal rows count
    once, and so do equal queries. Empty tables give an empty result.

    Equal vectors are one entry of a forest with their k + 1 smallest ids: a search needs no more of them, since their
    scores tie. A vector that a third of all rows have is thus one entry, gathered in two steps.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    vector = F.col(f"`{embedding}`").cast("array<double>")
    usable = (
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    clean = lambda df: df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), vector.alias("v")).where(usable)
    spark = rows.sparkSession
    sizes = clean(rows).groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    size = sizes[0]["size"]

    smallest = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    # ids of a vector, first in parts of one vector's rows and then together: k + 1 of each part are enough
    part = Window.partitionBy("v", "part").orderBy("id")
    dealt = clean(rows).where(F.size("v") == size).select("id", "v", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).distinct()
    few = dealt.withColumn("place", F.row_number().over(part)).where(F.col("place") <= k + 1)
    entries = written(few.groupBy("v").agg(smallest(F.collect_list("id")).alias("ids")), "vectors")
    asked = written(clean(queries).where(F.size("v") == size).distinct(), "queries")
    shards = max(1, -(-entries.count() // shard_rows))
    blocks = max(1, -(-asked.count() // BLOCK))

    # every entry meets every query in the task of its shard and the query's block
    shard = F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    left = entries.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "v", "ids")
    right = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), "id", "v")

    def searched(key: tuple, own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(wanted):
            vectors, points = matrix(own["v"]), matrix(wanted["v"])
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            unit = vectors / lengths[:, None]
            forest = Forest(unit, directions(size, trees, bits))
            point_lengths = np.sqrt((points * points).sum(axis=1))
            gathered = forest.candidates(points / point_lengths[:, None], max(least, int(np.ceil(share * len(own)))))
            first = own["ids"].map(min).to_numpy()
            for i, query in enumerate(wanted["id"].tolist()):
                rows = gathered[i]
                scores = (vectors[rows] @ points[i]) / (lengths[rows] * point_lengths[i])
                near = best(first[rows], scores, k + 1)  # one of them may be the query itself
                found = sorted((-scores[j], ident) for j in near for ident in own["ids"].iat[rows[j]] if ident != query)[:k]
                out += [(query, ident, -score) for score, ident in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(searched, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows of each shard
    unique = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return unique.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
