"""Joins of a large table to a table with one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: No task is to take more than one part in so many of the large side for a single key.
PARTS = 1_000
#: Counters of the sketch that finds such keys: its counts are too small by less than a share of 1 / 7,500 of all rows.
TRACKED = 10_000
SALT = "_salt"


def heavy_keys(df: DataFrame, key: str, parts: int = PARTS) -> Column:
    """map<key, n>: for each key with more than one row in ``parts``, into how many parts to deal its rows.

    A scalar subquery over a frequent-items sketch: each task keeps a fixed number of counters, which are merged, so
    neither rows nor keys are shuffled. There are at most ``parts`` such keys, with twice as many parts together.
    """
    counted = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {min(parts, PARTS)}, {TRACKED})").alias("top"), F.count("*").alias("n")
    )
    share = lambda t: t["count"] * F.lit(parts) / F.col("n")
    heavy = F.filter("top", lambda t: share(t) > 1)
    return counted.select(F.map_from_entries(F.transform(heavy, lambda t: F.struct(t["item"], F.ceil(share(t)).cast("int"))))).scalar()


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, spread_by: list[str], how: str = "left", parts: int = PARTS) -> DataFrame:
    """Join fact to dim (unique on key) without gathering a hot key in one task.

    Heavy keys, and they alone, are dealt into parts by a hash of ``spread_by``; their rows of dim are copied once for
    each part, all others are there once. The hash is a function of the row, so a retried task gives the same part.
    Fact rows without a key are dealt too, since they meet nothing. There is one plan for all sizes, and whether dim is
    broadcast is left to Spark, which checks its size.
    """
    heavy = heavy_keys(fact, key, parts)
    n = F.coalesce(F.try_element_at(heavy, F.col(key)), F.lit(1))
    copies = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), n - 1)))
    dealt = F.pmod(F.hash(*spread_by), F.when(F.col(key).isNull(), F.lit(parts)).otherwise(n))
    return fact.withColumn(SALT, dealt).join(copies, [key, SALT], how).drop(SALT)


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Key values of child that parent lacks, with the number of child rows; null keys pass.

    The child is reduced to its distinct keys first, so a hot key is one row when it is shuffled.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")
