"""Exact distinct counts that can be added up, as bitmaps over a coded dimension.

A value's code is its number in the dimension. A partial table holds, for each group of the finest grain and each range of
codes that it meets, a bitmap of the codes seen. Counts of any coarser groups come from that table alone: bitmaps are
combined bit by bit, so a value that is in several fine groups counts once, and rows need not be shuffled by value again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.dimension import join_dimension
from lodeworks.operators.ranks import ranked


def coded(dim: DataFrame, column: str) -> DataFrame:
    """(column, code): each different value of a dimension with its number from 0, in order; null has none."""
    return ranked(dim.select(column).where(F.col(column).isNotNull()).distinct(), [column], "code")


def partials(df: DataFrame, keys: list[str], column: str, codes: DataFrame, spread_by: list[str]) -> DataFrame:
    """(keys, range, seen): one row per group and range of 32,768 codes. Values without a code count nowhere."""
    known = join_dimension(df.select(*dict.fromkeys([*keys, *spread_by, column])), codes, column, spread_by, "inner")
    code = F.col("code")
    return known.groupBy(*keys, F.bitmap_bucket_number(code).alias("range")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("seen"))


def counts(parts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): different values in each group of ``keys``, which are some of the partials' keys, or none."""
    joined = parts.groupBy(*keys, "range").agg(F.bitmap_or_agg("seen").alias("seen"))
    return joined.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("seen")), F.lit(0)).cast("bigint").alias(name))
