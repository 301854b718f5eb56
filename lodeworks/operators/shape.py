"""Pivots, histograms, shares and indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.labels import max_where
from lodeworks.functions.numeric import safe_divide


def pivot_max(df: DataFrame, keys: list, label: str, columns: dict[str, str], value: str) -> DataFrame:
    """Long to wide in one pass: column name -> the label whose largest value it holds.

    The labels are known, so this needs no extra job to find them, as ``pivot`` would.
    """
    wide = [max_where(F.col(value), F.col(label) == wanted).alias(name) for name, wanted in columns.items()]
    return df.groupBy(*keys).agg(*wide)


def value_counts(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Rows per category, 0 for a category without rows, and the share of the total in percent.

    Counts come as one row of conditional counts, so nothing is shuffled but that row.
    """
    counts = df.agg(*[F.count_if(F.col(column) == c).alias(str(i)) for i, c in enumerate(categories)])
    pairs = [F.struct(F.lit(c).alias(column), F.col(str(i)).alias("n")) for i, c in enumerate(categories)]
    total = sum((F.col(str(i)) for i in range(1, len(categories))), F.col("0"))
    return (
        counts.select(total.alias("total"), F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*", safe_divide(F.lit(100.0) * F.col("pair.n"), F.col("total")).alias("share_pct"))
    )


def histogram(df: DataFrame, measures: list[str], bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins between a measure's min and max; the last bin is closed.

    Gives every bin (0 when empty) of every measure, per value of ``by`` if set, over one common range. When
    all values are equal the range is widened by 0.5 to each side. One pass over df counts each different value
    of a measure; both the ends and the bins follow from these counts, which two readers of one shuffle share. Rounded
    measures have few different values; of others a value is at most a number and its count.
    """
    by = by or []
    # a NaN is no value, and -0.0 is 0.0, as for grouping and comparing
    each = [F.struct(F.lit(c).alias("measure"), F.when(~F.isnan(c), F.col(c).cast("double")).alias("x")) for c in measures]
    values = df.select(*by, F.inline(F.array(*each))).where(F.col("x").isNotNull())
    different = values.groupBy(*by, "measure", "x").agg(F.count("*").alias("n"))

    def widened(c: str) -> Column:
        # asking for n keeps this reader on the shuffle of the other one; without it the counts would be left out here
        own = F.when((F.col("measure") == c) & (F.col("n") > 0), F.col("x"))
        pad = F.when(F.min(own) == F.max(own), 0.5).otherwise(0.0)
        return F.struct(F.lit(c), F.struct((F.min(own) - pad).alias("lo"), (F.max(own) + pad).alias("hi")))

    ends = different.agg(F.map_from_entries(F.array(*[widened(c) for c in measures])).alias("ends")).scalar()
    placeable = different.withColumn("e", F.element_at(ends, F.col("measure"))).select(*by, "measure", "x", "n", "e.lo", "e.hi")
    lo, hi, x, i = F.col("lo"), F.col("hi"), F.col("x"), F.col("guess")

    def left_edge(k: Column) -> Column:
        return F.when(k >= bins, hi).otherwise(lo + k * ((hi - lo) / bins))

    # The quotient may be off by one bit at an edge; the edges decide.
    placed = F.when(x < left_edge(i), i - 1).when((x >= left_edge(i + 1)) & (i < bins - 1), i + 1).otherwise(i)
    groups = [*by, "measure", "lo", "hi"]
    counts = (
        placeable.withColumn("guess", F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)))
        .groupBy(*groups, placed.cast("int").alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    # At most bins rows per group from here on.
    found = counts.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    every_bin = found.select(*groups, "found", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every_bin.select(
        *by,
        "measure",
        "bin",
        left_edge(F.col("bin")).alias("bin_lo"),
        left_edge(F.col("bin") + 1).alias("bin_hi"),
        F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
    )


def base_index(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """100 * x / (x of the first row by ``order``), for each column."""
    base = df.agg(*[F.min_by(c, order).alias(c) for c in columns])
    firsts = base.select(F.struct(*columns)).scalar()
    return df.withColumn("_base", firsts).select(
        order, *[safe_divide(F.lit(100.0) * F.col(c), F.col(f"_base.{c}")).alias(c) for c in columns]
    )


def last_known(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Per column: its last non-null value and where that is (series, position, value)."""
    pairs = []
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col(order))
        pairs.append(F.struct(F.lit(c).alias("series"), F.max(at).alias("at"), F.max_by(c, at).alias("value")))
    return df.agg(F.array(*pairs).alias("p")).select(F.inline("p"))


def top_k(df: DataFrame, by: str, k: int, tiebreak: list[str]) -> DataFrame:
    """The k rows with the largest ``by``; ties go by ``tiebreak`` so that the result is fixed."""
    return df.orderBy(F.col(by).desc(), *tiebreak).limit(k)


def summary_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: n, min, max, mean and max - min."""
    stats = [
        F.struct(
            F.lit(c).alias("measure"),
            F.count(c).alias("n"),
            F.min(c).alias("min_v"),
            F.max(c).alias("max_v"),
            F.avg(c).alias("mean_v"),
            (F.max(c) - F.min(c)).alias("spread_v"),
        )
        for c in columns
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
