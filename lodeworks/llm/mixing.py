"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each source gets a mean repetition rate, target documents over documents present. A document's number of copies is a
Poisson variable with that mean, found by inverting the distribution at a uniform number that is a hash of the seed and
the document. So a document's copies depend on nothing but its id, its source's rate and the seed: tasks that run
again make the same rows, and no draw is shared between tasks. Copies are then shuffled globally by a hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import uniform, unused, written

#: A Poisson variable with a larger mean is the sum of independent ones with means of at most this.
PART = 16.0
#: Terms of one part's distribution. P(X >= 96) for mean 16 is below 1e-40, under the step of the uniform numbers.
TERMS = 96


def rates(docs: DataFrame, weights: dict | None = None, total: float | None = None, source: str = "source") -> DataFrame:
    """Rows (source, n, rate): documents present and mean copies of each for the target weights.

    ``weights`` maps sources to shares (any positive scale; a source that is not named gets none, ``None`` names
    the null source). Without it all sources count alike. ``total`` is the number of documents wanted, by default
    as many as there are. Hot sources are counted per task first.
    """
    counts = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.lit(1.0))
    else:
        name = {k: v for k, v in weights.items() if k is not None}
        listed = F.lit(0.0)
        if name:
            pairs = F.create_map(*[F.lit(x) for kv in name.items() for x in (kv[0], float(kv[1]))])
            listed = F.coalesce(F.element_at(pairs, F.col("source")), F.lit(0.0))
        counts = counts.withColumn("weight", F.when(F.col("source").isNull(), float(weights.get(None, 0.0))).otherwise(listed))
    all_n = counts.agg(F.sum("n")).scalar()
    all_weight = counts.agg(F.sum("weight")).scalar()
    wanted = F.lit(float(total)) if total is not None else all_n
    share = F.when(F.col("weight") > 0, F.col("weight") / all_weight).otherwise(F.lit(0.0))
    return counts.select("source", "n", (share * wanted / F.col("n")).alias("rate"))


def poisson(rate: Column, cdf: Column, parts: Column, *seeds: Column) -> Column:
    """A Poisson variable by inversion: for each part the entries of its distribution function up to a hashed uniform."""
    draws = F.transform(F.sequence(F.lit(1), parts), lambda j: uniform(*seeds, j))
    count = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter(cdf, lambda c: c <= u)))
    return F.when(rate > 0, count).otherwise(F.lit(0))


def with_distribution(of: DataFrame) -> DataFrame:
    """Sources' rates with ``parts`` and the ``cdf`` of one part: a few hundred bytes for each source."""
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    logs = F.split(F.lit(",".join(repr(math.lgamma(k + 1)) for k in range(TERMS + 1))), ",").cast("array<double>")
    terms = F.transform(
        F.sequence(F.lit(0), F.lit(TERMS)),
        lambda k: F.exp(k * F.log(F.col("mean")) - F.col("mean") - F.element_at(logs, k + 1)),
    )
    sums = F.aggregate(
        F.col("terms"),
        F.array().cast("array<double>"),
        lambda acc, p: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0.0)) + p)),
    )
    return (
        of.withColumn("parts", parts)
        .withColumn("mean", F.col("rate") / F.col("parts"))
        .withColumn("terms", F.when(F.col("rate") > 0, terms))
        .withColumn("cdf", sums)
        .select("source", "rate", "parts", "cdf")
    )


def mix(
    docs: DataFrame, weights: dict | None = None, total: float | None = None, seed: int = 7,
    doc_id: str = "doc_id", source: str = "source", copy: str | None = "copy",
) -> DataFrame:
    """``docs`` with each row repeated so that sources reach their target weights in the mean, in a global shuffle.

    Columns: those of ``docs``, and ``copy`` (from 0) if it is named (a clash gets another name). A null source is
    a source of its own. Documents with equal ids get equal numbers of copies; a null id counts as one id.
    Empty texts are documents like others; an empty table stays empty. A source of weight 0 goes.
    The hot source is not gathered anywhere: counts are combined per task, rates are one row per source, and
    copies are spread by a hash of id and copy number.
    """
    # written, so that its size is known when the join is planned: few sources are broadcast and texts are not shuffled by source
    known = written(with_distribution(rates(docs, weights, total, source)), "rates")
    key, n, cdf, parts, rate, order, number = unused(docs.columns, "key", "n", "cdf", "parts", "rate", "order", "number")
    known = known.select(F.col("source").alias(key), F.col("rate").alias(rate), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    ident = F.col(f"`{doc_id}`")
    counted = docs.join(known, F.col(f"`{source}`").eqNullSafe(F.col(key))).withColumn(
        n, poisson(F.col(rate), F.col(cdf), F.col(parts), F.lit(seed), ident)
    )
    kept = [F.col(f"`{c}`") for c in docs.columns]
    copies = counted.where(F.col(n) > 0).select(*kept, F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(number))
    shuffled = (
        copies.withColumn(order, F.xxhash64(F.lit(seed), ident, F.col(number)))
        .repartition(F.col(order))
        .sortWithinPartitions(order, number)
    )
    return shuffled.select(*kept, *([F.col(number).alias(unused(docs.columns, copy)[0])] if copy else []))
