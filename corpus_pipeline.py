"""A corpus pipeline: quality, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. Stages that filter or change rows keep the columns of ``docs``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import mixing, near_duplicates, packing, rule_ensemble, secret_scan
from lodeworks.llm.shared import learnable, table, unused, written

#: SQL cannot express the fitted classifier.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule ensemble rejects (score under 0.3). Empty and null texts are scored like others."""
    model = rule_ensemble.fit_on_labels(docs, table(spark, sf_dir, "labels"), learnable(F.col("doc_id")))
    predicted = unused(docs.columns, "score", "predicted")[1]
    return rule_ensemble.judge(docs, model).where(F.col(predicted) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at 0.8 of five-word shingles: the one with the smallest id.

    A document is an id with a text: different texts under one id are different documents, and so are texts without an
    id, which are kept if no document of their group has one. Of rows that have both id and text in common one stays, the
    least by a hash of all columns. Documents without words are no duplicates of each other: all their rows stay.
    """
    row, key, other, component = unused(docs.columns, "row", "key", "other", "component")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # an id and a text as 128 bits, half of which the operator takes for an id
    named = docs.where(worded).withColumns({key: F.xxhash64("doc_id", F.col("doc_id").isNull(), "text"), other: F.xxhash64(F.lit(1), "text", "doc_id")})
    groups = near_duplicates.duplicates(named, doc_id=key).select(F.col("doc_id").alias(key), F.col("component_id").alias(component)).distinct()
    members = named.select("doc_id", key, other).distinct().join(groups, key)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col(key), F.col(other)))  # ids come first, the smallest of them
    kept = members.groupBy(component).agg(best.alias(row)).select(F.col(f"{row}.{key}"), F.col(f"{row}.{other}"))
    whole = named.groupBy(key, other).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(row))
    alone = whole.join(kept, [key, other], "left_semi").select(f"{row}.*")
    return alone.unionByName(docs.where(~worded))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind in brackets, and counts ``n_chars`` anew where the column is there."""
    spans = unused(docs.columns, "blob", "spans", "known", "body")[1]
    found, _ = secret_scan.scan(docs)
    clean = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicates documents so that all sources weigh alike, as many documents in the mean as there are."""
    return mixing.mix(docs, copy=None)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all copies into sequences of 1,024 tokens: one row per piece with its place."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicate),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written to the cluster's shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
