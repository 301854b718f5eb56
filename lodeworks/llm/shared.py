"""What the operators share: written intermediate tables, safe column names, seeded uniforms, the fold of a document."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.session import scratch_folder

#: Words are runs of anything but blank, tab, newline, vertical tab, form feed and carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder: later reads do not depend on executors that made it."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(columns: list[str], *wanted: str) -> list[str]:
    """``wanted`` names, all with the same number behind where the caller's table has one of them in any case."""
    taken = {c.lower() for c in columns}
    tails = ("", *(f"_{k}" for k in range(2, len(columns) + 3)))
    tail = next(t for t in tails if not any((w + t).lower() in taken for w in wanted))
    return [w + tail for w in wanted]


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model learns from; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """True for documents that models may learn from; a document without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def words_of(text: Column) -> Column:
    """The words of a text in order; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends only on the values: the first 52 bits of an MD5, centred in their cell."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` and its lambdas name it.

    A column that a projection makes is copied into a filter above it wherever the filter names it, also inside lambdas,
    which then compute it for every element. A lambda's variable is not copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
