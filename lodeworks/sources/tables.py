"""Typed CSV and Parquet tables, and the folder of tables that a build writes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lodeworks.names import internal, published_name
from lodeworks.schemas import RAW


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line and declared types; a malformed field fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None
) -> DataFrame:
    """Create or replace a table's files and return the table read back from them.

    With ``partition_by``, rows are first brought together by those columns in pieces of even size: the
    rebalance splits a value that is large and joins values that are small, so a folder has neither one
    huge file nor thousands of tiny ones. With ``sort_by``, files follow that order over the whole table.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_by:
        out = out.orderBy(*sort_by)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, n_rows) of each table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("tbl"), "n_rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make every table reachable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_raw(spark: SparkSession, path: str, table: str, file_format: str = "parquet") -> DataFrame:
    """A raw table stored under its published column names, with the package's names and types.

    A value that its declared type cannot hold is an error, as is a column that is missing.
    """
    schema = RAW[table]
    if file_format == "csv":
        stored = StructType([StructField(published_name(table, f.name), f.dataType) for f in schema])
        return internal(read_csv(spark, path, stored), table, schema.names)
    # Parquet states its own types: published tables hold 64-bit integers and days as timestamps, which are cast here
    df = internal(read_parquet(spark, path), table, schema.names)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
