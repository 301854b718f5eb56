"""Tables that are replaced as a whole, and laid out for filters on several columns.

A table is a folder with one sub-folder of files for each version, and a small table of versions. A version's files are
written first, and the row that names it last, in one file that appears as a whole when its job is committed. So readers
see the old rows until all new ones are there, and a build that is lost leaves the old version as it was. Files of earlier
versions stay until someone deletes the folders that ``superseded`` lists.

With ``cluster_by`` the rows are dealt into zones, folders of rows that are near each other in all those columns: each column
is cut into ranges of about equally many rows, and the bits of the ranges' numbers are interleaved. What each zone
holds at least and at most is kept in a table of zones, by which ``filtered`` leaves out all folders that hold no row it wants.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, StructType, TimestampNTZType, TimestampType

MANIFEST = "number long, folder string, columns string, zoned boolean"
ZONE = "_zone"
#: Ranges of each clustered column; a power of two.
RANGES = 4


def publish(
    df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
    cluster_by: list[str] | None = None, ranges: int = RANGES, cuts_of: DataFrame | None = None,
) -> DataFrame:
    """Create or replace a table: ``df`` becomes its next version, which is returned as it was written.

    ``partition_by`` splits folders by value, ``sort_by`` orders files over the whole table, ``cluster_by`` deals rows
    into zones; they exclude each other. Pieces of a folder are of even size, however the rows are spread.

    Where the zones are cut is found by a pass over ``df`` of its own. ``cuts_of`` may name a table that is cheaper to
    read and has the same values in the clustered columns, such as the large side of the join that ``df`` is.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    number = (history(spark, root).agg(F.max("number")).first()[0] or 0) + 1
    folder = f"data-{number:06d}-{uuid.uuid4().hex}"
    out, folders = df, partition_by or []
    if cluster_by:
        out, folders = df.withColumn(ZONE, _zone(df, cluster_by, ranges, df if cuts_of is None else cuts_of)), [ZONE]
    if folders:
        out = out.hint("rebalance", *folders).sortWithinPartitions(*folders, *(cluster_by or []))
    elif sort_by:
        out = out.orderBy(*sort_by)
    out.write.partitionBy(*folders).parquet(f"{root}/{folder}")
    if cluster_by:
        _bounds(spark.read.schema(out.schema).parquet(f"{root}/{folder}"), cluster_by).coalesce(1).write.parquet(f"{root}/zones-{folder}")
    row = [(number, folder, df.schema.json(), bool(cluster_by))]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return current(spark, root, number)


def history(spark: SparkSession, path: str) -> DataFrame:
    """(number, folder, columns, zoned) of every published version; empty for a table that was never published."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/versions")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], MANIFEST)


def superseded(spark: SparkSession, path: str, keep: int = 1) -> DataFrame:
    """(number, folder) of versions older than the newest ``keep``: their folders are not read any more."""
    known = history(spark, path)
    newest = [r["number"] for r in known.orderBy(F.desc("number")).limit(keep).collect()]
    return known.where(F.col("number") < min(newest, default=0)).select("number", F.concat(F.lit(f"{path.rstrip('/')}/"), "folder").alias("folder"))


def _version(spark: SparkSession, path: str, number: int | None):
    known = history(spark, path)
    # of two builds that published the same number at once, the one that any reader would choose
    found = (known if number is None else known.where(F.col("number") == number)).orderBy(F.desc("number"), "folder").first()
    if found is None:
        raise FileNotFoundError(f"{path} has no published version{'' if number is None else f' {number}'}")
    return found


def _rows(spark: SparkSession, path: str, version) -> DataFrame:
    schema = StructType.fromJson(json.loads(version["columns"]))
    read = StructType([*schema.fields, *StructType.fromDDL(f"{ZONE} int").fields]) if version["zoned"] else schema
    return spark.read.schema(read).parquet(f"{path.rstrip('/')}/{version['folder']}")


def current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the newest version, or of version ``number``."""
    return _rows(spark, path, _version(spark, path, number)).drop(ZONE)


def filtered(
    spark: SparkSession, path: str, between: Mapping[str, tuple] | None = None, among: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """The newest version's rows with each column of ``between`` in its range (ends included, None is open) and each of
    ``among`` one of its values. Of a clustered table only zones are read that may hold such rows; of any other the
    same rows come from all its files.
    """
    version = _version(spark, path, None)
    table = _rows(spark, path, version)
    kinds = {f.name: f.dataType for f in table.schema}
    value = lambda c, x: F.lit(str(x) if isinstance(kinds[c], (DateType, TimestampType, TimestampNTZType)) else x).cast(kinds[c])
    wanted, possible = [], [F.lit(True)]
    zones = spark.read.parquet(f"{path.rstrip('/')}/zones-{version['folder']}") if version["zoned"] else None
    known = set(zones.columns) if zones is not None else set()
    for c, (low, high) in (between or {}).items():
        ends = [(F.col(c) >= value(c, low), F.col(f"high_{c}") >= value(c, low))] if low is not None else []
        ends += [(F.col(c) <= value(c, high), F.col(f"low_{c}") <= value(c, high))] if high is not None else []
        wanted += [row for row, _ in ends]
        possible += [zone for _, zone in ends if f"low_{c}" in known]
    for c, values in (among or {}).items():
        wanted.append(F.col(c).isin([value(c, v) for v in values]))
        if f"low_{c}" in known:
            possible.append(reduce(lambda a, b: a | b, [value(c, v).between(F.col(f"low_{c}"), F.col(f"high_{c}")) for v in values], F.lit(False)))
    if zones is not None:
        held = [r[0] for r in zones.where(reduce(lambda a, b: a & b, possible)).select(ZONE).collect()]  # never more than there are zones
        table = table.where(F.col(ZONE).isin(held))
    return reduce(DataFrame.where, wanted, table).drop(ZONE)


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values; of strings the first six bytes count."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.substring(F.hex(c), 1, 12), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, NumericType):
        return c.cast("double")
    raise ValueError(f"cannot cluster by {column} of type {kind.simpleString()}")


def _zone(df: DataFrame, columns: list[str], ranges: int, cuts_of: DataFrame) -> Column:
    """The interleaved numbers of the ranges that a row's values are in, as ``cuts_of`` cuts them; nulls are in the first range."""
    bits = (ranges - 1).bit_length()
    shares = [k / ranges for k in range(1, ranges)]
    cuts = cuts_of.agg(F.struct(*[F.percentile_approx(_number(cuts_of, c), shares).alias(c) for c in columns])).scalar()
    zone = F.lit(0)
    for i, c in enumerate(columns):
        above = [F.when(F.get(cuts[c], F.lit(k)) < _number(df, c), 1).otherwise(0) for k in range(ranges - 1)]
        own = reduce(lambda a, b: a + b, above)
        for bit in range(bits):
            zone = zone + F.shiftleft(F.shiftright(own, bit).bitwiseAND(F.lit(1)), bit * len(columns) + i)
    return zone.cast("int")


def _bounds(rows: DataFrame, columns: list[str]) -> DataFrame:
    ends = [e for c in columns for e in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
    return rows.groupBy(ZONE).agg(*ends)
