"""Numbers of rows in an order over the whole table, without a window over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.session import scratch_folder
from lodeworks.sources.tables import write_table

AT = "_at"
#: Bits of a row's place within its partition in the ids that Spark gives.
PLACE_BITS = 33


def ranked(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with the long column ``name``: each row's number from 0 in the given order, ties in any order.

    Rows are dealt to partitions by ranges of the order, sorted there, and written with their partition and place: ranges
    come from a sample, so they must not be drawn twice. The partitions' counts, one row each, are added up in order.
    A value that fills the table is spread only as far as ``order`` tells its rows apart.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(AT, F.monotonically_increasing_id())
    stored = write_table(placed, scratch_folder(df.sparkSession, "ranked"))
    part = F.shiftright(AT, PLACE_BITS).alias("_part")
    counts = stored.groupBy(part).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_part", before.alias("_before"))  # as many rows as there are partitions
    place = F.col(AT).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    numbered = stored.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + place)
    return numbered.drop("_part", "_before", AT)
