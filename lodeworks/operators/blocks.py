"""Windows over long histories, cut into blocks.

A window that is partitioned by site or truck puts one site's whole history in one task. Here each
history is cut into blocks of the order column (days, months, row ranges), and the shuffle is on
(key, block). Blocks are fixed parts of the calendar: they depend neither on the number of rows nor on the
first and last date, so a placeholder date is a block of its own and moves no other. What a block needs
from the blocks before it is kept in one summary row per block: totals, last values, and the last few
rows. A window over the summary rows turns these into the state at the start of each block, which is
added to the block as extra rows that sort first. An ordinary window inside the block then gives the
same values as a window over the whole history.

Rows without a place in the order come last in their history, as in SQL engines that sort nulls last:
their block is null and follows all others.

Row frames count rows, not time: with sparse blocks the rows before a block may come from several
earlier blocks, and are taken from as many as needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows that one block should hold when the width is chosen from the data.
BLOCK_ROWS = 100_000
CONTEXT = "_context"


def wall_seconds(ts: str) -> Column:
    """Seconds since 1970 by the wall clock, so that a zone's clock change cannot reorder blocks."""
    t = F.col(ts)
    days = F.datediff(t, F.lit("1970-01-01").cast("date"))
    return days * F.lit(86400).cast("bigint") + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def time_block(ts: str, seconds: int) -> Column:
    """Number of the stretch of ``seconds`` since 1970 that a time is in; null without a time."""
    return F.floor(wall_seconds(ts) / F.lit(seconds))


def row_block(number: str, rows: int = BLOCK_ROWS) -> Column:
    """The first row number of the block that a row number is in."""
    n = F.col(number).cast("bigint")
    return n - F.pmod(n, F.lit(rows))


def within(keys: list[str], order: list[str]) -> WindowSpec:
    """Window inside one block, for rows with ``_context``: state rows, then rows in order, then rows without a place."""
    stage = F.when(F.col(CONTEXT), 0).when(F.col(order[0]).isNull(), 2).otherwise(1)
    rest = [F.col(c).asc_nulls_first() for c in order[1:]]
    return Window.partitionBy(*keys).orderBy(stage, F.col(order[0]).asc_nulls_last(), *rest)


def block_order(block: str) -> Column:
    """Order of a key's blocks: that of the rows without a place is the last."""
    return F.col(block).asc_nulls_last()


def earlier_blocks(keys: list[str], block: str) -> WindowSpec:
    """All blocks of a key before the current one, for windows over summary rows."""
    return Window.partitionBy(*keys).orderBy(block_order(block)).rowsBetween(Window.unboundedPreceding, -1)


def last_rows(rows: Column, keys: list[str], block: str, n: int) -> Column:
    """The n rows before a block, from the summaries' arrays of each block's last n rows.

    Every block has a row, so the n blocks before it hold at least the n rows before it, if they exist.
    """
    nearest = Window.partitionBy(*keys).orderBy(block_order(block)).rowsBetween(-n, -1)
    joined = F.flatten(F.collect_list(rows).over(nearest))
    return F.slice(joined, F.greatest(F.size(joined) - n + 1, F.lit(1)), n)


def add_state(df: DataFrame, state: DataFrame, keys: list[str], block: str) -> DataFrame:
    """Union of df and the state rows, spread by (key, block); ``_context`` marks the state rows.

    The explicit repartition keeps Spark from reusing a partitioning on the key alone, which would
    also satisfy the window but would bring a hot key's blocks back together.
    """
    rows = df.withColumn(CONTEXT, F.lit(False))
    both = rows.unionByName(state.withColumn(CONTEXT, F.lit(True)), allowMissingColumns=True)
    return both.repartition(*keys, block)


def drop_state(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(~F.col(CONTEXT)).drop(CONTEXT, *columns)


def with_previous_rows(
    df: DataFrame, keys: list[str], order: list[str], block: str, n: int, columns: list[str]
) -> DataFrame:
    """df plus, in each block, copies of the n rows before it (``columns`` only), as state rows."""
    newest = Window.partitionBy(*keys, block).orderBy(*[F.col(c).desc() for c in order])
    # A row number limited by a filter is also applied before the shuffle: n rows per task and block.
    tails = (
        df.select(*keys, block, *order, *columns)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= n)
        .groupBy(*keys, block)
        .agg(F.sort_array(F.collect_list(F.struct(*order, *columns))).alias("_tail"))
    )
    state = (
        tails.select(*keys, block, last_rows(F.col("_tail"), keys, block, n).alias("_rows"))
        .select(*keys, block, F.inline("_rows"))
    )
    return add_state(df, state, keys, block)


def fill_forward(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``name``: the last non-null ``value`` up to each row, per key, in the order of ``order``."""
    block = "_block"
    cut = df.withColumn(block, row_block(order, rows)).withColumn(name, value)
    newest = F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order)))
    summary = cut.groupBy(*keys, block).agg(newest.alias("_newest"))
    before = F.last("_newest", ignorenulls=True).over(earlier_blocks(keys, block))
    state = summary.select(*keys, block, before.alias(name)).where(F.col(name).isNotNull())
    filled = F.last(name, ignorenulls=True).over(
        within([*keys, block], [order]).rowsBetween(Window.unboundedPreceding, 0)
    )
    return drop_state(add_state(cut, state, keys, block).withColumn(name, filled), block)
