"""Feature tables for a failure model (truck shifts) and a process model (plant hours).

All frames look back only; the single look ahead is the label. Frames count rows, as published: a gap in
the history is not noticed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.labels import shift_order
from lodeworks.functions.numeric import positive_flag, recovery
from lodeworks.operators import blocks
from lodeworks.operators.ranks import ranked
from lodeworks.session import scratch_folder
from lodeworks.sources.tables import write_table

#: The last column decides between rows of one shift, of which only a truck without an id should have several.
TRUCK_ORDER = ["day", "shift_ord", "tie"]
#: Columns of truck shifts that the features take; no others are shuffled.
FAILURE_INPUT = ["day", "shift", "site", "truck", "model", "cap_t", "oper_h", "maint_h", "fail_h", "availability", "performance"]
SHIFT_FRAME = 7
HOUR_FRAME = 6
#: Fixed stretches of the calendar that one task takes of a truck's or a site's history.
BLOCK_MONTHS = 12
BLOCK_SECONDS = 7 * 86_400
HOURS = "decimal(28, 9)"
#: Rows that a task takes of one truck; a stretch with more of them is cut by rank.
STRETCH_ROWS = 200_000
#: Block number of rows without a day, behind those of all dates; and numbers between two stretches, for their cuts.
UNDATED = 1 << 30
CUTS = 1 << 32


def failure_features(performance: DataFrame, block_months: int = BLOCK_MONTHS, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """One row per truck shift: running hours, 7-shift frames, shifts since a failure, next-shift label.

    Histories are cut into stretches of ``block_months`` calendar months: a year has at most 732 rows of a truck by
    the table's grain. Rows without a day come last. A stretch with more than ``stretch_rows`` rows, such as that of
    a missing or placeholder id or date, is cut further by the rank of its rows. Hours are summed as decimals, so their
    total does not depend on where blocks end; rows of one truck and shift are ordered by a hash of their values. Shifts
    since a failure count from the truck's first row until it first fails.

    Rows are read by the count of stretches, by their ranks, by the summaries and by the windows: performance should be a
    stored table, as in a build, or the aggregates and joins behind it are done for each.
    """
    month = F.year("day") * 12 + F.month("day") - 1
    calendar = F.coalesce(F.floor(month / F.lit(block_months)), F.lit(UNDATED))
    marked = performance.withColumns(
        {
            "shift_ord": shift_order(F.col("shift")),
            "tie": F.xxhash64(*performance.columns),
            "failed": positive_flag(F.col("fail_h")),
            "block": calendar * F.lit(CUTS),
            "hours": F.col("oper_h").cast(HOURS),
        }
    ).select(*FAILURE_INPUT, "shift_ord", "tie", "failed", "block", "hours")
    marked = _cut_by_rank(marked, stretch_rows)
    rows = blocks.add_state(marked, _truck_state(marked), ["truck"], "block")
    run = blocks.within(["truck", "block"], TRUCK_ORDER)
    so_far = run.rowsBetween(Window.unboundedPreceding, 0)
    frame = run.rowsBetween(1 - SHIFT_FRAME, 0)
    # State rows sort first, so a running maximum hands their totals to every row of the block.
    own = ~F.col(blocks.CONTEXT)
    n_here = F.sum(F.when(own, 1).otherwise(0)).over(so_far)
    counted = rows.withColumns(
        {
            "rows_before": F.max("rows_before").over(so_far),
            "hours_before": F.max("hours_before").over(so_far),
            "failed_before": F.max("failed_before").over(so_far),
            "next_failed": F.max("next_failed").over(so_far),
            "n_here": n_here,
        }
    )
    row = F.col("n_here") + F.coalesce("rows_before", F.lit(0))
    numbered = counted.withColumn("row", row)
    last_failed = F.greatest(F.max(F.when(own & (F.col("failed") == 1), F.col("row"))).over(so_far), F.col("failed_before"))
    own_hours = F.sum(F.when(own, F.col("hours"))).over(so_far)
    hours = F.coalesce(F.col("hours_before") + own_hours, own_hours, F.col("hours_before"))
    featured = numbered.withColumns(
        {
            "oper_h_total": hours.cast("double"),
            "availability_7": F.avg("availability").over(frame),
            "fail_h_7": F.sum("fail_h").over(frame),
            "maint_h_7": F.sum("maint_h").over(frame),
            "shifts_since_failure": (F.col("row") - F.coalesce(last_failed, F.lit(1))).cast("bigint"),
            "fails_next_shift": F.coalesce(F.lead("failed").over(run), F.col("next_failed")),
        }
    )
    return featured.where(own).select(
        "day",
        "shift",
        "site",
        "truck",
        "model",
        "cap_t",
        "oper_h",
        "oper_h_total",
        "maint_h",
        "maint_h_7",
        "fail_h",
        "fail_h_7",
        "availability",
        "availability_7",
        "performance",
        "shifts_since_failure",
        "failed",
        "fails_next_shift",
    )


def _cut_by_rank(marked: DataFrame, stretch_rows: int) -> DataFrame:
    """Rows with the block of their place in their stretch, where a stretch has too many rows for one task.

    Long stretches are at most one in ``stretch_rows`` rows. There mostly are none, which a count tells; if there are,
    their rows alone are ranked.
    """
    counts = marked.groupBy("truck", "block").agg(F.count("*").alias("n")).where(F.col("n") > stretch_rows)
    long = write_table(counts.select(F.col("truck").alias("of"), F.col("block").alias("stretch")), scratch_folder(marked.sparkSession, "long-stretches"))
    if long.isEmpty():
        return marked
    same = F.col("truck").eqNullSafe(F.col("of")) & (F.col("block") == F.col("stretch"))
    order = ["truck", "block", *TRUCK_ORDER]  # a block's rows all have a day, or none has
    rows = ranked(marked.join(F.broadcast(long), same, "left_semi"), order, "rank")
    cut = rows.withColumn("block", F.col("block") + F.floor(F.col("rank") / F.lit(stretch_rows))).drop("rank")
    return marked.join(F.broadcast(long), same, "left_anti").unionByName(cut)


def _truck_state(marked: DataFrame) -> DataFrame:
    """State rows of each (truck, block): totals before it, the label after it, the six rows before it."""
    keep = SHIFT_FRAME - 1
    carried = ["availability", "fail_h", "maint_h"]
    run = Window.partitionBy("truck", "block").orderBy(*TRUCK_ORDER)
    narrow = marked.select("truck", "block", *TRUCK_ORDER, *carried, "failed", "hours").repartition("truck", "block")
    ranked = narrow.withColumns({"row": F.row_number().over(run), "late": F.lead(F.lit(1), keep).over(run).isNull()})
    summary = ranked.groupBy("truck", "block").agg(
        F.count("*").alias("n"),
        F.sum("hours").alias("hours"),
        F.max(F.when(F.col("failed") == 1, F.col("row"))).alias("failed_row"),
        F.min_by("failed", "row").alias("first_failed"),
        F.sort_array(F.collect_list(F.when(F.col("late"), F.struct(*TRUCK_ORDER, *carried)))).alias("tail"),
    )
    before = blocks.earlier_blocks(["truck"], "block")
    known = summary.withColumns(
        {
            "rows_before": F.sum("n").over(before),
            "hours_before": F.sum("hours").over(before),
            "next_failed": F.lead("first_failed").over(Window.partitionBy("truck").orderBy(blocks.block_order("block"))),
            "previous": blocks.last_rows(F.col("tail"), ["truck"], "block", keep),
        }
    )
    failed_at = F.coalesce("rows_before", F.lit(0)) + F.col("failed_row")
    known = known.withColumn("failed_before", F.max(failed_at).over(before))
    return known.select(
        "truck", "block", "rows_before", "hours_before", "failed_before", "next_failed", F.explode_outer("previous").alias("p")
    ).select("truck", "block", "rows_before", "hours_before", "failed_before", "next_failed", "p.*")


def failure_streak(performance: DataFrame) -> DataFrame:
    """Shifts since the last failure only."""
    return failure_features(performance).select("truck", "day", "shift", "failed", "shifts_since_failure")


def process_features(telemetry: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per plant hour: previous grades, 6-row means and deviation, and the two targets.

    There are few sites, so histories are cut into stretches of ``block_seconds``, each of which is given the five
    rows before it. Rows without a time come last.
    """
    keep = HOUR_FRAME - 1
    cut = telemetry.withColumn("block", blocks.time_block("ts", block_seconds))
    rows = blocks.with_previous_rows(cut, ["site"], ["ts"], "block", keep, ["conc", "feed", "dose", "ph", "tons"])
    run = blocks.within(["site", "block"], ["ts"])
    frame = run.rowsBetween(-keep, 0)
    featured = rows.withColumns(
        {
            "tons_6": F.avg("tons").over(frame),
            "feed_lag": F.lag("feed").over(run),
            "feed_sd_6": F.stddev_samp("feed").over(frame),
            "dose_6": F.avg("dose").over(frame),
            "ph_6": F.avg("ph").over(frame),
            "conc_lag": F.lag("conc").over(run),
        }
    )
    return blocks.drop_state(featured, "block").select(
        "record_id",
        "site",
        "ts",
        "day",
        "shift",
        "tons",
        "tons_6",
        "feed",
        "feed_lag",
        "feed_sd_6",
        "dose",
        "dose_6",
        "ph",
        "ph_6",
        "conc_lag",
        "tail",
        F.col("conc").alias("target_conc"),
        recovery(F.col("feed"), F.col("conc"), F.col("tail")).alias("target_recovery"),
    )


def label_coverage(failure: DataFrame, process: DataFrame) -> DataFrame:
    """Rows, labelled rows and positives of the two feature tables."""
    nothing = F.lit(None).cast("bigint")
    a = failure.agg(
        F.count("*").alias("n_rows"),
        F.count("fails_next_shift").alias("labelled"),
        F.count_if(F.col("fails_next_shift") == 1).alias("positives"),
    ).select(F.lit("failure").alias("tbl"), "n_rows", "labelled", nothing.alias("labelled_grade"), "positives")
    b = process.agg(
        F.count("*").alias("n_rows"),
        F.count("target_recovery").alias("labelled"),
        F.count("target_conc").alias("labelled_grade"),
    ).select(F.lit("process").alias("tbl"), "n_rows", "labelled", "labelled_grade", nothing.alias("positives"))
    return a.unionByName(b)


def training_rows(failure: DataFrame) -> DataFrame:
    """Rows that have a label."""
    return failure.where(F.col("fails_next_shift").isNotNull())
