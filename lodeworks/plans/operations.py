"""Equipment performance and the unified shift KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.labels import SERIOUS, risk_band, risk_points
from lodeworks.functions.numeric import cap, recovery, round_half_up, safe_divide
from lodeworks.operators.dimension import join_dimension

GRAIN = ["day", "shift", "site"]


def equipment_performance(maintenance: DataFrame, equipment: DataFrame) -> DataFrame:
    """One row per truck shift: payload, availability, real and nominal rate, performance.

    Performance is capped at 1. A truck that the dimension lacks, or that did not operate, has no rate
    and gets performance 1 as well: the cap of a null is the cap. ``capped_unknown`` counts on that.
    """
    trucks = equipment.select("truck", "model", "cap_t", "cyc_h")
    joined = join_dimension(maintenance, trucks, "truck", spread_by=["day", "shift"])
    payload = F.col("cycles") * F.col("cap_t") * F.col("fill")
    rated = joined.withColumns(
        {
            "payload_t": payload,
            "availability": safe_divide(F.col("oper_h"), F.col("sched_h")),
            "rate_real": safe_divide(payload, F.col("oper_h")),
            "rate_nominal": F.col("cap_t") * F.col("cyc_h"),
        }
    )
    return rated.select(
        "day",
        "shift",
        "site",
        "truck",
        "model",
        "cap_t",
        "sched_h",
        "oper_h",
        "maint_h",
        "fail_h",
        "cycles",
        "payload_t",
        "availability",
        "rate_real",
        "rate_nominal",
        cap(safe_divide(F.col("rate_real"), F.col("rate_nominal")), 1.0).alias("performance"),
    )


def capped_unknown(performance: DataFrame) -> DataFrame:
    """Truck shifts whose performance of 1 is only the cap of an unknown rate."""
    return performance.where(F.col("rate_real").isNull() | F.col("rate_nominal").isNull() | (F.col("rate_nominal") == 0))


def fleet_by_shift(performance: DataFrame) -> DataFrame:
    """Fleet means and sums per shift. The means are over trucks, not weighted by hours."""
    return performance.groupBy(*GRAIN).agg(
        F.countDistinct("truck").alias("n_trucks"),
        F.avg("availability").alias("availability_mean"),
        F.avg("performance").alias("performance_mean"),
        F.sum("sched_h").alias("sched_total"),
        F.sum("oper_h").alias("oper_total"),
        F.sum("payload_t").alias("payload_total"),
    )


def plant_by_shift(telemetry: DataFrame) -> DataFrame:
    """Tonnage and tonnage-weighted grades per shift.

    A row without a grade still adds its tonnage to the weights, so the weighted grade reads low then.
    """
    weight = F.sum("tons")

    def weighted(grade: str):
        return safe_divide(F.sum(F.col(grade) * F.col("tons")), weight)

    return telemetry.groupBy(*GRAIN).agg(
        weight.alias("processed_total"),
        weighted("feed").alias("feed_mean"),
        weighted("conc").alias("conc_mean"),
        weighted("tail").alias("tail_mean"),
    )


def safety_by_shift(safety: DataFrame) -> DataFrame:
    """Incidents, serious incidents, lost hours and risk points per shift."""
    return safety.groupBy(*GRAIN).agg(
        F.count("*").alias("incidents"),
        F.count_if(F.col("sev").isin(SERIOUS)).alias("serious_incidents"),
        F.sum("down_h").alias("down_total"),
        F.sum(risk_points(F.col("sev"))).alias("risk_score"),
    )


def shift_kpis(performance: DataFrame, telemetry: DataFrame, safety: DataFrame) -> DataFrame:
    """One row per (day, shift, site) that had trucks, across the three domains.

    Each domain is reduced to the grain before the joins, and all three share one partitioning, so the
    joins shuffle nothing more. Shifts without trucks drop out, with their telemetry and incidents.
    """
    zero = F.lit(0)
    joined = (
        fleet_by_shift(performance)
        .join(plant_by_shift(telemetry), GRAIN, "left")
        .join(safety_by_shift(safety), GRAIN, "left")
        .withColumns(
            {
                "incidents": F.coalesce("incidents", zero),
                "serious_incidents": F.coalesce("serious_incidents", zero),
                "down_total": F.coalesce("down_total", F.lit(0.0)),
                "risk_score": F.coalesce("risk_score", zero),
            }
        )
    )
    quality = safe_divide(F.col("sched_total") - F.col("down_total"), F.col("sched_total"))
    rated = joined.withColumn("quality", quality)
    oee = F.col("availability_mean") * F.col("performance_mean") * F.col("quality") * 100.0
    return rated.select(
        *GRAIN,
        "n_trucks",
        round_half_up(F.col("availability_mean") * 100.0, 2).alias("availability_pct"),
        round_half_up(F.col("performance_mean") * 100.0, 2).alias("performance_pct"),
        round_half_up(F.col("quality") * 100.0, 2).alias("quality_pct"),
        round_half_up(oee, 2).alias("oee_pct"),
        round_half_up(recovery(F.col("feed_mean"), F.col("conc_mean"), F.col("tail_mean")), 2).alias("recovery_pct"),
        round_half_up(F.col("processed_total"), 1).alias("processed_t"),
        round_half_up(F.col("payload_total"), 1).alias("payload_t"),
        "incidents",
        "serious_incidents",
        round_half_up(F.col("down_total"), 2).alias("down_h"),
        "risk_score",
        risk_band(F.col("risk_score")).alias("risk_level"),
    )
