"""Typed views of the operational raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def telemetry(raw: DataFrame) -> DataFrame:
    """Hourly plant rows that have a tonnage, with their calendar day."""
    return raw.where(F.col("tons").isNotNull()).select(
        "record_id", "site", "ts", F.to_date("ts").alias("day"), "shift", "tons", "feed", "conc", "tail", "dose", "ph"
    )


def maintenance(raw: DataFrame) -> DataFrame:
    """Truck shifts whose operated hours are known."""
    return raw.where(F.col("oper_h").isNotNull()).select(
        "record_id", "site", "truck", "day", "shift", "sched_h", "oper_h", "maint_h", "fail_h", "cycles", "fill"
    )


def safety(raw: DataFrame) -> DataFrame:
    """Incidents with upper-case severity; unknown downtime counts as 0 hours."""
    return raw.select(
        "incident_id",
        "site",
        "day",
        "shift",
        "truck",
        F.upper("sev").alias("sev"),
        "kind",
        F.coalesce("down_h", F.lit(0.0)).alias("down_h"),
    )
