"""Report and dashboard queries over the marts. Results are small; sorting is left to the reader."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.labels import RISK_LEVELS, classify
from lodeworks.functions.numeric import implied_tonnage, round_half_even
from lodeworks.operators import shape

DETAIL = [
    "day", "shift", "site", "availability_pct", "oee_pct", "quality_pct", "recovery_pct", "incidents", "risk_level"
]
SECTOR_SERIES = ["mill_electricity_tj", "cost_index", "output_kt", "mill_kwh_per_t", "mill_grade"]
REPORT_BUSES = ["Crucero", "Quillota", "Puerto Montt"]


def filter_user(
    df: DataFrame,
    sites: list[str] | None = None,
    shifts: list[str] | None = None,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
) -> DataFrame:
    """The dashboard's filter on a table with site, shift and day; an unset part lets all rows through."""
    out = df
    if sites is not None:
        out = out.where(F.col("site").isin(list(sites)))
    if shifts is not None:
        out = out.where(F.col("shift").isin(list(shifts)))
    if first_day is not None:
        out = out.where(F.col("day") >= F.lit(str(first_day)).cast("date"))
    if last_day is not None:
        out = out.where(F.col("day") <= F.lit(str(last_day)).cast("date"))
    return out


def filter_domain(kpis: DataFrame) -> DataFrame:
    """What the filter can choose from, as (field, choice) rows: sites, shifts, first and last day.

    One pass reduces the table to its (site, shift) pairs; the rest works on those.
    """
    pairs = kpis.groupBy("site", "shift").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))

    def choices(field: str) -> DataFrame:
        return pairs.select(F.lit(field).alias("field"), F.col(field).alias("choice")).distinct()

    ends = pairs.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("choice")) for c in ("first_day", "last_day")])
        )
    )
    return choices("site").unionByName(choices("shift")).unionByName(ends)


def detail(kpis: DataFrame) -> DataFrame:
    return kpis.select(*DETAIL)


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """Mean availability, OEE and recovery, and all incidents."""
    return kpis.agg(
        F.avg("availability_pct").alias("availability_pct"),
        F.avg("oee_pct").alias("oee_pct"),
        F.avg("recovery_pct").alias("recovery_pct"),
        F.sum("incidents").alias("incidents"),
    )


def daily_trend(kpis: DataFrame) -> DataFrame:
    """Means of each day; shifts without a day are in none."""
    measures = ["availability_pct", "oee_pct", "performance_pct", "quality_pct", "recovery_pct"]
    return kpis.where("day is not null").groupBy("day").agg(*[F.avg(c).alias(c) for c in measures])


def clean_or_incident():
    return classify(F.col("incidents") == 0, "clean", "incident")


def clean_vs_incident(kpis: DataFrame) -> DataFrame:
    """Mean KPIs of shifts without and with incidents."""
    measures = ["availability_pct", "performance_pct", "quality_pct", "oee_pct", "recovery_pct"]
    return kpis.groupBy(clean_or_incident().alias("grp")).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(c) for c in measures]
    )


def oee_histogram_by_incident(kpis: DataFrame, bins: int = 33) -> DataFrame:
    return shape.histogram(kpis.withColumn("grp", clean_or_incident()), ["oee_pct"], bins, ["grp"]).drop("measure")


def kpi_histograms(kpis: DataFrame, bins: int = 36) -> DataFrame:
    """Histograms of OEE and recovery."""
    return shape.histogram(kpis, ["oee_pct", "recovery_pct"], bins)


def kpi_stats(kpis: DataFrame) -> DataFrame:
    return shape.summary_stats(kpis, ["oee_pct", "recovery_pct"])


def risk_by_score(kpis: DataFrame) -> DataFrame:
    """Shifts per (level, score). Summing n by level gives the level's shifts, however many scores it has."""
    return kpis.groupBy("risk_level", "risk_score").agg(
        F.count("*").alias("n"), F.max("incidents").alias("max_incidents"), F.avg("oee_pct").alias("oee_pct")
    )


def risk_stats(kpis: DataFrame) -> DataFrame:
    return kpis.agg(F.max("incidents").alias("max_incidents"), F.countDistinct("risk_score").alias("n_scores"))


def risk_distribution(kpis: DataFrame) -> DataFrame:
    """Shifts per risk level, all four levels in any case."""
    return shape.value_counts(kpis, "risk_level", RISK_LEVELS)


def high_risk_shifts(kpis: DataFrame) -> DataFrame:
    """Shifts of the two upper levels, most points first."""
    risky = kpis.where(F.col("risk_level").isin(RISK_LEVELS[2:])).select(
        "day", "shift", "site", "incidents", "serious_incidents", "risk_score", "risk_level"
    )
    return risky.orderBy(F.col("risk_score").desc(), "day", "site", "shift")


def truck_summary(performance: DataFrame) -> DataFrame:
    """Per truck: mean availability and performance in percent, and payload. Trucks without a model drop out."""
    known = performance.where(F.col("model").isNotNull() & F.col("truck").isNotNull() & F.col("site").isNotNull())
    return known.groupBy("truck", "site", "model").agg(
        round_half_even(F.avg("availability") * 100.0, 1).alias("availability_pct"),
        round_half_even(F.avg("performance") * 100.0, 1).alias("performance_pct"),
        F.sum("payload_t").alias("payload_t"),
    )


def sector_window(sector: DataFrame, first_yr: int = 2005, last_yr: int = 2024) -> DataFrame:
    return sector.where(F.col("yr").between(first_yr, last_yr)).select("yr", *SECTOR_SERIES)


def sector_index(sector: DataFrame, first_yr: int = 2005, last_yr: int = 2024) -> DataFrame:
    """The sector's series as indices of the first year shown."""
    return shape.base_index(sector_window(sector, first_yr, last_yr), "yr", SECTOR_SERIES)


def sector_index_last(sector: DataFrame, first_yr: int = 2005, last_yr: int = 2024) -> DataFrame:
    """The last known value of each index series."""
    return shape.last_known(sector_index(sector, first_yr, last_yr), "yr", SECTOR_SERIES)


def implied_ore(sector: DataFrame, first_yr: int = 2005, last_yr: int = 2024) -> DataFrame:
    """Million tonnes of ore per year that the mills' electricity implies."""
    shown = sector_window(sector, first_yr, last_yr)
    return shown.select("yr", implied_tonnage(F.col("mill_electricity_tj"), F.col("mill_kwh_per_t")).alias("ore_mt"))


def top_producers(producers_year: DataFrame, yr: int = 2025, k: int = 15) -> DataFrame:
    """The k largest named mines of a year."""
    of_year = producers_year.where((F.col("yr") == yr) & (F.col("mine") != "Otros"))
    return shape.top_k(of_year.select("mine", "owner", "output_kt", "share_pct"), "output_kt", k, ["mine"])


def cost_selected(costs: DataFrame, buses: list[str] | None = None) -> DataFrame:
    return costs.where(F.col("bus").isin(buses or REPORT_BUSES)).select("yr", "bus", "cost_usd_per_t", "cost_musd")


def zone_monthly(months: DataFrame) -> DataFrame:
    """Mean solar and night price per (month, zone)."""
    return months.groupBy("month", "zone").agg(F.avg("price_solar").alias("solar"), F.avg("price_night").alias("night"))


def top_rows(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows in a given full order, for a preview."""
    return df.orderBy(*order).limit(n)


