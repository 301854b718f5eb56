"""Electricity prices: hourly to daily, typed days, months, and the value of the sector's electricity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.labels import NIGHT_HOURS, NORTH_BUSES, SOLAR_HOURS, SOUTH_BUSES, avg_where, bus_zone, local_hour, sum_where
from lodeworks.functions.numeric import clip_lower, kt_to_t, round_half_even, round_half_up, safe_divide, tj_to_mwh

#: Days of price that a year needs before it is valued.
MIN_PRICED_DAYS = 330


def daily_summary(hourly: DataFrame) -> DataFrame:
    """One row per (day, bus): means of the day, of the solar and of the night hours, and the hours seen.

    Values below zero are noise around a free hour and count as 0. An hour without price counts as seen. Hours
    without a day or a bus belong to no row.
    """
    h = local_hour(F.col("hour"))
    price = clip_lower(F.col("price"), 0.0)
    return hourly.where("day is not null and bus is not null").groupBy("day", "bus").agg(
        round_half_even(F.avg(price), 2).alias("price_mean"),
        round_half_even(avg_where(price, h.isin(SOLAR_HOURS)), 2).alias("price_solar"),
        round_half_even(avg_where(price, h.isin(NIGHT_HOURS)), 2).alias("price_night"),
        F.count("*").alias("hours"),
    )


def staged(daily: DataFrame) -> DataFrame:
    """The six buses with a full series, with year, month and zone."""
    return daily.where(F.col("bus").isin(NORTH_BUSES + SOUTH_BUSES)).select(
        F.col("day").cast("date").alias("day"),
        F.year("day").alias("yr"),
        F.month("day").alias("mon"),
        "bus",
        bus_zone(F.col("bus")).alias("zone"),
        "price_mean",
        "price_solar",
        "price_night",
        "hours",
    )


def monthly(stage: DataFrame) -> DataFrame:
    """One row per (month, bus): mean prices and how much dearer the night is than the solar hours."""
    return (
        stage.groupBy("yr", "mon", "bus")
        .agg(
            F.any_value("zone", True).alias("zone"),
            F.count("*").alias("days"),
            round_half_up(F.avg("price_mean"), 2).alias("price_mean"),
            round_half_up(F.avg("price_solar"), 2).alias("price_solar"),
            round_half_up(F.avg("price_night"), 2).alias("price_night"),
            round_half_up(F.avg("price_night") - F.avg("price_solar"), 2).alias("night_solar_gap"),
        )
        .select(F.make_date("yr", "mon", F.lit(1)).alias("month"), "bus", "zone", "days", "price_mean", "price_solar", "price_night", "night_solar_gap")
    )


def annual(stage: DataFrame, min_days: int = MIN_PRICED_DAYS) -> DataFrame:
    """(yr, bus, priced_days, price): the bus-years with enough priced days."""
    years = stage.groupBy("yr", "bus").agg(F.count("*").alias("priced_days"), F.avg("price_mean").alias("price"))
    return years.where(F.col("priced_days") >= min_days)


def energy_cost_year(stage: DataFrame, energy: DataFrame, totals: DataFrame, min_days: int = MIN_PRICED_DAYS) -> DataFrame:
    """The sector's electricity valued at each bus's mean price, per year with enough priced days."""
    tj = F.col("energy_tj")
    power = (
        energy.where(F.col("source") == "electricidad")
        .groupBy("yr")
        .agg(
            sum_where(tj, F.col("process") == "Total").alias("total_tj"),
            sum_where(tj, F.col("process") == "Concentradora").alias("mill_tj"),
        )
    )
    copper = totals.select("yr", "total_kt")
    joined = annual(stage, min_days).join(power, "yr").join(copper, "yr")
    mwh = tj_to_mwh(F.col("total_tj"))
    return joined.select(
        "yr",
        "bus",
        "priced_days",
        round_half_up(F.col("price"), 2).alias("price"),
        round_half_up(mwh, 0).alias("electricity_mwh"),
        round_half_up(mwh * F.col("price") / 1e6, 1).alias("cost_musd"),
        round_half_up(tj_to_mwh(F.col("mill_tj")) * F.col("price") / 1e6, 1).alias("mill_cost_musd"),
        round_half_up(safe_divide(mwh * F.col("price"), kt_to_t(F.col("total_kt"))), 1).alias("cost_usd_per_t"),
    )


def coverage(daily: DataFrame) -> DataFrame:
    """Per bus: first and last day, rows, and rows with a negative mean."""
    return daily.groupBy("bus").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count("*").alias("n_rows"),
        F.count_if(F.col("price_mean") < 0).alias("n_negative"),
    )
