"""All tables of the warehouse from the raw ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lodeworks.operators.quality import require_contract, run_suite
from lodeworks.plans import checks, features, operations, prices, staging, yearbook
from lodeworks.sources.versions import current, filtered, publish

#: Tables that a build publishes, and how; all others are views. Yearbook files are split by tab, shift KPIs lie in order
#: of day, and truck shifts in zones of day, site and truck, so that filters on any of these leave files out.
WRITTEN: dict[str, dict[str, list[str]]] = {
    "stg_yearbook": {"partition_by": ["tab"]},
    "equipment_performance": {"cluster_by": ["day", "site", "truck"]},
    "shift_kpis": {"sort_by": ["day", "site", "shift"]},
    "dim_producer": {},
    "producer_year": {},
    "sector_year": {},
    "price_monthly": {},
    "energy_cost_year": {},
}


def place(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def opened(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The published tables of a warehouse, as its last build left them."""
    return {name: current(spark, place(folder, name)) for name in WRITTEN}


def truck_shifts(
    spark: SparkSession, folder: str, sites: list[str] | None = None, trucks: list[str] | None = None, first_day=None, last_day=None
) -> DataFrame:
    """Published truck shifts of the given sites, trucks and days; files without any are not read."""
    among = {c: v for c, v in (("site", sites), ("truck", trucks)) if v is not None}
    return filtered(spark, place(folder, "equipment_performance"), {"day": (first_day, last_day)}, among)


def build(raw: Mapping[str, DataFrame], folder: str | None = None, min_days: int = prices.MIN_PRICED_DAYS) -> dict[str, DataFrame]:
    """Every table by name.

    ``raw`` has raw_telemetry, raw_maintenance, raw_safety, equipment, and raw_yearbook or raw_sheets (sheet rows of
    the published workbook), and raw_daily_price or raw_hourly_price.
    With ``folder`` the marts, and the two tables that several marts read, are published there as Parquet
    and read back, so later tables neither recompute them nor depend on executors that are lost. A table is replaced
    when all its new rows are there; a build that fails leaves the rest as the last one published it.

    raw_maintenance is read for the trucks with most rows, for the zones' cuts, and for the truck shifts; daily prices
    once for each mart. They should be stored tables, or what is behind them is done for each.
    """
    tables: dict[str, DataFrame] = {"equipment": raw["equipment"]}

    def add(name: str, df: DataFrame, **options) -> DataFrame:
        if folder and name in WRITTEN:
            df = publish(df, place(folder, name), **WRITTEN[name], **options)
        tables[name] = df
        return df

    telemetry = add("stg_telemetry", staging.telemetry(raw["raw_telemetry"]))
    maintenance = add("stg_maintenance", staging.maintenance(raw["raw_maintenance"]))
    safety = add("stg_safety", staging.safety(raw["raw_safety"]))
    # every maintenance row is a truck shift of the same day, site and truck: zones are cut without the join
    performance = add("equipment_performance", operations.equipment_performance(maintenance, raw["equipment"]), cuts_of=maintenance)
    add("shift_kpis", operations.shift_kpis(performance, telemetry, safety))
    add("failure_features", features.failure_features(performance))
    add("process_features", features.process_features(telemetry))

    long = raw["raw_yearbook"] if "raw_yearbook" in raw else yearbook.from_workbook(raw["raw_sheets"])
    stage = add("stg_yearbook", yearbook.staged(long))
    mines = add("yb_producers", yearbook.producers(stage))
    published = add("yb_totals", yearbook.totals(stage))
    add("yb_grades", yearbook.grades(stage))
    index = add("yb_indices", yearbook.indices(stage))
    energy = add("yb_energy", yearbook.energy(stage))
    add("yb_intensity", yearbook.intensity(stage))
    add("yb_water", yearbook.water(stage))
    add("yb_prices", yearbook.metal_prices(stage))
    add("dim_producer", yearbook.dim_producer(mines))
    add("producer_year", yearbook.producer_year(mines, published, index))
    add("sector_year", yearbook.sector_year(stage))

    daily = raw["raw_daily_price"] if "raw_daily_price" in raw else prices.daily_summary(raw["raw_hourly_price"])
    price = add("stg_price", prices.staged(daily))
    add("price_monthly", prices.monthly(price))
    add("energy_cost_year", prices.energy_cost_year(price, energy, published, min_days))
    return tables


def run(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build and write all tables, check the schema contract, and return the tables and the suite's counts."""
    tables = build(raw, folder)
    require_contract(tables, checks.CONTRACT)
    return tables, run_suite(tables, checks.SUITE)
