"""The warehouse's declared data tests, its own assertions, and its schema contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.labels import DAY_SHIFT, NIGHT_SHIFT, NORTH_BUSES, RISK_LEVELS, SERIOUS, SITES, SOUTH_BUSES
from lodeworks.operators.quality import Check, reconcile
from lodeworks.plans.yearbook import UNITS


def present(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in columns]


def one_of(table: str, column: str, values: list) -> Check:
    return Check(table, "accepted_values", (column,), {"values": values})


def between(table: str, low: float | None, high: float | None, *columns: str) -> list[Check]:
    return [Check(table, "accepted_range", (c,), {"low": low, "high": high}) for c in columns]


def key(table: str, *columns: str) -> Check:
    return Check(table, "unique" if len(columns) == 1 else "unique_combination", columns)


# Fixed values from here to the contract: the published tests and columns, which must match.
SHIFTS = [DAY_SHIFT, NIGHT_SHIFT]

OPERATIONS = [
    key("stg_telemetry", "site", "ts"),
    key("stg_telemetry", "record_id"),
    *present("stg_telemetry", "record_id", "site", "shift", "feed"),
    one_of("stg_telemetry", "site", SITES),
    one_of("stg_telemetry", "shift", SHIFTS),
    *between("stg_telemetry", 0, 100, "feed", "conc", "tail"),
    *between("stg_telemetry", 0, 14, "ph"),
    *between("stg_telemetry", 0, None, "dose", "tons"),
    key("stg_maintenance", "truck", "day", "shift"),
    key("stg_maintenance", "record_id"),
    *present("stg_maintenance", "record_id", "truck", "oper_h"),
    *between("stg_maintenance", 0, 12, "oper_h"),
    *between("stg_maintenance", 0, 24, "sched_h"),
    *between("stg_maintenance", 0, None, "maint_h", "fail_h"),
    *between("stg_maintenance", 0, 1.3, "fill"),
    key("stg_safety", "incident_id"),
    *present("stg_safety", "incident_id", "down_h"),
    one_of("stg_safety", "sev", ["LEVE", *SERIOUS]),
    *between("stg_safety", 0, None, "down_h"),
    key("equipment", "truck"),
    *present("equipment", "truck", "cap_t", "cyc_h"),
    key("equipment_performance", "truck", "day", "shift"),
    *present("equipment_performance", "truck", "site", "availability", "payload_t"),
    *between("equipment_performance", 0, 1, "availability", "performance"),
    *between("equipment_performance", 0, None, "payload_t"),
    key("shift_kpis", "day", "shift", "site"),
    *present("shift_kpis", "day", "shift", "site", "availability_pct", "oee_pct", "recovery_pct"),
    one_of("shift_kpis", "shift", SHIFTS),
    one_of("shift_kpis", "site", SITES),
    one_of("shift_kpis", "risk_level", RISK_LEVELS),
    *between("shift_kpis", 0, 100, "availability_pct", "oee_pct", "recovery_pct"),
]

FEATURES = [
    key("failure_features", "truck", "day", "shift"),
    *present("failure_features", "truck", "day", "oper_h", "oper_h_total", "shifts_since_failure", "failed"),
    *between("failure_features", 0, 12, "oper_h"),
    *between("failure_features", 0, None, "oper_h_total", "shifts_since_failure"),
    *between("failure_features", 0, 1, "availability", "availability_7"),
    one_of("failure_features", "failed", [0, 1]),
    one_of("failure_features", "fails_next_shift", [0, 1]),
    key("process_features", "site", "ts"),
    key("process_features", "record_id"),
    *present("process_features", "record_id", "ts", "feed", "target_conc"),
    *between("process_features", 0, 100, "feed", "target_conc", "target_recovery"),
    *between("process_features", 0, 14, "ph", "ph_6"),
    *between("process_features", 0, None, "dose"),
]

YEARBOOK = [
    *present("stg_yearbook", "tab", "yr"),
    one_of("stg_yearbook", "tab", list(UNITS)),
    *between("stg_yearbook", 2000, 2025, "yr"),
    key("yb_producers", "yr", "mine"),
    *present("yb_producers", "output_kt"),
    *between("yb_producers", 0, 2000, "output_kt"),
    one_of("yb_producers", "owner", ["Codelco", "Privada"]),
    key("yb_totals", "yr"),
    *present("yb_totals", "yr", "total_kt"),
    *between("yb_totals", 4000, 7000, "total_kt"),
    key("yb_grades", "yr"),
    *present("yb_grades", "yr", "mill_grade"),
    *between("yb_grades", 0.3, 2.0, "mill_grade"),
    key("yb_indices", "yr", "entity"),
    *between("yb_indices", 1, 2000, "cost_index"),
    key("yb_energy", "yr", "process", "source"),
    *between("yb_energy", 0, None, "energy_tj"),
    key("yb_intensity", "yr", "process"),
    key("yb_water", "yr", "process"),
    *between("yb_water", 0, 5, "national_m3_t"),
    key("yb_prices", "yr", "metal", "exchange"),
    *between("yb_prices", 1, None, "mean_usc_lb"),
    key("dim_producer", "mine"),
    *present("dim_producer", "mine"),
    key("producer_year", "yr", "mine"),
    *present("producer_year", "mine"),
    Check("producer_year", "relationships", ("mine",), {"to": "dim_producer", "field": "mine", "where": "mine <> 'Otros'"}),
    *between("producer_year", 0, 40, "share_pct"),
    key("sector_year", "yr"),
    *present("sector_year", "yr", "output_kt", "price_usc_lb"),
    *between("sector_year", 50, 700, "price_usc_lb"),
]

PRICES = [
    key("stg_price", "day", "bus"),
    *present("stg_price", "bus", "price_mean"),
    one_of("stg_price", "bus", NORTH_BUSES + SOUTH_BUSES),
    *between("stg_price", 0, 1000, "price_mean"),
    key("price_monthly", "month", "bus"),
    *between("price_monthly", 1, 31, "days"),
    key("energy_cost_year", "yr", "bus"),
    *present("energy_cost_year", "cost_usd_per_t"),
    *between("energy_cost_year", 0, 2000, "cost_usd_per_t"),
]

SUITE = OPERATIONS + FEATURES + YEARBOOK + PRICES

CONTRACT = {
    "stg_telemetry": ["record_id", "site", "ts", "feed"],
    "stg_maintenance": ["record_id", "truck", "day", "shift", "oper_h"],
    "stg_safety": ["incident_id", "site", "day", "sev"],
    "equipment_performance": ["truck", "day", "shift", "availability", "performance"],
    "shift_kpis": ["day", "shift", "site", "availability_pct", "oee_pct", "recovery_pct", "risk_level"],
    "failure_features": [
        "truck", "day", "shift", "availability_7", "shifts_since_failure", "failed", "fails_next_shift"
    ],
    "process_features": ["site", "ts", "feed", "dose_6", "target_conc", "target_recovery"],
    "stg_yearbook": ["tab", "label", "yr", "value", "unit"],
    "producer_year": ["yr", "mine", "owner", "output_kt", "share_pct"],
    "stg_price": ["day", "bus", "price_mean", "price_solar"],
    "price_monthly": ["month", "bus", "price_mean", "night_solar_gap"],
    "energy_cost_year": ["yr", "bus", "cost_musd", "cost_usd_per_t"],
    "sector_year": [
        "yr", "output_kt", "mill_grade", "mill_electricity_tj", "mill_kwh_per_t", "mill_water_m3_t", "cost_index",
        "price_usc_lb",
    ],
    "dim_producer": ["mine", "owner", "first_yr", "last_yr"],
}


def negative_hours(performance: DataFrame) -> DataFrame:
    """Truck shifts with negative operated hours."""
    return performance.where(F.col("oper_h") < 0).select("truck", "day", "shift", "oper_h")


def recovery_out_of_bounds(kpis: DataFrame) -> DataFrame:
    """Shifts whose recovery is known but not a percentage."""
    out = kpis.where((F.col("recovery_pct") < 0) | (F.col("recovery_pct") > 100))
    return out.select("day", "shift", "site", "recovery_pct")


def energy_gaps(energy: DataFrame, strict: bool = False) -> DataFrame:
    """(yr, source) where the processes do not add up to national use within 1%."""
    total = F.col("process") == "Total"
    parts = energy.where(~total).groupBy("yr", "source").agg(F.sum("energy_tj").alias("part_sum"))
    published = energy.where(total).select("yr", "source", F.col("energy_tj").alias("published"))
    return reconcile(parts, published, ["yr", "source"], relative=0.01, strict=strict)


def output_gaps(mines: DataFrame, totals: DataFrame, strict: bool = False) -> DataFrame:
    """(yr, owner) where mines do not add up to their group, or groups to the nation, within 0.5 kt."""
    parts = mines.groupBy("yr", "owner").agg(F.sum("output_kt").alias("part_sum"))
    groups = totals.select(
        "yr",
        F.inline(
            F.array(
                F.struct(F.lit("Codelco").alias("owner"), F.col("state_kt").alias("published")),
                F.struct(F.lit("Privada").alias("owner"), F.col("private_kt").alias("published")),
            )
        ),
    )
    of_groups = reconcile(parts, groups, ["yr", "owner"], absolute=0.5, strict=strict)
    both = F.col("state_kt") + F.col("private_kt")
    off = F.abs(both - F.col("total_kt")) > 0.5
    if strict:
        off = F.coalesce(off, F.lit(True))
    national = totals.where(off).select(
        "yr", F.lit("Total").alias("owner"), both.alias("part_sum"), F.col("total_kt").alias("published")
    )
    return of_groups.unionByName(national)


def telemetry_breaks(telemetry: DataFrame) -> DataFrame:
    """Plant rows whose grades are not conc > feed > tail, or without positive tonnage."""
    sound = (F.col("feed") > F.col("tail")) & (F.col("conc") > F.col("feed")) & (F.col("tons") > 0)
    return telemetry.where(~F.coalesce(sound, F.lit(False))).select("record_id", "feed", "conc", "tail", "tons")


def maintenance_breaks(maintenance: DataFrame) -> DataFrame:
    """Truck shifts with negative operated hours, or more hours used than scheduled."""
    used = F.col("oper_h") + F.col("maint_h") + F.col("fail_h")
    sound = (F.col("oper_h") >= 0) & (used <= F.col("sched_h") + 1e-6)
    broken = maintenance.where(~F.coalesce(sound, F.lit(False)))
    return broken.select("truck", "day", "shift", "sched_h", used.alias("used_h"))
