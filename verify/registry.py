"""The registered queries: each operator and table of the warehouse over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lodeworks import names, schemas
from lodeworks.functions import exact
from lodeworks.functions import labels as lab
from lodeworks.functions import numeric as num
from lodeworks.functions import text
from lodeworks.operators import distinct, quality, sheets
from lodeworks.plans import checks, features, operations, prices, reports, staging, warehouse, yearbook
from lodeworks.session import scratch_folder
from lodeworks.sources import tables as files
from lodeworks.sources import versions
from verify.fixtures import sheet_rows, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Years that the derived yearbook covers well; the defaults of the reports are for the real one.
YEARS = (1996, 2001)
REPORT_YEAR = 1999
SHEET_BLOCK = 1_000
SHEET_UNITS = {"ledger-0": "kt", "sheet-1": "%", "sheet-2": "TJ"}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: a mean of numbers that are not exact in binary depends on the order of its sum."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: num.round_half_up(F.col(c), digits) for c in doubles})


def six_digits(df: DataFrame, column: str) -> DataFrame:
    """A deviation cut to six digits at a point where no exact value can lie.

    The deviation of multiples of 1/1024 is itself often such a multiple, which may be an exact half at the
    seventh digit; the engines' last bits would then decide how it is rounded.
    """
    return df.withColumn(column, F.floor(F.col(column) * 1e6 + 0.123456) / 1e6)


class Inputs:
    """The warehouse's tables over one folder of driver data, each built when it is asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._yearbook: DataFrame | None = None
        self._performance: DataFrame | None = None

    def fx(self, name: str) -> DataFrame:
        return table(self.spark, self.sf, name)

    def telemetry(self) -> DataFrame:
        return staging.telemetry(self.fx("fx_telemetry"))

    def shift_telemetry(self) -> DataFrame:
        return self.fx("fx_telemetry_shift").where(F.col("tons").isNotNull())

    def maintenance(self) -> DataFrame:
        return staging.maintenance(self.fx("fx_maintenance"))

    def safety(self) -> DataFrame:
        return staging.safety(self.fx("fx_safety"))

    def performance(self) -> DataFrame:
        return operations.equipment_performance(self.maintenance(), self.fx("fx_equipment"))

    def kpis(self) -> DataFrame:
        return operations.shift_kpis(self.performance(), self.shift_telemetry(), self.safety())

    def written_performance(self) -> DataFrame:
        """Truck shifts as a build leaves them: features read them more than once."""
        if self._performance is None:
            self._performance = files.write_table(self.performance(), scratch_folder(self.spark, "equipment_performance"))
        return self._performance

    def failure(self) -> DataFrame:
        return features.failure_features(self.written_performance())

    def process(self) -> DataFrame:
        return features.process_features(self.telemetry())

    def daily_price(self) -> DataFrame:
        return prices.daily_summary(self.fx("fx_hourly"))

    def price(self) -> DataFrame:
        return prices.staged(self.fx("fx_daily"))

    def yearbook(self) -> DataFrame:
        return yearbook.staged(self.fx("fx_yearbook"))

    def topic(self) -> DataFrame:
        """The whole staged yearbook, written by tab; a topic's own filter chooses its files."""
        if self._yearbook is None:
            self._yearbook = self.written_yearbook()
        return self._yearbook

    def producers(self) -> DataFrame:
        return yearbook.producers(self.topic())

    def totals(self) -> DataFrame:
        return yearbook.totals(self.topic())

    def energy(self) -> DataFrame:
        return yearbook.energy(self.topic())

    def producer_year(self) -> DataFrame:
        stage = self.topic()
        return yearbook.producer_year(yearbook.producers(stage), yearbook.totals(stage), yearbook.indices(stage))

    def written_yearbook(self) -> DataFrame:
        """The staged yearbook as a build leaves it: files split by tab."""
        return files.write_table(self.yearbook(), scratch_folder(self.spark, "stg_yearbook"), ["tab"])

    def sector(self) -> DataFrame:
        return yearbook.sector_year(self.topic())

    def energy_cost(self) -> DataFrame:
        return prices.energy_cost_year(self.price(), self.energy(), self.totals())

    def sheets(self) -> DataFrame:
        """The sheet rows as a stored table: reading sheets passes over them more than once."""
        return files.write_table(sheet_rows(self.spark, self.sf), scratch_folder(self.spark, "sheet-rows"))


# -- sources and sinks ----------------------------------------------------------------------------


@query
def src_csv_roundtrip(spark, sf):
    """Daily prices through a typed CSV: dates, nulls, accents and counts survive."""
    folder = scratch_folder(spark, "daily-price")
    files.write_csv(Inputs(spark, sf).daily_price().select(*schemas.DAILY_PRICE.names), folder)
    return files.read_csv(spark, folder, schemas.DAILY_PRICE)


@query
def dim_equipment(spark, sf):
    """The equipment dimension through its header CSV."""
    folder = scratch_folder(spark, "equipment")
    files.write_csv(Inputs(spark, sf).fx("fx_equipment").select(*schemas.EQUIPMENT.names), folder)
    return files.read_csv(spark, folder, schemas.EQUIPMENT)


@query
def sink_roundtrip_counts(spark, sf):
    """Row counts of the raw tables after they are written and read back."""
    x = Inputs(spark, sf)
    folder = scratch_folder(spark, "raw")
    stored = {
        "raw_telemetry": "fx_telemetry", "raw_maintenance": "fx_maintenance", "raw_safety": "fx_safety",
        "raw_yearbook": "fx_yearbook", "equipment": "fx_equipment",
    }
    written = {
        name: files.write_table(x.fx(fx), f"{folder}/{name}", ["tab"] if name == "raw_yearbook" else None)
        for name, fx in stored.items()
    }
    return files.row_counts(written)


@query
def src_published_types(spark, sf):
    """The raw yearbook as it is published: its own column names, 64-bit whole numbers."""
    stored = Inputs(spark, sf).fx("fx_yearbook").select(*schemas.YEARBOOK.names)
    wide = stored.withColumns({c: F.col(c).cast("bigint") for c in ("ord", "lvl", "yr")})
    path = scratch_folder(spark, "published-yearbook")
    files.write_table(names.published(wide, "raw_yearbook"), path)
    return files.read_raw(spark, path, "raw_yearbook")


@query
def sink_versions(spark, sf):
    """A table that is replaced by a part of itself: rows of each version, and of what readers get by then."""
    path = f"{scratch_folder(spark, 'published')}"
    first = versions.publish(Inputs(spark, sf).daily_price(), path, sort_by=["day", "bus"])
    versions.publish(versions.current(spark, path).where(F.col("hours") > 1), path, partition_by=["bus"])
    read = [("first", first), ("again", versions.current(spark, path, 1)), ("newest", versions.current(spark, path))]
    count = [df.agg(F.count("*").alias("n_rows"), F.sum("hours").alias("hours")).select(F.lit(n).alias("version"), "n_rows", "hours") for n, df in read]
    return reduce(DataFrame.unionByName, count)


@query
def sink_clustered_filter(spark, sf):
    """Truck shifts of one site, two trucks and a stretch of days, out of zones of a published table."""
    path = scratch_folder(spark, "truck-shifts")
    versions.publish(Inputs(spark, sf).performance(), path, cluster_by=["day", "site", "truck"])
    days = {"day": ("1995-01-01", "1996-06-30")}
    return versions.filtered(spark, path, days, {"site": ["Andina"]})


# -- staging ----------------------------------------------------------------------------------------


@query
def stg_telemetry(spark, sf):
    return Inputs(spark, sf).telemetry()


@query
def stg_maintenance(spark, sf):
    return Inputs(spark, sf).maintenance()


@query
def stg_safety(spark, sf):
    return Inputs(spark, sf).safety()


@query
def px_stage(spark, sf):
    return Inputs(spark, sf).price()


@query
def yb_stage(spark, sf):
    return Inputs(spark, sf).yearbook()


@query
def yb_producers(spark, sf):
    return Inputs(spark, sf).producers()


@query
def yb_totals(spark, sf):
    return Inputs(spark, sf).totals()


@query
def yb_pivot_grade(spark, sf):
    return yearbook.grades(Inputs(spark, sf).topic())


@query
def yb_pivot_index(spark, sf):
    return yearbook.indices(Inputs(spark, sf).topic())


@query
def yb_energy(spark, sf):
    return Inputs(spark, sf).energy()


@query
def yb_pivot_intensity(spark, sf):
    return yearbook.intensity(Inputs(spark, sf).topic())


@query
def yb_section_fill(spark, sf):
    """Water use by section; blocks of four rows, so that sections are carried across blocks."""
    return yearbook.water(Inputs(spark, sf).topic(), block_rows=4)


@query
def yb_pivot_price(spark, sf):
    return yearbook.metal_prices(Inputs(spark, sf).topic())


# -- scalar functions -------------------------------------------------------------------------------


@query
def fn_safe_divide(spark, sf):
    m = Inputs(spark, sf).fx("fx_maintenance")
    return m.select("record_id", num.safe_divide(F.col("oper_h"), F.col("sched_h")).alias("ratio"))


@query
def fn_recovery(spark, sf):
    t = Inputs(spark, sf).fx("fx_telemetry")
    return t.select("record_id", num.recovery(F.col("feed"), F.col("conc"), F.col("tail")).alias("recovery_pct"))


@query
def shift_of_hour(spark, sf):
    t = Inputs(spark, sf).fx("fx_telemetry")
    return t.groupBy(F.hour("ts").alias("hr"), lab.shift_of_hour(F.col("ts")).alias("shift")).agg(F.count("*").alias("n"))


@query
def risk_score(spark, sf):
    s = Inputs(spark, sf).safety()
    return s.select("incident_id", "sev", lab.risk_points(F.col("sev")).cast("bigint").alias("points"))


@query
def risk_band(spark, sf):
    """Shifts per summed score with the score's band."""
    by_shift = operations.safety_by_shift(Inputs(spark, sf).safety())
    banded = by_shift.withColumn("band", lab.risk_band(F.col("risk_score")))
    return banded.groupBy("risk_score", "band").agg(F.count("*").alias("n"))


@query
def yb_clean_label(spark, sf):
    rows = Inputs(spark, sf).fx("fx_sheet").where(F.col("label").isNotNull())
    return rows.select("sheet", "row_num", text.clean_label(F.col("label")).alias("label"))


@query
def yb_indent(spark, sf):
    rows = Inputs(spark, sf).fx("fx_sheet").where(F.col("label").isNotNull())
    return rows.select("sheet", "row_num", text.indent(F.col("label")).alias("indent"))


@query
def yb_parse_value(spark, sf):
    rows = Inputs(spark, sf).fx("fx_sheet")
    return rows.select("sheet", "row_num", *[text.parse_number(F.col(c)).alias(c) for c in ("c1", "c2", "c3")])


# -- operations ---------------------------------------------------------------------------------------


@query
def equipment_performance(spark, sf):
    return Inputs(spark, sf).performance()


@query
def equipment_performance_salted(spark, sf):
    """The same join with every truck dealt into parts."""
    x = Inputs(spark, sf)
    dim = x.fx("fx_equipment").select("truck", "model", "cap_t")
    joined = operations.join_dimension(x.maintenance(), dim, "truck", ["day", "shift"], parts=1000)
    return joined.groupBy("model").agg(F.count("*").alias("n"), F.sum("cycles").alias("cycles"), F.max("cap_t").alias("cap_t"))


@query
def agg_trucks_by_any_grain(spark, sf):
    """Trucks by shift, day and site from one table of bitmaps."""
    performance = Inputs(spark, sf).performance()
    codes = distinct.coded(performance, "truck")
    parts = distinct.partials(performance, ["day", "shift", "site"], "truck", codes, ["day", "shift"])
    parts = files.write_table(parts, scratch_folder(spark, "truck-bitmaps"))
    grains = {"shift": ["day", "shift", "site"], "day": ["day"], "site": ["site"], "all": []}
    every = [distinct.counts(parts, keys, "n_trucks").withColumn("grain", F.lit(g)) for g, keys in grains.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), every)


@query
def agg_exact_grades(spark, sf):
    """Tonnage-weighted grades of numbers that are not exact in binary, per site and month: no digit is rounded off."""
    rows = Inputs(spark, sf).telemetry().select("site", F.trunc("day", "month").alias("month"), (F.col("tons") / 3).alias("t"), (F.col("feed") / 7).alias("g"))
    spread = rows.repartition(7, F.xxhash64("t", "g"))  # sums are the same however rows are dealt
    sums = spread.groupBy("site", "month").agg(exact.total(F.col("t") * F.col("g")).alias("metal"), exact.total(F.col("t")).alias("tons"), exact.mean(F.col("g")).alias("grade"))
    direct = rows.groupBy("site", "month").agg(exact.total(F.col("t") * F.col("g")).alias("m2"), exact.total(F.col("t")).alias("t2"), exact.mean(F.col("g")).alias("g2"))
    same = (F.col("metal") == F.col("m2")) & (F.col("tons") == F.col("t2")) & (F.col("grade") == F.col("g2"))
    return rounded(sums.join(direct, ["site", "month"]).select("site", "month", "metal", "tons", "grade", same.alias("same")), 9)


@query
def dq_capped_unknown(spark, sf):
    """Truck shifts whose performance is the cap of an unknown rate."""
    return operations.capped_unknown(Inputs(spark, sf).performance()).groupBy("site").agg(F.count("*").alias("n"))


@query
def agg_equipment(spark, sf):
    return operations.fleet_by_shift(Inputs(spark, sf).performance())


@query
def agg_telemetry(spark, sf):
    return operations.plant_by_shift(Inputs(spark, sf).shift_telemetry())


@query
def agg_safety(spark, sf):
    return operations.safety_by_shift(Inputs(spark, sf).safety())


@query
def shift_kpis(spark, sf):
    return Inputs(spark, sf).kpis()


# -- feature tables -----------------------------------------------------------------------------------


@query
def ml_failure_features(spark, sf):
    return Inputs(spark, sf).failure()


@query
def ml_failure_features_blocked(spark, sf):
    """The same table with every truck's history cut into years."""
    return features.failure_features(Inputs(spark, sf).written_performance(), block_months=1)


@query
def ml_failure_features_ranked(spark, sf):
    """Stretches of ten years with more rows of a truck than a task is to take are cut by rank."""
    return features.failure_features(Inputs(spark, sf).written_performance(), block_months=120, stretch_rows=50)


@query
def ml_failure_streak(spark, sf):
    return features.failure_streak(Inputs(spark, sf).written_performance())


@query
def ml_process_features(spark, sf):
    return six_digits(Inputs(spark, sf).process(), "feed_sd_6")


@query
def ml_process_features_bucketed(spark, sf):
    """The same table cut into small blocks of minutes, many of them empty or with fewer rows than a frame."""
    return six_digits(features.process_features(Inputs(spark, sf).telemetry(), block_seconds=900), "feed_sd_6")


@query
def ml_label_coverage(spark, sf):
    x = Inputs(spark, sf)
    return features.label_coverage(x.failure(), x.process())


@query
def ml_training_rows(spark, sf):
    rows = features.training_rows(Inputs(spark, sf).failure())
    return rows.select("truck", "day", "shift", "oper_h_total", "fail_h_7", "shifts_since_failure", "fails_next_shift")


# -- prices -------------------------------------------------------------------------------------------


@query
def px_daily_summary(spark, sf):
    return Inputs(spark, sf).daily_price()


@query
def px_monthly(spark, sf):
    return prices.monthly(Inputs(spark, sf).price())


@query
def px_annual_gated(spark, sf):
    return rounded(prices.annual(Inputs(spark, sf).price()))


@query
def energy_cost_year(spark, sf):
    return Inputs(spark, sf).energy_cost()


# -- yearbook marts -----------------------------------------------------------------------------------


@query
def dim_producer(spark, sf):
    return yearbook.dim_producer(Inputs(spark, sf).producers())


@query
def producer_year(spark, sf):
    return Inputs(spark, sf).producer_year()


@query
def sector_year(spark, sf):
    return Inputs(spark, sf).sector()


# -- wide sheets --------------------------------------------------------------------------------------


@query
def yb_header(spark, sf):
    found = sheets.headers(Inputs(spark, sf).sheets())
    years = F.array_join(F.transform("years", lambda y: y["yr"].cast("string")), ",")
    return found.select("sheet", "header_row", years.alias("years"))


@query
def yb_bad_sheets(spark, sf):
    return sheets.bad_sheets(Inputs(spark, sf).sheets())


@query
def yb_body(spark, sf):
    return sheets.body(Inputs(spark, sf).sheets(), SHEET_BLOCK)


@query
def yb_hierarchy(spark, sf):
    return sheets.hierarchy(Inputs(spark, sf).sheets(), SHEET_BLOCK).select("sheet", "ord", "label", "parent", "grp", "lvl")


@query
def yb_unpivot(spark, sf):
    return sheets.unpivot(Inputs(spark, sf).sheets(), SHEET_UNITS, SHEET_BLOCK)


@query
def yb_drop_title_rows(spark, sf):
    return sheets.parse_sheets(Inputs(spark, sf).sheets(), SHEET_UNITS, SHEET_BLOCK)


# -- data quality -------------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    return quality.not_null(Inputs(spark, sf).fx("fx_telemetry"), "tons").select("record_id", "site", "tons")


@query
def dq_unique(spark, sf):
    return quality.unique(Inputs(spark, sf).safety(), "truck")


@query
def dq_unique_combo(spark, sf):
    return quality.unique_combination(Inputs(spark, sf).safety(), ["day", "shift", "site", "truck"])


@query
def dq_accepted_values(spark, sf):
    return quality.accepted_values(Inputs(spark, sf).safety(), "sev", ["LEVE", "GRAVE", "FATAL"]).select("incident_id", "sev")


@query
def dq_accepted_range(spark, sf):
    hours = Inputs(spark, sf).fx("fx_maintenance")
    return quality.accepted_range(hours, "oper_h", 0, 4).select("truck", "day", "shift", "oper_h")


@query
def dq_relationships(spark, sf):
    x = Inputs(spark, sf)
    return quality.relationships(x.maintenance(), x.fx("fx_equipment"), "truck", "truck", F.col("cycles") > 10)


@query
def dq_negative(spark, sf):
    return quality.negative(Inputs(spark, sf).fx("fx_hourly"), "price")


@query
def dq_negative_hours(spark, sf):
    """Hours from which five are taken, so that short shifts turn negative."""
    return checks.negative_hours(Inputs(spark, sf).performance().withColumn("oper_h", F.col("oper_h") - 5))


@query
def dq_bounds(spark, sf):
    return checks.recovery_out_of_bounds(Inputs(spark, sf).kpis())


@query
def dq_kpi_grain(spark, sf):
    """Grain of a table in which the shifts with incidents are there twice."""
    kpis = Inputs(spark, sf).kpis()
    return quality.duplicates(kpis.unionByName(kpis.where("incidents > 0")), operations.GRAIN)


@query
def dq_reconcile_rel(spark, sf):
    return checks.energy_gaps(Inputs(spark, sf).energy())


@query
def dq_reconcile_abs(spark, sf):
    x = Inputs(spark, sf)
    return checks.output_gaps(x.producers(), x.totals())


@query
def dq_row_invariants(spark, sf):
    x = Inputs(spark, sf)
    plant = checks.telemetry_breaks(x.fx("fx_telemetry")).select(F.lit("telemetry").alias("tbl"), F.col("record_id").cast("string").alias("row_key"))
    fleet = checks.maintenance_breaks(x.maintenance()).select(
        F.lit("maintenance").alias("tbl"), F.concat_ws("|", "truck", F.col("day").cast("string"), "shift").alias("row_key")
    )
    return plant.unionByName(fleet)


@query
def dq_coverage(spark, sf):
    return prices.coverage(Inputs(spark, sf).daily_price())


def _suite_tables(x: Inputs) -> dict[str, DataFrame]:
    """The operational tables, the marts and the grouped truck shifts written: a suite reads each table three times."""
    folder = scratch_folder(x.spark, "operations")
    maintenance = files.write_table(x.maintenance(), f"{folder}/stg_maintenance")
    performance = operations.equipment_performance(maintenance, x.fx("fx_equipment"))
    performance = files.write_table(performance, f"{folder}/equipment_performance")
    kpis = operations.shift_kpis(performance, x.shift_telemetry(), x.safety())
    return {
        "stg_telemetry": x.telemetry(),
        "stg_maintenance": maintenance,
        "stg_safety": x.safety(),
        "equipment": x.fx("fx_equipment"),
        "equipment_performance": performance,
        "shift_kpis": files.write_table(kpis, f"{folder}/shift_kpis"),
    }


@query
def dq_suite(spark, sf):
    """All declared tests of the operational tables."""
    return quality.run_suite(_suite_tables(Inputs(spark, sf)), checks.OPERATIONS)


@query
def dq_suite_features(spark, sf):
    x = Inputs(spark, sf)
    folder = scratch_folder(spark, "features")
    found = {"failure_features": x.failure(), "process_features": x.process()}
    return quality.run_suite({name: files.write_table(df, f"{folder}/{name}") for name, df in found.items()}, checks.FEATURES)


@query
def dq_suite_prices(spark, sf):
    x = Inputs(spark, sf)
    found = {"stg_price": x.price(), "price_monthly": prices.monthly(x.price()), "energy_cost_year": x.energy_cost()}
    return quality.run_suite(found, checks.PRICES)


@query
def dq_suite_yearbook(spark, sf):
    """All declared tests of the yearbook, over tables that a build has written."""
    x = Inputs(spark, sf)
    stage = x.written_yearbook()
    mines, published, index = yearbook.producers(stage), yearbook.totals(stage), yearbook.indices(stage)
    found = {
        "stg_yearbook": stage,
        "yb_producers": mines,
        "yb_totals": published,
        "yb_grades": yearbook.grades(stage),
        "yb_indices": index,
        "yb_energy": yearbook.energy(stage),
        "yb_intensity": yearbook.intensity(stage),
        "yb_water": yearbook.water(stage),
        "yb_prices": yearbook.metal_prices(stage),
        "dim_producer": yearbook.dim_producer(mines),
        "producer_year": yearbook.producer_year(mines, published, index),
        "sector_year": yearbook.sector_year(stage),
    }
    return quality.run_suite(found, checks.YEARBOOK)


@query
def schema_contract(spark, sf):
    """Rows and missing columns per table of a contract with one column that does not exist."""
    contract = {
        "stg_telemetry": checks.CONTRACT["stg_telemetry"],
        "stg_maintenance": checks.CONTRACT["stg_maintenance"],
        "stg_safety": checks.CONTRACT["stg_safety"],
        "equipment": ["truck", "tyre_size"],
        "shift_kpis": checks.CONTRACT["shift_kpis"],
    }
    return quality.contract_report(_suite_tables(Inputs(spark, sf)), contract)


@query
def warehouse_counts(spark, sf):
    """Row counts of every table after a full build with written marts."""
    x = Inputs(spark, sf)
    stored = lambda name: files.write_table(x.fx(name), scratch_folder(spark, name))
    # the raw tables that are aggregates here are stored, as raw tables are in use: a build reads them more than once
    raw = {
        "raw_telemetry": x.fx("fx_telemetry"), "raw_maintenance": stored("fx_maintenance"), "raw_safety": x.fx("fx_safety"),
        "equipment": x.fx("fx_equipment"), "raw_yearbook": x.fx("fx_yearbook"), "raw_daily_price": stored("fx_daily"),
    }
    return files.row_counts(warehouse.build(raw, scratch_folder(spark, "warehouse")))


# -- reports ------------------------------------------------------------------------------------------


@query
def rpt_filter(spark, sf):
    chosen = reports.filter_user(Inputs(spark, sf).kpis(), ["Andina", "El Teniente"], ["Día"], "1996-01-01", "1999-12-31")
    return reports.detail(chosen)


@query
def rpt_filter_domain(spark, sf):
    return reports.filter_domain(Inputs(spark, sf).kpis())


@query
def rpt_kpi_cards(spark, sf):
    return rounded(reports.kpi_cards(Inputs(spark, sf).kpis()))


@query
def rpt_daily_trend(spark, sf):
    return rounded(reports.daily_trend(Inputs(spark, sf).kpis()))


@query
def rpt_clean_vs_incident(spark, sf):
    return rounded(reports.clean_vs_incident(Inputs(spark, sf).kpis()))


@query
def rpt_histogram(spark, sf):
    return rounded(reports.kpi_histograms(Inputs(spark, sf).kpis()))


@query
def rpt_histogram_by_incident(spark, sf):
    return rounded(reports.oee_histogram_by_incident(Inputs(spark, sf).kpis()))


@query
def rpt_kpi_stats(spark, sf):
    return rounded(reports.kpi_stats(Inputs(spark, sf).kpis()))


@query
def rpt_risk_by_score(spark, sf):
    return rounded(reports.risk_by_score(Inputs(spark, sf).kpis()))


@query
def rpt_risk_stats(spark, sf):
    return reports.risk_stats(Inputs(spark, sf).kpis())


@query
def rpt_risk_distribution(spark, sf):
    return rounded(reports.risk_distribution(Inputs(spark, sf).kpis()))


@query
def rpt_high_risk_shifts(spark, sf):
    return reports.high_risk_shifts(Inputs(spark, sf).kpis())


@query
def rpt_truck_summary(spark, sf):
    return reports.truck_summary(Inputs(spark, sf).performance())


@query
def rpt_base_index(spark, sf):
    return rounded(reports.sector_index(Inputs(spark, sf).sector(), *YEARS))


@query
def rpt_index_last(spark, sf):
    return rounded(reports.sector_index_last(Inputs(spark, sf).sector(), *YEARS))


@query
def rpt_implied_tonnage(spark, sf):
    return rounded(reports.implied_ore(Inputs(spark, sf).sector(), *YEARS), 9)


@query
def rpt_top_producers(spark, sf):
    return reports.top_producers(Inputs(spark, sf).producer_year(), REPORT_YEAR)


@query
def rpt_cost_selected(spark, sf):
    return reports.cost_selected(Inputs(spark, sf).energy_cost())


@query
def rpt_zone_monthly(spark, sf):
    return rounded(reports.zone_monthly(prices.monthly(Inputs(spark, sf).price())))


@query
def rpt_preview(spark, sf):
    """The first ten shifts, as a preview of the table."""
    return reports.top_rows(Inputs(spark, sf).kpis(), ["day", "site", "shift"])
