"""The copper yearbook: one long table of labelled years, staged by topic, and its marts.

The long table is filtered by tab before anything else; written partitioned by tab, each topic reads its
own files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.labels import classify, max_where, recode, sum_where, zero_as_null
from lodeworks.functions.numeric import mj_to_kwh, pct_share, round_half_up
from lodeworks.operators.blocks import BLOCK_ROWS, fill_forward
from lodeworks.operators.shape import pivot_max
from lodeworks.operators.sheets import parse_sheets

# The yearbook's tabs, their units, and the labels the topics are read by.
UNITS = {
    "2.3": "miles de TM de cobre fino",
    "2.4": "% de cobre en el mineral procesado",
    "2.5": "índice de costo unitario total, base real 2005 = 100",
    "2.6": "índice de productividad laboral, base 2005 = 100",
    "6.3": "m3 de agua por tonelada procesada",
    "6.5": "TJ",
    "6.8": "MJ por tonelada de cobre fino, según producto del proceso",
    "6.9": "MJ por tonelada de material extraído o procesado",
    "8.21": "centavos de dólar por libra",
}
ZERO_IS_UNPUBLISHED = ["2.5", "2.6"]
STATE_GROUP = "CODELCO"
OTHER_MINES = "Otros"
SECTOR_ENTITY = "GMP-10 + Codelco"
TOTAL_LABELS = {"state_kt": "CODELCO", "private_kt": "OTROS PRODUCTORES", "total_kt": "TOTAL PRODUCCIÓN"}
GRADE_LABELS = {
    "mill_grade": "Concentradora",
    "heap_grade": "Lixiviación en pilas",
    "dump_grade": "Lixiviación ROM y/o dump",
    "mean_grade": "Promedio Chile",
}
ENERGY_TOTAL = "CONSUMO TOTAL DE ENERGÍA"
ENERGY_SOURCES = ["Combustibles", "Electricidad"]
PROCESS_NAMES = {
    "Mina Rajo": "Mina rajo",
    "Mina Subterránea": "Mina subterránea",
    "LX-SX-EW": "Lixiviación (SX-EW)",
}
WATER_LABELS = {
    "large_m3_t": "Gran Minería del Cobre",
    "medium_m3_t": "Mediana Minería del Cobre",
    "national_m3_t": "TOTAL NACIONAL",
}
PRICE_LABELS = {"mean_usc_lb": "Promedio anual", "min_usc_lb": "Mínimo anual", "max_usc_lb": "Máximo anual"}
COPPER_GROUP = "COBRE REFINADO"
EXCHANGES = {"Bolsa de Metales de Londres": "LME", "Bolsa de Metales de Shanghai": "SHFE"}


def from_workbook(rows: DataFrame) -> DataFrame:
    """The long table from sheet rows of the published workbook, whose sheet of tab 2.3 is called "Tabla 2.3".

    Other sheets are left out. A tab without its sheet, or a sheet without a header row, is an error.
    """
    sheet = {f"Tabla {tab}": tab for tab in UNITS}
    wanted = rows.where(F.col("sheet").isin(list(sheet)))
    present = {r["sheet"] for r in wanted.select("sheet").distinct().collect()}  # as many as there are tabs, at most
    if len(present) < len(sheet):
        raise ValueError(f"sheets that are missing: {', '.join(sorted(sheet.keys() - present))}")
    long = parse_sheets(wanted, {name: UNITS[tab] for name, tab in sheet.items()}, strict=True)
    return long.withColumn("tab", F.regexp_replace("tab", "^Tabla ", ""))


def staged(raw: DataFrame) -> DataFrame:
    """The long table with its types; a 0 in the index tabs means "not published"."""
    value = F.col("value").cast("double")
    return raw.select(
        F.col("tab").cast("string").alias("tab"),
        F.col("ord").cast("int").alias("ord"),
        F.col("lvl").cast("int").alias("lvl"),
        "label",
        "parent",
        "grp",
        F.col("yr").cast("int").alias("yr"),
        zero_as_null(value, F.col("tab").isin(ZERO_IS_UNPUBLISHED)).alias("value"),
        "unit",
    )


def producers(stage: DataFrame) -> DataFrame:
    """Output per (year, mine) with its ownership; totals and subtotals are left out."""
    mines = stage.where((F.col("tab") == "2.3") & (F.col("lvl") == 1) & F.col("value").isNotNull())
    return mines.select(
        "yr",
        F.col("label").alias("mine"),
        classify(F.col("grp") == STATE_GROUP, "Codelco", "Privada").alias("owner"),
        F.col("value").alias("output_kt"),
    )


def totals(stage: DataFrame) -> DataFrame:
    """Published group and national totals per year."""
    return pivot_max(stage.where((F.col("tab") == "2.3") & (F.col("lvl") == 0)), ["yr"], "label", TOTAL_LABELS, "value")


def grades(stage: DataFrame) -> DataFrame:
    """Mean ore grade per year and process."""
    return pivot_max(stage.where(F.col("tab") == "2.4"), ["yr"], "label", GRADE_LABELS, "value")


def indices(stage: DataFrame) -> DataFrame:
    """Cost and productivity index per (year, entity)."""
    both = stage.where(F.col("tab").isin("2.5", "2.6")).withColumnRenamed("label", "entity")
    return pivot_max(both, ["yr", "entity"], "tab", {"cost_index": "2.5", "productivity_index": "2.6"}, "value")


def energy(stage: DataFrame) -> DataFrame:
    """Energy per (year, process, source) without subtotals; national use is process "Total"."""
    rows = stage.where((F.col("tab") == "6.5") & F.col("label").isin(ENERGY_SOURCES) & F.col("value").isNotNull())
    return rows.select(
        "yr",
        F.when(F.col("parent") == ENERGY_TOTAL, "Total").otherwise(F.col("parent")).alias("process"),
        F.lower("label").alias("source"),
        F.col("value").alias("energy_tj"),
    )


def intensity(stage: DataFrame) -> DataFrame:
    """Energy per tonne of metal and of material, per (year, process)."""
    rows = stage.where(F.col("tab").isin("6.8", "6.9"))
    named = rows.withColumn("process", F.coalesce(recode(F.col("label"), PROCESS_NAMES), F.col("label")))
    return pivot_max(named, ["yr", "process"], "tab", {"mj_per_t_metal": "6.8", "mj_per_t_material": "6.9"}, "value")


def water(stage: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Water use per (year, process).

    National rows carry no indentation, so their own group is wrong: the section comes from the last row
    before them, in sheet order, that is not national.
    """
    rows = stage.where(F.col("tab") == "6.3").select("yr", "ord", "label", "grp", "value")
    own_section = F.when(F.col("label") != WATER_LABELS["national_m3_t"], F.col("grp"))
    filled = fill_forward(rows, ["yr"], "ord", own_section, "section", block_rows)
    used = filled.where(~F.col("section").like("CONSUMO UNITARIO%"))
    process = classify(F.col("section").like("CONCENTRACI%"), "Concentración", "Hidrometalurgia")
    return pivot_max(used.withColumn("process", process), ["yr", "process"], "label", WATER_LABELS, "value")


def metal_prices(stage: DataFrame) -> DataFrame:
    """Yearly price per (year, metal, exchange): copper by exchange, other metals in London."""
    copper = F.col("grp") == COPPER_GROUP
    exchange = (
        F.when(F.col("grp") != COPPER_GROUP, "LME").otherwise(F.coalesce(recode(F.col("parent"), EXCHANGES), F.col("parent")))
    )
    rows = stage.where(F.col("tab") == "8.21").withColumns(
        {"metal": F.when(copper, "Cobre").otherwise(F.col("parent")), "exchange": exchange}
    )
    return pivot_max(rows, ["yr", "metal", "exchange"], "label", PRICE_LABELS, "value")


def dim_producer(mines: DataFrame) -> DataFrame:
    """One row per mine and owner; a mine that changes owner has one row for each."""
    return (
        mines.where(F.col("mine") != OTHER_MINES)
        .groupBy("mine", "owner")
        .agg(F.min("yr").alias("first_yr"), F.max("yr").alias("last_yr"), F.sum("output_kt").alias("output_total_kt"))
    )


def producer_year(mines: DataFrame, published: DataFrame, index: DataFrame) -> DataFrame:
    """Output per (year, mine) with its national share, change since the mine's previous row, and indices.

    A mine has at most one row per year and years come from 1990-2100, so its window is small.
    """
    previous = F.lag("output_kt").over(Window.partitionBy("mine").orderBy("yr"))
    changed = mines.join(published.select("yr", "total_kt"), "yr").withColumn("change_kt", F.col("output_kt") - previous)
    entities = index.withColumnRenamed("entity", "mine")
    return changed.join(entities, ["yr", "mine"], "left").select(
        "yr",
        "mine",
        "owner",
        "output_kt",
        round_half_up(pct_share(F.col("output_kt"), F.col("total_kt")), 3).alias("share_pct"),
        "change_kt",
        "cost_index",
        "productivity_index",
    )


def sector_year(stage: DataFrame) -> DataFrame:
    """One row per year over all topics. All inputs are at year grain before they are joined."""
    tj, process, electric = F.col("energy_tj"), F.col("process"), F.col("source") == "electricidad"
    energy_year = (
        energy(stage)
        .groupBy("yr")
        .agg(
            sum_where(tj, process == "Total").alias("energy_tj"),
            sum_where(tj, (process == "Total") & electric).alias("electricity_tj"),
            sum_where(tj, (process == "Concentradora") & electric).alias("mill_electricity_tj"),
        )
    )
    mill = process == "Concentradora"
    intensity_year = (
        intensity(stage)
        .groupBy("yr")
        .agg(
            max_where(F.col("mj_per_t_material"), mill).alias("mill_mj_per_t"),
            max_where(F.col("mj_per_t_metal"), mill).alias("mill_mj_per_t_metal"),
        )
    )
    water_year = pivot_max(
        water(stage),
        ["yr"],
        "process",
        {"mill_water_m3_t": "Concentración", "leach_water_m3_t": "Hidrometalurgia"},
        "national_m3_t",
    )
    index_year = indices(stage).where(F.col("entity") == SECTOR_ENTITY).drop("entity")
    price_year = metal_prices(stage).where((F.col("metal") == "Cobre") & (F.col("exchange") == "LME"))
    out = totals(stage)
    for topic in (
        grades(stage),
        energy_year,
        intensity_year,
        water_year,
        index_year,
        price_year.select("yr", F.col("mean_usc_lb").alias("price_usc_lb")),
    ):
        out = out.join(topic, "yr", "left")
    return out.select(
        "yr",
        F.col("total_kt").alias("output_kt"),
        F.col("state_kt").alias("state_output_kt"),
        round_half_up(pct_share(F.col("state_kt"), F.col("total_kt")), 2).alias("state_share_pct"),
        "mill_grade",
        "heap_grade",
        "mean_grade",
        "energy_tj",
        "electricity_tj",
        "mill_electricity_tj",
        "mill_mj_per_t",
        round_half_up(mj_to_kwh(F.col("mill_mj_per_t")), 2).alias("mill_kwh_per_t"),
        "mill_mj_per_t_metal",
        "mill_water_m3_t",
        "leach_water_m3_t",
        "cost_index",
        "productivity_index",
        "price_usc_lb",
    )
