from __future__ import annotations

from datetime import date, timedelta

import pytest

from lodeworks import schemas
from lodeworks.plans import checks, prices, reports, yearbook


def book(spark, rows):
    """rows: (tab, ord, lvl, label, parent, grp, yr, value)"""
    return yearbook.staged(spark.createDataFrame([(*r, None, None) for r in rows], schemas.YEARBOOK))


def output_rows(yr, state=100.0, private=200.0, total=300.0, mines=((1, "A", "CODELCO", 100.0), (2, "B", "OTROS PRODUCTORES", 200.0))):
    rows = [("2.3", o, 1, m, g, g, yr, v) for o, m, g, v in mines]
    rows += [("2.3", 0, 0, "CODELCO", None, "CODELCO", yr, state), ("2.3", 9, 0, "OTROS PRODUCTORES", None, "OTROS PRODUCTORES", yr, private)]
    return rows + [("2.3", 10, 0, "TOTAL PRODUCCIÓN", None, "TOTAL PRODUCCIÓN", yr, total)]


def test_zero_is_unpublished_only_in_the_index_tabs(spark):
    got = book(spark, [(t, 1, 0, "x", None, "x", 2020, 0.0) for t in ("2.4", "2.5", "2.6")]).collect()
    assert {r["tab"]: r["value"] for r in got} == {"2.4": 0.0, "2.5": None, "2.6": None}


def test_section_of_a_national_row_comes_from_the_rows_before_it(spark):
    national = "TOTAL NACIONAL"
    rows = [
        ("6.3", 1, 0, "CONSUMO UNITARIO (m3/t)", None, "CONSUMO UNITARIO (m3/t)", 2020, None),
        ("6.3", 2, 1, national, None, national, 2020, 9.0),  # before any section: dropped
        ("6.3", 3, 0, "CONCENTRACIÓN", None, "CONCENTRACIÓN", 2020, None),
        ("6.3", 4, 1, "Gran Minería del Cobre", "CONCENTRACIÓN", "CONCENTRACIÓN", 2020, 0.5),
        ("6.3", 5, 0, national, None, national, 2020, 0.6),
        ("6.3", 6, 0, "HIDROMETALURGIA", None, "HIDROMETALURGIA", 2020, None),
        ("6.3", 7, 0, national, None, national, 2020, 0.1),
    ]
    got = {r["process"]: r for r in yearbook.water(book(spark, rows)).collect()}
    assert set(got) == {"Concentración", "Hidrometalurgia"}
    assert (got["Concentración"]["large_m3_t"], got["Concentración"]["national_m3_t"]) == (0.5, 0.6)
    assert got["Hidrometalurgia"]["national_m3_t"] == 0.1


def test_reconciliation_faithful_and_strict(spark):
    stage = book(spark, output_rows(2020) + output_rows(2021, total=301.0) + output_rows(2022, state=98.0) + output_rows(2023, total=None))
    mines, totals = yearbook.producers(stage), yearbook.totals(stage)
    faithful = {(r["yr"], r["owner"]) for r in checks.output_gaps(mines, totals).collect()}
    assert faithful == {(2021, "Total"), (2022, "Codelco"), (2022, "Total")}
    strict = {(r["yr"], r["owner"]) for r in checks.output_gaps(mines, totals, strict=True).collect()}
    assert strict == faithful | {(2023, "Total")}


def test_energy_gap_needs_a_total_unless_strict(spark):
    def rows(yr, total):
        out = [("6.5", 1, 1, "Electricidad", p, p, yr, 50.0) for p in ("Concentradora", "Fundición")]
        return out + ([("6.5", 9, 1, "Electricidad", "CONSUMO TOTAL DE ENERGÍA", "x", yr, total)] if total else [])

    energy = yearbook.energy(book(spark, rows(2020, 100.0) + rows(2021, 101.5) + rows(2022, None) + rows(2023, 100.9)))
    assert [r["yr"] for r in checks.energy_gaps(energy).collect()] == [2021]
    assert sorted(r["yr"] for r in checks.energy_gaps(energy, strict=True).collect()) == [2021, 2022]


def test_producer_change_is_since_the_previous_row_and_zero_total_gives_no_share(spark):
    stage = book(spark, output_rows(2010) + output_rows(2015, mines=((1, "A", "CODELCO", 130.0),)) + output_rows(2016, total=0.0))
    rows = yearbook.producer_year(yearbook.producers(stage), yearbook.totals(stage), yearbook.indices(stage)).collect()
    got = {(r["mine"], r["yr"]): r for r in rows}
    assert got["A", 2010]["change_kt"] is None and got["A", 2015]["change_kt"] == 30.0
    assert got["A", 2010]["share_pct"] == 33.333 and got["A", 2016]["share_pct"] is None


def test_mine_that_changes_owner_has_two_rows(spark):
    rows = output_rows(2010) + output_rows(2011, mines=((1, "A", "OTROS PRODUCTORES", 5.0), (2, "Otros", "OTROS PRODUCTORES", 1.0)))
    got = yearbook.dim_producer(yearbook.producers(book(spark, rows))).collect()
    assert sorted((r["mine"], r["owner"]) for r in got) == [("A", "Codelco"), ("A", "Privada"), ("B", "Privada")]


def test_metal_prices_by_exchange(spark):
    rows = [
        ("8.21", 1, 2, "Promedio anual", "Bolsa de Metales de Londres", "COBRE REFINADO", 2020, 280.0),
        ("8.21", 2, 2, "Máximo anual", "Bolsa de Metales de Londres", "COBRE REFINADO", 2020, 350.0),
        ("8.21", 3, 2, "Promedio anual", "Bolsa de Metales de Shanghai", "COBRE REFINADO", 2020, 281.0),
        ("8.21", 4, 2, "Promedio anual", "COMEX", "COBRE REFINADO", 2020, 279.0),
        ("8.21", 5, 2, "Promedio anual", "Plomo", "OTROS", 2020, 80.0),
    ]
    got = {(r["metal"], r["exchange"]): r["mean_usc_lb"] for r in yearbook.metal_prices(book(spark, rows)).collect()}
    assert got == {("Cobre", "LME"): 280.0, ("Cobre", "SHFE"): 281.0, ("Cobre", "COMEX"): 279.0, ("Plomo", "LME"): 80.0}


def hourly(spark, values, bus="Crucero", day=date(2024, 1, 1)):
    return spark.createDataFrame([(day, h, bus, v) for h, v in values], schemas.HOURLY_PRICE)


def test_daily_summary_splits_solar_and_night(spark):
    night, solar = set(range(20, 24)) | set(range(7)), set(range(10, 17))
    values = [(h, 100.0 if h - 1 in night else 0.0 if h - 1 in solar else 50.0) for h in range(1, 25)]
    row = prices.daily_summary(hourly(spark, values)).first()
    assert (row["price_night"], row["price_solar"], row["hours"]) == (100.0, 0.0, 24)
    assert row["price_mean"] == pytest.approx(sum(v for _, v in values) / 24, abs=0.01)


def test_daily_summary_clips_counts_nulls_and_leaves_missing_parts_null(spark):
    row = prices.daily_summary(hourly(spark, [(h, -0.15) for h in range(1, 25)])).first()
    assert row["price_mean"] == 0.0
    row = prices.daily_summary(hourly(spark, [(1, 10.0), (2, None)])).first()
    assert (row["price_mean"], row["hours"], row["price_solar"]) == (10.0, 2, None)


def daily(spark, n, bus="Crucero", start=date(2024, 1, 1)):
    rows = [(start + timedelta(days=i), bus, 50.0, 20.0, 80.0, 24) for i in range(n)]
    return prices.staged(spark.createDataFrame(rows, schemas.DAILY_PRICE))


def test_only_years_with_enough_days_are_valued(spark):
    stage = daily(spark, 366).unionByName(daily(spark, 329, "Quillota")).unionByName(daily(spark, 366, "Tarapaca"))
    assert [r["bus"] for r in prices.annual(stage).collect()] == ["Crucero"]
    energy = spark.createDataFrame(
        [(2024, "Total", "electricidad", 3600.0), (2024, "Concentradora", "electricidad", 1800.0), (2024, "Total", "combustibles", 1.0)],
        "yr int, process string, source string, energy_tj double",
    )
    totals = spark.createDataFrame([(2024, 500.0)], "yr int, total_kt double")
    row = prices.energy_cost_year(stage, energy, totals).first()
    assert (row["electricity_mwh"], row["cost_musd"], row["mill_cost_musd"], row["cost_usd_per_t"]) == (1e6, 50.0, 25.0, 100.0)


def test_monthly_gap_zone_and_days(spark):
    row = prices.monthly(daily(spark, 31)).first()
    assert (row["month"], row["zone"], row["days"], row["night_solar_gap"]) == (date(2024, 1, 1), "Norte", 31, 60.0)
    assert prices.monthly(daily(spark, 3, "Charrua")).first()["zone"] == "Centro-sur"


def test_base_index_and_last_known(spark):
    cols = reports.SECTOR_SERIES
    rows = [(2005 + i, *[float(10 * (i + 1)) if not (c == "cost_index" and i > 1) else None for c in cols]) for i in range(4)]
    sector = spark.createDataFrame(rows, "yr int, " + ", ".join(f"{c} double" for c in cols))
    index = {r["yr"]: r for r in reports.sector_index(sector).collect()}
    assert index[2005]["output_kt"] == 100.0 and index[2008]["output_kt"] == 400.0
    last = {r["series"]: (r["at"], r["value"]) for r in reports.sector_index_last(sector).collect()}
    assert last["cost_index"] == (2006, 200.0) and last["output_kt"] == (2008, 400.0)


def test_top_producers_breaks_ties_by_name(spark):
    rows = [(2025, f"m{i:02d}", "Privada", 10.0 if i < 20 else 99.0, 1.0) for i in range(21)] + [(2025, "Otros", "Privada", 999.0, 1.0)]
    df = spark.createDataFrame(rows, "yr int, mine string, owner string, output_kt double, share_pct double")
    got = [r["mine"] for r in reports.top_producers(df).collect()]
    assert got == ["m20"] + [f"m{i:02d}" for i in range(14)]


def test_truck_summary_drops_trucks_without_model(spark):
    rows = [("T1", "A", "M", 0.5, 0.25, 10.0), ("T1", "A", "M", 0.75, 0.25, 20.0), ("T2", "A", None, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "truck string, site string, model string, availability double, performance double, payload_t double")
    got = reports.truck_summary(df).collect()
    assert [(r["truck"], r["availability_pct"], r["performance_pct"], r["payload_t"]) for r in got] == [("T1", 62.5, 25.0, 30.0)]


def test_risk_distribution_has_all_levels(spark):
    df = spark.createDataFrame([("Bajo",)] * 3 + [("Alto",)], "risk_level string")
    got = {r["risk_level"]: (r["n"], r["share_pct"]) for r in reports.risk_distribution(df).collect()}
    assert got == {"Bajo": (3, 75.0), "Medio": (0, 0.0), "Alto": (1, 25.0), "Crítico": (0, 0.0)}


def test_histogram_matches_equal_width_bins(spark):
    import numpy as np

    from lodeworks.operators.shape import histogram

    rng = np.random.default_rng(5)
    values = np.concatenate([np.round(rng.normal(70, 9, 4000), 2), [40.0, 95.5, 95.5]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    for bins in (1, 7, 36):
        want, edges = np.histogram(values, bins=bins)
        got = sorted(histogram(df, ["x"], bins).collect(), key=lambda r: r["bin"])
        assert [r["n"] for r in got] == want.tolist()
        assert [r["bin_lo"] for r in got] == pytest.approx(edges[:-1].tolist())
    two = df.withColumn("y", -df["x"])
    assert histogram(two, ["x", "y"], 7).where("measure = 'y'").groupBy().sum("n").first()[0] == len(values)
    same = histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), ["x"], 4).collect()
    assert [r["n"] for r in sorted(same, key=lambda r: r["bin"])] == np.histogram([2.0, 2.0], bins=4)[0].tolist()


def test_filter_user(spark):
    df = spark.createDataFrame(
        [("A", "Día", date(2024, 1, d)) for d in (1, 2, 3)] + [("B", "Noche", date(2024, 1, 2))], "site string, shift string, day date"
    )
    assert reports.filter_user(df).count() == 4
    assert reports.filter_user(df, sites=["A"], first_day="2024-01-02", last_day=date(2024, 1, 3)).count() == 2
    assert reports.filter_user(df, shifts=["Noche"], sites=["A"]).count() == 0
    got = {(r["field"], r["choice"]) for r in reports.filter_domain(df).collect()}
    assert ("site", "B") in got and ("first_day", "2024-01-01") in got and len(got) == 6
