from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lodeworks import names, schemas
from lodeworks.plans import checks, prices, warehouse, yearbook
from lodeworks.session import scratch_folder
from lodeworks.sources import tables, versions


def test_csv_keeps_dates_accents_quotes_and_nulls(spark, tmp_path):
    rows = [
        (1, "El Teniente", date(2024, 2, 29), "Día", None, "LEVE", 'caída, "roca"', 0.5),
        (2, None, None, "Noche", "T1", "GRAVE", "x", None),
    ]
    df = spark.createDataFrame(rows, schemas.SAFETY)
    tables.write_csv(df, f"{tmp_path}/csv")
    back = tables.read_csv(spark, f"{tmp_path}/csv", schemas.SAFETY)
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows))


def test_csv_with_a_wrong_header_or_type_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("truck,site,model,cap_t,cyc_h\nT1,A,M,heavy,2\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        tables.read_csv(spark, f"{tmp_path}/bad.csv", schemas.EQUIPMENT).collect()


def test_table_is_replaced(spark, tmp_path):
    first = spark.createDataFrame([("T1", "A", "M", 1.0, 1.0)] * 3, schemas.EQUIPMENT)
    tables.write_table(first, f"{tmp_path}/t")
    back = tables.write_table(first.limit(1), f"{tmp_path}/t")
    assert {r["tbl"]: r["n_rows"] for r in tables.row_counts({"t": back}).collect()} == {"t": 1}


def test_scratch_folders_are_new_and_lie_in_the_shared_folder(spark):
    before = spark.sparkContext.getCheckpointDir()
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert a != b and a.rpartition("/")[0] == b.rpartition("/")[0] and "/x-" in a
    assert spark.sparkContext.getCheckpointDir() == before  # the caller's session stays as it is


def raw_tables(spark):
    telemetry = [
        (i, site, datetime(2024, 1, 1, h), "Día" if 8 <= h < 20 else "Noche", 300.0, 0.7, 30.0, 0.1, 38.0, 10.2)
        for i, (site, h) in enumerate((s, h) for s in ("Andina", "Los Bronces") for h in range(24))
    ]
    maintenance = [
        (i, "Andina", f"T{t}", date(2024, 1, 1), shift, 12.0, 10.0, 1.0, 0.0, 18.0, 1.0)
        for i, (t, shift) in enumerate((t, s) for t in range(3) for s in ("Día", "Noche"))
    ]
    safety = [(1, "Andina", date(2024, 1, 1), "Día", "T1", "grave", "x", 2.0)]
    equipment = [(f"T{t}", "Andina", "M", 300.0, 2.0) for t in range(3)]
    book = [("2.3", 1, 1, "A", "CODELCO", "CODELCO", 2024, 100.0, None, None)]
    book += [("2.3", i, 0, label, None, label, 2024, v, None, None) for i, label, v in ((2, "CODELCO", 100.0), (3, "TOTAL PRODUCCIÓN", 100.0))]
    price = [(date(2024, 1, 1), "Crucero", 50.0, 20.0, 80.0, 24)]
    rows = {"raw_telemetry": telemetry, "raw_maintenance": maintenance, "raw_safety": safety, "equipment": equipment, "raw_yearbook": book, "raw_daily_price": price}
    return {n: spark.createDataFrame(r, schemas.RAW[n]) for n, r in rows.items()}


def test_full_build_writes_checks_and_tests(spark, tmp_path):
    built, results = warehouse.run(spark, raw_tables(spark), f"{tmp_path}/wh")
    assert set(checks.CONTRACT) <= set(built)
    kpis = {r["shift"]: r for r in built["shift_kpis"].collect()}
    assert kpis["Día"]["risk_level"] == "Alto" and kpis["Noche"]["risk_level"] == "Bajo"
    assert kpis["Día"]["recovery_pct"] == pytest.approx(86.0, abs=0.01)
    assert list((tmp_path / "wh" / "stg_yearbook").glob("data-*/tab=2.3")) and list((tmp_path / "wh" / "shift_kpis").glob("data-*"))
    again = warehouse.opened(spark, f"{tmp_path}/wh")
    assert set(again) == set(warehouse.WRITTEN)
    for name, df in again.items():
        assert df.schema.names == built[name].schema.names and sorted(df.collect(), key=str) == sorted(built[name].collect(), key=str)
    bad = {(r["tbl"], r["test"], r["col"]): r["n_bad"] for r in results.collect()}
    assert len(bad) == len(checks.SUITE)
    assert bad["yb_totals", "accepted_range", "total_kt"] == 1
    assert all(n == 0 for (t, _, _), n in bad.items() if t in ("shift_kpis", "equipment_performance", "failure_features", "stg_telemetry"))


def test_published_names_are_distinct_per_table_and_round_trip(spark, tmp_path):
    raw = raw_tables(spark)
    built = warehouse.build(raw)
    for table, df in {**raw, **built}.items():
        out = names.published(df, table).columns
        assert len(set(out)) == len(out), table
    for fmt in ("parquet", "csv"):
        path = f"{tmp_path}/seed-{fmt}"
        stored = names.published(raw["equipment"], "equipment")
        tables.write_csv(stored, path) if fmt == "csv" else stored.write.parquet(path)
        assert sorted(tables.read_raw(spark, path, "equipment", fmt).collect()) == sorted(raw["equipment"].collect())


def test_sql_with_published_names_runs(spark):
    names.register_published(warehouse.build(raw_tables(spark)))
    row = spark.sql(
        """select camion_id, horas_operativas_acumuladas, falla_siguiente_turno from ml_predictive_maintenance
           where falla_siguiente_turno is not null order by camion_id limit 1"""
    ).first()
    assert row["horas_operativas_acumuladas"] == 10.0
    assert spark.sql("select nivel_riesgo from fct_daily_mining_kpis where turno = 'Día'").first()[0] == "Alto"
    assert spark.sql("select count(*) from fct_cmg_mensual_barra where mes = date '2024-01-01' and zona = 'Norte'").first()[0] == 1
    for view in names.TABLES.values():
        spark.catalog.dropTempView(view)


def test_views_are_reachable_by_name(spark):
    built = warehouse.build(raw_tables(spark))
    tables.register_views(built)
    assert spark.sql("select count(*) n from failure_features where fails_next_shift is null").first()["n"] == 3
    for name in built:
        spark.catalog.dropTempView(name)


def test_raw_tables_are_read_with_the_types_they_are_stored_with(spark, tmp_path):
    """Published Parquet has 64-bit integers and days as timestamps."""
    raw = raw_tables(spark)
    for table, wide in (("raw_yearbook", {"ord": "bigint", "lvl": "bigint", "yr": "bigint"}), ("raw_daily_price", {"day": "timestamp"})):
        stored = names.published(raw[table].withColumns({c: F.col(c).cast(t) for c, t in wide.items()}), table)
        stored.write.parquet(f"{tmp_path}/{table}")
        got = tables.read_raw(spark, f"{tmp_path}/{table}", table)
        assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.RAW[table]]
        assert sorted(got.collect(), key=str) == sorted(raw[table].select(got.columns).collect(), key=str)


def test_hours_without_a_day_or_a_bus_are_in_no_row(spark, tmp_path):
    hours = spark.createDataFrame(
        [(date(2024, 1, 1), 1, "Crucero", 5.0), (None, 2, "Crucero", 5.0), (date(2024, 1, 1), 3, None, 5.0)], schemas.HOURLY_PRICE
    )
    names.published(hours, "raw_hourly_price").write.parquet(f"{tmp_path}/hours")
    read = tables.read_raw(spark, f"{tmp_path}/hours", "raw_hourly_price")
    assert [(r["day"], r["bus"], r["hours"]) for r in prices.daily_summary(read).collect()] == [(date(2024, 1, 1), "Crucero", 1)]
    raw = raw_tables(spark)
    raw["raw_hourly_price"] = read
    del raw["raw_daily_price"]
    assert warehouse.build(raw)["stg_price"].count() == 1


def test_workbook_sheets_become_the_yearbook(spark):
    lines = [([(None, "Year")] + [(float(y), str(y)) for y in (2001, 2002, 2003)]), [(None, "TOTAL PRODUCCIÓN"), (1.5, "1.5"), (2.0, "2"), (None, "n.d.")]]
    rows = [(f"Tabla {tab}", i, cells) for tab in yearbook.UNITS for i, cells in enumerate(lines, start=1)] + [("Indice", 1, [(None, "x")])]
    df = spark.createDataFrame(rows, schemas.SHEET_ROWS)
    long = yearbook.from_workbook(df)
    got = {(r["tab"], r["yr"]): (r["value"], r["unit"]) for r in long.collect()}
    assert got == {(t, y): (v, u) for t, u in yearbook.UNITS.items() for y, v in ((2001, 1.5), (2002, 2.0), (2003, None))}
    assert yearbook.totals(yearbook.staged(long)).where("yr = 2002").first()["total_kt"] == 2.0
    with pytest.raises(ValueError, match=r"missing: Tabla 2\.4"):
        yearbook.from_workbook(df.where("sheet != 'Tabla 2.4'"))


def test_a_lost_write_leaves_the_old_rows_and_versions_stay_readable(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path)
    first = spark.range(1000).withColumn("g", F.col("id") % 3)
    assert versions.publish(first, path, partition_by=["g"]).count() == 1000
    broken = spark.range(0, 900, 1, 6).withColumn("g", F.when(F.col("id") == 777, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path)
    assert versions.current(spark, path).count() == 1000 and versions.history(spark, path).count() == 1
    # replaced by a plan that reads the version it replaces
    more = versions.current(spark, path).where("g > 0").withColumn("x", F.lit("new"))
    assert versions.publish(more, path).columns == ["id", "g", "x"]
    assert versions.current(spark, path).count() == 666 and versions.current(spark, path, 1).count() == 1000
    assert versions.publish(first.where("false"), path).count() == 0
    assert [r["number"] for r in versions.superseded(spark, path, keep=2).collect()] == [1]
    with pytest.raises(FileNotFoundError):
        versions.current(spark, path, 9)


def files_read(df) -> int:
    df.collect()
    found = df._jdf.queryExecution().executedPlan()
    found = found.executedPlan() if "AdaptiveSparkPlan" in found.getClass().getName() else found
    leaves = found.collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numFiles").value() for m in metrics if m.contains("numFiles"))


def test_filters_read_only_zones_that_may_hold_their_rows(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("day"),
        F.concat(F.lit("site "), (F.col("id") * 7 % 5).cast("string")).alias("site"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("T"), F.lpad((F.col("id") * 13 % 60).cast("string"), 3, "0"))).alias("truck"),
        "id",
    )
    path = f"{tmp_path}/clustered"
    published = versions.publish(rows, path, cluster_by=["day", "site", "truck"])
    assert published.columns == rows.columns and sorted(published.collect(), key=str) == sorted(rows.collect(), key=str)
    every = files_read(versions.current(spark, path))
    assert every >= 48
    for between, among, share in (
        ({"day": ("2020-03-01", "2020-03-02")}, {"site": ["site 1"]}, 0.1),
        ({}, {"truck": ["T007"]}, 0.3),
        ({"day": (None, "2020-02-01"), "id": (5, None)}, {"site": ["site 2"], "truck": ["T059", "T058"]}, 0.1),
    ):
        got, want = versions.filtered(spark, path, between, among), rows
        for c, (low, high) in between.items():
            want = want.where(F.lit(True) if low is None else F.col(c) >= low).where(F.lit(True) if high is None else F.col(c) <= high)
        for c, values in among.items():
            want = want.where(F.col(c).isin(values))
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
        assert files_read(got) <= share * every
    assert versions.filtered(spark, path, {}, {"site": []}).count() == 0
    plain = f"{tmp_path}/plain"
    versions.publish(rows, plain, sort_by=["day"])
    assert versions.filtered(spark, plain, {"day": ("2020-03-01", "2020-03-02")}).count() == rows.where("day between '2020-03-01' and '2020-03-02'").count()
    with pytest.raises(ValueError, match="cluster"):
        versions.publish(rows.withColumn("a", F.array("id")), plain, cluster_by=["a"])


def test_truck_shifts_are_read_by_day_site_and_truck(spark, tmp_path):
    built = warehouse.build(raw_tables(spark), f"{tmp_path}/wh")["equipment_performance"]
    some = built.first()
    got = warehouse.truck_shifts(spark, f"{tmp_path}/wh", [some["site"]], [some["truck"]], some["day"], some["day"])
    assert some in got.collect() and warehouse.truck_shifts(spark, f"{tmp_path}/wh").count() == built.count()


def test_zones_are_cut_by_a_table_with_the_same_values(spark, tmp_path):
    """Truck shifts are a join to their rows: the cuts are read from the rows, not from a second join."""
    rows = spark.range(4_000).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"), F.format_string("T%03d", F.col("id") % 70).alias("truck"))
    joined = rows.withColumn("x", F.length("truck"))
    for k, cuts_of in enumerate((None, rows)):
        got = versions.publish(joined, f"{tmp_path}/{k}", cluster_by=["day", "truck"], cuts_of=cuts_of)
        assert sorted(got.collect()) == sorted(joined.collect())
    zones = [spark.read.parquet(str(next(tmp_path.glob(f"{k}/zones-*")))) for k in range(2)]
    assert sorted(zones[0].collect()) == sorted(zones[1].collect())
    # values of another table cut other zones: only its rows were looked at
    versions.publish(joined, f"{tmp_path}/2", cluster_by=["day", "truck"], cuts_of=rows.where("truck < 'T003'"))
    assert sorted(spark.read.parquet(str(next(tmp_path.glob("2/zones-*")))).collect()) != sorted(zones[0].collect())


def test_a_counted_build_reads_aggregated_raw_tables_once(spark):
    from verify.registry import QUERIES

    counts = QUERIES["warehouse_counts"](spark, "/root/testdata/sf0.001")
    assert "l_suppkey" not in counts._jdf.queryExecution().optimizedPlan().toString()
    n = {r["tbl"]: r["n_rows"] for r in counts.collect()}
    assert n["stg_maintenance"] == n["equipment_performance"] == n["failure_features"] > 0
