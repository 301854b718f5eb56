"""What the physical plans must look like when tables are too large to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lodeworks import schemas
from lodeworks.operators import blocks, shape, sheets
from lodeworks.plans import features, operations, reports, staging, yearbook


@pytest.fixture
def large(spark):
    """No broadcast by estimated size, and plans as they are planned."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    for name, schema in schemas.RAW.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
    return root


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)", plan(df))


def raw(spark, folder, name):
    return spark.read.schema(schemas.RAW[name]).parquet(f"{folder}/{name}")


def test_shift_kpis_shuffle_each_domain_once_and_the_joins_add_none(large, folder):
    performance = operations.equipment_performance(
        staging.maintenance(raw(large, folder, "raw_maintenance")), F.broadcast(raw(large, folder, "equipment"))
    )
    kpis = operations.shift_kpis(
        performance, staging.telemetry(raw(large, folder, "raw_telemetry")), staging.safety(raw(large, folder, "raw_safety"))
    )
    keys = [re.sub(r", \d+\)", ")", e) for e in exchanges(kpis) if e != "SinglePartition"]  # the sketch's counters
    # count(distinct truck) needs one more level; everything else is one shuffle per domain.
    assert sorted(keys) == sorted(
        ["hashpartitioning(day, shift, site, truck)"] + ["hashpartitioning(day, shift, site)"] * 3
    )


def test_dimension_meets_rows_by_key_and_part_unless_spark_broadcasts_it(large, folder):
    maintenance, equipment = staging.maintenance(raw(large, folder, "raw_maintenance")), raw(large, folder, "equipment")
    small = operations.join_dimension(maintenance, equipment.drop("site"), "truck", ["day", "shift"])
    assert "SortMergeJoin" in plan(small)
    # rows meet by key and part, the sketch shuffles one row of counters per task
    assert [e for e in exchanges(small) if e != "SinglePartition"] == [e for e in exchanges(small) if "truck, _salt" in e]
    large.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
    assert "BroadcastHashJoin" in plan(operations.join_dimension(maintenance, F.broadcast(equipment.drop("site")), "truck", ["day", "shift"]))


def test_windows_never_gather_a_site_or_truck(large, folder):
    telemetry = staging.telemetry(raw(large, folder, "raw_telemetry"))
    found = plan(features.process_features(telemetry, block_seconds=3600))
    wide = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", found)]
    assert sum(e.startswith("site, block") for e in wide) == 2
    assert sum(e.startswith("site, 4") for e in wide) == 1  # the block summaries
    assert "WindowGroupLimit [site, block]" in found

    performance = operations.equipment_performance(
        staging.maintenance(raw(large, folder, "raw_maintenance")), F.broadcast(raw(large, folder, "equipment"))
    )
    wide = exchanges(features.failure_features(performance))
    assert sum("truck, block" in e for e in wide) == 2 and sum(e.startswith("hashpartitioning(truck, 4") for e in wide) == 1


def test_feature_rows_are_shuffled_by_key_and_block_at_every_size(large, folder):
    """One plan: only summaries, one row per block, meet by key alone."""
    performance = operations.equipment_performance(
        staging.maintenance(raw(large, folder, "raw_maintenance")), F.broadcast(raw(large, folder, "equipment"))
    )
    for df, key in ((features.failure_features(performance), "truck"), (features.process_features(staging.telemetry(raw(large, folder, "raw_telemetry"))), "site")):
        found = [e for e in exchanges(df) if e != "SinglePartition"]
        assert sum(f"{key}, block" in e for e in found) == 2 and len(found) <= 3


def test_feature_windows_share_one_sort(large, folder):
    telemetry = staging.telemetry(raw(large, folder, "raw_telemetry"))
    main = plan(features.process_features(telemetry, block_seconds=3600)).split("Union")[0]
    assert main.count("Sort [") == 1 and main.count("+- Window [") == 1


def test_sheets_are_shuffled_by_block_and_wide_rows_once(large):
    """The same plan for any number of sheets and indentations; by sheet alone only one row per block is shuffled."""
    rows = large.createDataFrame([], schemas.SHEET_ROWS)
    found = plan(sheets.hierarchy(rows, 100))
    assert all("sheet, block" in e or re.match(r"hashpartitioning\(sheet, \d+", e) for e in exchanges(sheets.hierarchy(rows, 100)))
    # cells leave the scan on one way, to the second of the two unions; all others carry labels and indentations
    assert found.count(" AS kind, cells,") == 1 and found.count("REPARTITION_BY_COL") == 3 and "Broadcast" not in found
    for chunk in re.split(r"Exchange hashpartitioning\(sheet, \d+", found)[1:]:
        first = chunk.split("\n")[1:3]
        assert any("HashAggregate" in line or "SortAggregate" in line or "Project" in line for line in first)
    bounds = exchanges(sheets.bounds(rows, 100))
    assert len(bounds) == 2 and sum("sheet, block" in e for e in bounds) == 1


def test_user_filter_and_staging_filters_reach_the_scan(spark, folder, tmp_path):
    kpis = spark.createDataFrame([], "day date, shift string, site string, oee_pct double, incidents bigint, extra string")
    kpis.write.parquet(f"{tmp_path}/kpis")
    shown = reports.filter_user(spark.read.schema(kpis.schema).parquet(f"{tmp_path}/kpis"), ["Andina"], ["Día"], "2024-01-01").select("oee_pct")
    found = plan(shown)
    assert "PushedFilters: [IsNotNull(site), IsNotNull(shift), IsNotNull(day), EqualTo(site,Andina)" in found
    assert "ReadSchema: struct<day:date,shift:string,site:string,oee_pct:double>" in found
    assert "IsNotNull(tons)" in plan(staging.telemetry(raw(spark, folder, "raw_telemetry")))


def test_topics_read_only_their_tab(spark, tmp_path):
    from lodeworks.sources.tables import write_table

    rows = [(t, 1, 0, "Concentradora", None, "x", 2020, 1.0, None, None) for t in ("2.3", "2.4", "6.5")]
    stage = write_table(yearbook.staged(spark.createDataFrame(rows, schemas.YEARBOOK)), f"{tmp_path}/stage", ["tab"])
    found = plan(yearbook.grades(stage))
    assert re.search(r"PartitionFilters: \[[^]]*tab[^]]* = 2\.4", found)
    assert yearbook.grades(stage).first()["mill_grade"] == 1.0


def test_hot_site_is_spread_over_tasks(large):
    data = large.range(4000).select(
        F.lit("A").alias("site"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), F.col("id").cast("double").alias("x")
    )
    cut = data.withColumn("block", blocks.time_block("ts", 3600))
    spread = blocks.with_previous_rows(cut, ["site"], ["ts"], "block", 5, ["x"])
    assert spread.select(F.spark_partition_id()).distinct().count() > 1
    assert spread.where(blocks.CONTEXT).groupBy("block").count().where("count <> 5").count() == 0


def test_histogram_reads_its_source_once(large, tmp_path):
    large.range(1000).selectExpr("cast(id % 7 as double) a", "cast(id % 11 as double) b", "id % 2 g").write.parquet(f"{tmp_path}/t")
    for by in ([], ["g"]):
        found = shape.histogram(large.read.parquet(f"{tmp_path}/t"), ["a", "b"], 5, by)
        assert plan(found).count("FileScan") == 1 and "ReusedExchange" in plan(found)
    large.conf.set("spark.sql.adaptive.enabled", "true")
    found = shape.histogram(large.read.parquet(f"{tmp_path}/t"), ["a", "b"], 5)
    found.collect()
    assert "ReusedExchange" in plan(found)
