from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from lodeworks import schemas
from lodeworks.operators import dimension
from lodeworks.plans import operations, staging

DAY = date(2024, 1, 1)


def truck_shift(truck="T1", sched=12.0, oper=10.0, cycles=20.0, site="Andina", shift="Día", day=DAY, fail=0.0, i=1):
    return (i, site, truck, day, shift, sched, oper, 0.0, fail, cycles, 1.0)


def incident(i, sev, down=0.5, site="Andina", shift="Día", day=DAY):
    return (i, site, day, shift, None, sev, "x", down)


@pytest.fixture
def equipment(spark):
    return spark.createDataFrame([("T1", "Andina", "M", 300.0, 2.0), ("T2", "Andina", "M", 300.0, 2.0)], schemas.EQUIPMENT)


@pytest.fixture
def tables(spark, equipment):
    def make(trucks, incidents=(), plant=()):
        maintenance = staging.maintenance(spark.createDataFrame(list(trucks), schemas.MAINTENANCE))
        safety = staging.safety(spark.createDataFrame(list(incidents), schemas.SAFETY))
        telemetry = staging.telemetry(spark.createDataFrame(list(plant), schemas.TELEMETRY))
        performance = operations.equipment_performance(maintenance, equipment)
        return performance, operations.shift_kpis(performance, telemetry, safety)

    return make


def test_performance_of_known_truck_and_its_cap(tables):
    performance, _ = tables([truck_shift(cycles=10.0), truck_shift("T2", cycles=30.0, i=2)])
    got = {r["truck"]: r for r in performance.collect()}
    assert got["T1"]["performance"] == pytest.approx(10 * 300 / 10 / 600)
    assert got["T2"]["performance"] == 1.0
    assert got["T1"]["availability"] == pytest.approx(10 / 12)


def test_unknown_truck_and_idle_truck_get_the_cap_and_are_counted(tables):
    performance, _ = tables([truck_shift("T9"), truck_shift("T1", oper=0.0, i=2), truck_shift("T2", cycles=1.0, i=3)])
    got = {r["truck"]: r["performance"] for r in performance.collect()}
    assert got["T9"] == 1.0 and got["T1"] == 1.0 and got["T2"] < 1
    assert {r["truck"] for r in operations.capped_unknown(performance).collect()} == {"T9", "T1"}


def test_null_operated_hours_are_dropped_by_staging(tables):
    performance, kpis = tables([truck_shift(oper=None), truck_shift("T2", i=2)])
    assert performance.count() == 1 and kpis.first()["n_trucks"] == 1


def test_shift_without_trucks_is_absent_and_shift_without_incidents_reads_zero(tables):
    _, kpis = tables([truck_shift()], [incident(1, "fatal", shift="Noche")])
    row = kpis.collect()
    assert [r["shift"] for r in row] == ["Día"]
    assert (row[0]["incidents"], row[0]["risk_score"], row[0]["risk_level"], row[0]["quality_pct"]) == (0, 0, "Bajo", 100.0)
    assert row[0]["recovery_pct"] is None


def test_incident_hours_beyond_the_schedule_make_quality_negative(tables):
    _, kpis = tables([truck_shift()], [incident(1, "grave", 20.0)])
    row = kpis.first()
    assert row["quality_pct"] < 0 and row["oee_pct"] < 0


def test_five_mild_incidents_add_up_to_a_high_risk_and_unknown_severity_adds_nothing(tables):
    _, kpis = tables([truck_shift()], [incident(i, "leve") for i in range(5)] + [incident(9, "rara", None)])
    row = kpis.first()
    assert (row["risk_score"], row["risk_level"], row["incidents"], row["serious_incidents"]) == (5, "Alto", 6, 0)


def test_weighted_grade_counts_the_weight_of_rows_without_grade(spark, tables):
    plant = [(1, "Andina", None, "Día", 100.0, 1.0, 25.0, 0.1, 1.0, 9.0), (2, "Andina", None, "Día", 100.0, None, 25.0, 0.1, 1.0, 9.0)]
    frame = staging.telemetry(spark.createDataFrame(plant, schemas.TELEMETRY)).withColumn("day", F.lit(DAY))
    assert operations.plant_by_shift(frame).first()["feed_mean"] == 0.5


def test_oee_is_the_product_of_shift_means(tables):
    _, kpis = tables([truck_shift(oper=12.0, cycles=12.0), truck_shift("T2", oper=6.0, cycles=12.0, i=2)], [incident(1, "leve", 2.4)])
    row = kpis.first()
    availability, performance, quality = (1 + 0.5) / 2, (0.5 + 1.0) / 2, (24 - 2.4) / 24
    assert row["oee_pct"] == pytest.approx(availability * performance * quality * 100, abs=0.0051)


@pytest.mark.parametrize(("how", "lost"), [("left", 0), ("inner", 1)])
@pytest.mark.parametrize("parts", [1, 7, 1000])
def test_dimension_join_is_the_same_however_heavy_keys_are_dealt(spark, parts, how, lost):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("x")
    )
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = dimension.join_dimension(fact, dim, "k", ["x"], how, parts=parts)
    unmet = fact.where("k >= 40 or k is null").count()
    assert got.columns == ["k", "x", "v"] and got.count() == 3000 - lost * unmet
    assert got.where("v is null").count() == (1 - lost) * unmet
    assert got.where("v <> k * 10").count() == 0
    assert dimension.join_dimension(fact.where("false"), dim, "k", ["x"], how).count() == 0


def test_heavy_keys_are_found_and_others_left_whole(spark):
    fact = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("k"))
    found = spark.range(1).select(dimension.heavy_keys(fact, "k", 100).alias("m")).first()["m"]
    assert found == {"hot": 34}
    assert spark.range(1).select(dimension.heavy_keys(fact.where("false"), "k").alias("m")).first()["m"] == {}


def test_a_hot_key_and_missing_keys_are_spread_and_cold_rows_copied_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = spark.range(9000).select(
            F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("x")
        )
        dim = spark.range(-1, 2000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
        joined = dimension.join_dimension(fact, dim, "k", ["x"], parts=50)
        for part in ("k = -1", "k is null"):
            sizes = [r["count"] for r in joined.where(part).groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == 4 and max(sizes) < 1500
        heavy = dimension.heavy_keys(fact, "k", 50)
        copies = dim.withColumn("n", F.coalesce(F.try_element_at(heavy, F.col("k")), F.lit(1)))
        assert {tuple(r) for r in copies.groupBy("n").count().collect()} == {(1, 2000), (25, 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
