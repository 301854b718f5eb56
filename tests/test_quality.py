from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodeworks.operators import quality
from lodeworks.operators.quality import Check
from lodeworks.plans import checks


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(1, "a", 0.0), (2, "b", 10.0), (2, "x", 10.5), (None, None, None), (None, "a", -1.0)]
    return spark.createDataFrame(rows, "k int, v string, x double")


def test_row_rules_let_nulls_and_inclusive_ends_pass(dirty):
    assert quality.not_null(dirty, "k").count() == 2
    assert [r["v"] for r in quality.accepted_values(dirty, "v", ["a", "b"]).collect()] == ["x"]
    assert sorted(r["x"] for r in quality.accepted_range(dirty, "x", 0, 10).collect()) == [-1.0, 10.5]
    assert quality.accepted_range(dirty, "x", low=0).count() == 1
    assert quality.negative(dirty, "x").count() == 1


def test_unique_skips_nulls_but_a_combination_counts_them(dirty):
    assert [(r["k"], r["n_rows"]) for r in quality.unique(dirty, "k").collect()] == [(2, 2)]
    assert sorted(str(r["k"]) for r in quality.unique_combination(dirty, ["k"]).collect()) == ["2", "None"]


def test_relationships_with_a_filter(spark, dirty):
    parent = spark.createDataFrame([("a",)], "name string")
    got = quality.relationships(dirty, parent, "v", "name", F.col("x") <= 10)
    assert [(r["v"], r["n_rows"]) for r in got.collect()] == [("b", 1)]


def test_suite_counts_every_check(spark, dirty):
    tables = {"t": dirty, "p": spark.createDataFrame([("a",)], "name string")}
    suite = [
        Check("t", "not_null", ("k",)),
        Check("t", "accepted_values", ("v",), {"values": ["a", "b"]}),
        Check("t", "accepted_range", ("x",), {"low": 0, "high": 10}),
        Check("t", "unique", ("k",)),
        Check("t", "unique_combination", ("k", "v")),
        Check("t", "relationships", ("v",), {"to": "p", "field": "name"}),
        Check("p", "not_null", ("name",)),
    ]
    got = {(r["tbl"], r["test"], r["col"]): r["n_bad"] for r in quality.run_suite(tables, suite).collect()}
    assert got == {
        ("t", "not_null", "k"): 2,
        ("t", "accepted_values", "v"): 1,
        ("t", "accepted_range", "x"): 2,
        ("t", "unique", "k"): 1,
        ("t", "unique_combination", "k,v"): 0,
        ("t", "relationships", "v"): 2,
        ("p", "not_null", "name"): 0,
    }
    with pytest.raises(ValueError):
        quality.run_suite(tables, [Check("t", "other", ("k",))])


def test_declared_suite_has_every_published_test():
    kinds = {}
    for check in checks.SUITE:
        kinds[check.kind] = kinds.get(check.kind, 0) + 1
    assert kinds == {
        "not_null": 47, "accepted_range": 42, "unique_combination": 16, "accepted_values": 11, "unique": 9, "relationships": 1
    }


def test_contract_passes_and_reports_all_gaps_at_once(dirty):
    quality.require_contract({"t": dirty}, {"t": ["k", "v"]})
    with pytest.raises(quality.ContractError) as error:
        quality.require_contract({"t": dirty}, {"t": ["k", "site"], "gone": ["a"]})
    assert "gone" in str(error.value) and "site" in str(error.value)


def test_invariants(spark):
    plant = spark.createDataFrame(
        [(1, 0.5, 25.0, 0.1, 9.0), (2, 0.5, 25.0, 0.5, 9.0), (3, 0.5, 0.4, 0.1, 9.0), (4, 0.5, 25.0, 0.1, 0.0), (5, None, 25.0, 0.1, 9.0)],
        "record_id int, feed double, conc double, tail double, tons double",
    )
    assert sorted(r["record_id"] for r in checks.telemetry_breaks(plant).collect()) == [2, 3, 4, 5]
    fleet = spark.createDataFrame(
        [("a", 12.0, 12.0, 0.0, 0.0), ("b", 12.0, 12.0, 0.0, 1e-7), ("c", 12.0, 11.0, 1.0, 0.5), ("d", 12.0, -1.0, 0.0, 0.0)],
        "truck string, sched_h double, oper_h double, maint_h double, fail_h double",
    ).withColumns({"day": F.lit("2024-01-01").cast("date"), "shift": F.lit("Día")})
    assert sorted(r["truck"] for r in checks.maintenance_breaks(fleet).collect()) == ["c", "d"]


def awkward(spark):
    """Keys that are easily taken for one another, or for different ones."""
    times = ["2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002", "2024-01-01 00:00:00.000002", None]
    numbers = [0.0, -0.0, float("nan"), float("nan"), 1.0000000000000002, 1.0, None]
    rows = [(times[i % 4], numbers[i % 7], f"{i % 5}" if i % 6 else None, None if i % 4 == 0 else f"{i % 3}", i % 9) for i in range(40)]
    typed = spark.createDataFrame(rows, "t string, x double, a string, b string, n int")
    return typed.withColumn("t", F.col("t").cast("timestamp_ntz"))


@pytest.mark.parametrize("bits", [64, 6, 1])
def test_suite_counts_keys_as_the_single_rules_do_also_when_fingerprints_collide(spark, bits):
    rows = awkward(spark)
    parents = spark.createDataFrame([(0,), (1,), (2,), (2,), (None,)], "id long")
    numbers = spark.createDataFrame([(-0.0,), (float("nan"),)], "x double")
    tables = {"t": rows, "p": parents, "q": numbers}
    combinations = [("t",), ("x",), ("a", "b"), ("t", "x"), ("t", "x", "a", "b", "n")]
    suite = [Check("t", "unique_combination", c) for c in combinations] + [Check("t", "unique", (c,)) for c in ("t", "x", "a", "b", "n")]
    suite += [
        Check("t", "relationships", ("n",), {"to": "p", "field": "id"}),
        Check("t", "relationships", ("n",), {"to": "p", "field": "id", "where": "x > 0"}),
        Check("t", "relationships", ("x",), {"to": "q", "field": "x"}),
        Check("p", "unique", ("id",)),
    ]
    got = {(r["tbl"], r["test"], r["col"], r["n_bad"]) for r in quality.run_suite(tables, suite, bits).collect()}
    want = {("t", "unique_combination", ",".join(c), quality.unique_combination(rows, c).count()) for c in combinations}
    want |= {("t", "unique", c, quality.unique(rows, c).count()) for c in ("t", "x", "a", "b", "n")}
    want |= {("t", "relationships", "n", quality.relationships(rows, parents, "n", "id", w).count()) for w in (None, F.col("x") > 0)}
    want |= {("t", "relationships", "x", quality.relationships(rows, numbers, "x", "x").count()), ("p", "unique", "id", 1)}
    assert got == want


def test_times_a_microsecond_apart_are_no_duplicates(spark):
    rows = spark.sql("select * from values (timestamp_ntz'2024-01-01 00:00:00.000001'), (timestamp_ntz'2024-01-01 00:00:00.000002') t(ts)")
    assert [r["n_bad"] for r in quality.run_suite({"t": rows}, [Check("t", "unique_combination", ("ts",))]).collect()] == [0]


def test_keys_are_shuffled_as_fingerprints(spark):
    """A key takes its check's number, two hashes and a count, whatever its length; exact values only behind a broadcast."""
    rows = spark.range(20).select(F.repeat(F.lit("long key "), 50).alias("k"), "id")
    shown = quality.run_suite({"t": rows}, [Check("t", "unique_combination", ("k", "id"))])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in shown and "Aggregate [check#" in shown
    wide = quality.run_suite({"t": rows}, [Check("t", "unique_combination", ("k", "id"))])
    assert [r["n_bad"] for r in wide.collect()] == [0]


def test_suites_of_a_folder_read_stored_truck_shifts_and_features(spark):
    """A suite reads each table for its row rules, its keys and their exact values; line items were grouped again for each."""
    from verify.registry import QUERIES

    for name in ("dq_suite", "dq_suite_features"):
        found = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_suppkey" not in found and "rows_before" not in found
