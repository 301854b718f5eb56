from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeworks.functions import exact


def sums(spark, values, parts=1):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return tuple(rows.agg(exact.total(F.col("x")), exact.mean(F.col("x"))).first())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e12, 1e12), st.floats(-1, 1), st.sampled_from([0.1, -0.1, 1e-3, 0.0, -0.0, 1e14])), min_size=1, max_size=30))
def test_sums_are_those_of_exact_arithmetic(spark, values):
    got, mean = sums(spark, values)
    want = math.fsum(values)
    assert abs(got - want) <= 2 * math.ulp(want) + len(values) * 2.0**-72
    assert mean == got / len(values)


def test_order_and_parts_change_no_bit(spark):
    rng = random.Random(2)
    values = [rng.choice([0.1, 0.7, 1e9 + 0.3, -1e9, 1e-9]) * rng.random() for _ in range(3000)]
    found = set()
    for parts in (1, 3, 7):
        rng.shuffle(values)
        found.add(sums(spark, values, parts))
    assert len(found) == 1
    small = [-0.001, 0.0005, 2.0**-60]
    assert sums(spark, small)[0] == math.fsum(small)


def test_nulls_and_values_out_of_range(spark):
    assert sums(spark, [None, None]) == (None, None) and sums(spark, [None, 2.5, 0.25]) == (2.75, 1.375)
    assert sums(spark, [1e300, 1.0])[0] == 1e300 and sums(spark, [math.inf, 1.0])[0] == math.inf
    assert math.isnan(sums(spark, [math.nan, 1.0])[0])
    empty = spark.createDataFrame([], "x double").agg(exact.total(F.col("x")).alias("t")).first()
    assert empty["t"] is None
    whole = spark.createDataFrame([(1,), (2,)], "x int").agg(exact.total(F.col("x")).alias("t")).first()
    assert whole["t"] == 3.0


@pytest.mark.parametrize("n", [1 << 20])
def test_many_rows(spark, n):
    got = spark.range(n).select((F.col("id") * 0.1).alias("x")).agg(exact.total(F.col("x")).alias("t")).first()["t"]
    assert got == pytest.approx(math.fsum(i * 0.1 for i in range(n)), rel=1e-15)
