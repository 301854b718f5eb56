from __future__ import annotations

import random

from pyspark.sql import functions as F

from lodeworks.operators import distinct


def test_counts_of_any_grain_from_one_table_of_bitmaps(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(6), rng.choice("ab"), None if rng.random() < 0.05 else f"T{int(rng.random() ** 3 * 50_000)}") for _ in range(20_000)]
    df = spark.createDataFrame(rows, "day int, site string, truck string").withColumn("id", F.monotonically_increasing_id())
    codes = distinct.coded(df, "truck")
    n = df.select("truck").where("truck is not null").distinct().count()
    assert {r["code"] for r in codes.collect()} == set(range(n))
    parts = distinct.partials(df, ["day", "site"], "truck", codes, ["id"])
    assert parts.columns == ["day", "site", "range", "seen"] and parts.groupBy("day", "site", "range").count().where("count > 1").count() == 0
    for keys in (["day", "site"], ["day"], ["site"], []):
        want = df.groupBy(*keys).agg(F.countDistinct("truck").alias("n"))
        assert sorted(distinct.counts(parts, keys, "n").collect()) == sorted(want.collect())


def test_empty_and_unknown_values(spark):
    empty = spark.createDataFrame([], "g int, v string")
    codes = distinct.coded(empty, "v")
    assert codes.count() == 0
    some = spark.createDataFrame([(1, "a"), (2, None)], "g int, v string")
    parts = distinct.partials(some, ["g"], "v", codes, ["g"])
    assert distinct.counts(parts, ["g"], "n").count() == 0 and [r["n"] for r in distinct.counts(parts, [], "n").collect()] == [0]
