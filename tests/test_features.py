from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodeworks import schemas
from lodeworks.operators import blocks, ranks
from lodeworks.plans import features, staging

PERF = "truck string, day date, shift string, site string, model string, cap_t double, oper_h double, maint_h double, fail_h double, availability double, performance double"


def perf(spark, rows):
    """rows: (truck, day, shift, fail_h) with other measures made from the position."""
    full = [(t, d, s, "Andina", "M", 300.0, 8.0 + i % 3, float(i % 4), f, (i % 8) / 8, 1.0) for i, (t, d, s, f) in enumerate(rows)]
    return spark.createDataFrame(full, PERF)


def shifts(truck, n, fails=(), start=date(2023, 12, 28)):
    return [
        (truck, start + timedelta(days=i // 2), "Día" if i % 2 == 0 else "Noche", 1.5 if i in fails else 0.0) for i in range(n)
    ]


def in_order(df):
    return sorted(df.collect(), key=lambda r: (r["truck"], r["day"], r["shift"] != "Día"))


def test_streak_without_a_failure_counts_from_the_first_row(spark):
    got = in_order(features.failure_features(perf(spark, shifts("T1", 12))))
    assert [r["shifts_since_failure"] for r in got] == list(range(12))
    assert got[-1]["fails_next_shift"] is None and got[0]["fails_next_shift"] == 0


def test_streak_with_failures_on_the_first_row_and_twice_in_a_row(spark):
    got = in_order(features.failure_features(perf(spark, shifts("T1", 12, fails={0, 4, 5, 9})), block_months=1))
    assert [r["shifts_since_failure"] for r in got] == [0, 1, 2, 3, 0, 0, 1, 2, 3, 0, 1, 2]
    assert [r["fails_next_shift"] for r in got] == [0, 0, 0, 1, 1, 0, 0, 0, 1, 0, 0, None]


def test_null_failure_hours_are_no_failure(spark):
    got = in_order(features.failure_features(perf(spark, [("T1", date(2024, 1, 1), "Día", None)])))
    assert got[0]["failed"] == 0 and got[0]["fails_next_shift"] is None


def plain_failure(performance):
    """The definitions over each truck's list of shifts."""
    histories: dict[str, list] = {}
    for r in sorted(performance.collect(), key=lambda r: (r["truck"], r["day"], r["shift"] == "Noche")):
        histories.setdefault(r["truck"], []).append(r)
    out = []
    for truck, rows in histories.items():
        failed = [int((r["fail_h"] or 0) > 0) for r in rows]
        for i, r in enumerate(rows):
            frame = rows[max(0, i - 6) : i + 1]
            failures = [k for k in range(i + 1) if failed[k]]
            out.append((
                truck, r["day"], r["shift"], failed[i], sum(x["oper_h"] for x in rows[: i + 1]), sum(x["maint_h"] for x in frame),
                sum(x["fail_h"] for x in frame), sum(x["availability"] for x in frame) / len(frame), i - (failures or [0])[-1],
                failed[i + 1] if i + 1 < len(rows) else None,
            ))
    return out


@pytest.mark.parametrize("months", [1, 12, 10**6])
def test_blocks_give_the_same_features_as_whole_histories(spark, months):
    """A truck with a third of all rows, sparse trucks with a row in some years, long gaps."""
    rng = random.Random(7)
    rows = []
    for t in range(40):
        days = 3000 if t == 0 else rng.choice([1, 3, 200])
        for i in sorted(rng.sample(range(6000), days)):
            rows.append((f"T{t}", date(2005, 1, 1) + timedelta(days=i // 2), "Día" if i % 2 == 0 else "Noche", 2.0 if rng.random() < 0.05 else 0.0))
    data = perf(spark, rows)
    names = ["truck", "day", "shift", "failed", "oper_h_total", "maint_h_7", "fail_h_7", "availability_7", "shifts_since_failure", "fails_next_shift"]
    got = features.failure_features(data, months).select(names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_failure(data), key=str)


def telemetry(spark, stamps):
    rows = [
        (i, site, ts, "Día", 50.0 + i % 7, 0.5 + (i % 16) / 16, 25.0 + i % 4, 0.125, float(30 + i % 5), 9.0 + (i % 8) / 8)
        for i, (site, ts) in enumerate(stamps)
    ]
    return staging.telemetry(spark.createDataFrame(rows, schemas.TELEMETRY))


def plain_process(t):
    w = Window.partitionBy("site").orderBy("ts")
    six = w.rowsBetween(-5, 0)
    return t.select(
        "record_id", F.avg("tons").over(six).alias("tons_6"), F.lag("feed").over(w).alias("feed_lag"),
        F.round(F.stddev_samp("feed").over(six), 9).alias("feed_sd_6"), F.avg("dose").over(six).alias("dose_6"),
        F.avg("ph").over(six).alias("ph_6"), F.lag("conc").over(w).alias("conc_lag"),
    )


@pytest.mark.parametrize("seconds", [1, 3600, 7200, 86400, 40 * 86400, 10**10])
def test_process_features_do_not_depend_on_the_blocks(spark, seconds):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    stamps = [("A", start + timedelta(hours=h)) for h in range(400)]
    stamps += [("B", start + timedelta(hours=h)) for h in sorted(rng.sample(range(3000), 60))] + [("C", start)]
    data = telemetry(spark, stamps)
    got = features.process_features(data, block_seconds=seconds)
    want = plain_process(data)
    got = got.withColumn("feed_sd_6", F.round("feed_sd_6", 9)).select(want.columns)
    assert got.count() == len(stamps)
    assert got.exceptAll(want).count() == 0


def test_short_history_has_no_deviation_and_frames_skip_gaps(spark):
    data = telemetry(spark, [("A", datetime(2024, 1, 1)), ("A", datetime(2024, 6, 1))])
    first, second = sorted(features.process_features(data).collect(), key=lambda r: r["ts"])
    assert first["feed_sd_6"] is None and first["feed_lag"] is None
    assert second["feed_lag"] == first["feed"] and second["feed_sd_6"] is not None


def test_null_inside_a_frame_is_left_out_of_its_mean(spark):
    t = telemetry(spark, [("A", datetime(2024, 1, 1, h)) for h in range(3)])
    holed = t.withColumn("dose", F.when(F.col("record_id") != 1, F.col("dose")))
    last = features.process_features(holed).where("record_id = 2").first()
    assert last["dose_6"] == pytest.approx((30 + 32) / 2)


def test_rows_without_a_time_come_last(spark):
    t = telemetry(spark, [("A", datetime(2024, 1, 1, h)) for h in range(4)])
    holed = t.withColumn("ts", F.when(F.col("record_id") != 1, F.col("ts")))
    for seconds in (3600, 86400):
        got = {r["record_id"]: r for r in features.process_features(holed, block_seconds=seconds).collect()}
        grade = {r["record_id"]: r["feed"] for r in t.collect()}
        assert got[0]["feed_lag"] is None and got[2]["feed_lag"] == grade[0]
        assert got[1]["feed_lag"] == grade[3] and got[1]["tons_6"] == pytest.approx(51.5)


def test_shifts_without_a_day_come_last(spark):
    rows = [("T1", d, "Día", f) for d, f in ((date(2024, 1, 1), 0.0), (None, 1.0), (date(2024, 3, 1), 0.0))]
    for months in (1, 12):
        got = {r["day"]: r for r in features.failure_features(perf(spark, rows), months).collect()}
        assert got[date(2024, 3, 1)]["fails_next_shift"] == 1 and got[None]["fails_next_shift"] is None
        assert got[date(2024, 1, 1)]["fails_next_shift"] == 0 and got[None]["shifts_since_failure"] == 0
        assert got[None]["oper_h_total"] == 27.0


def test_placeholder_dates_leave_the_other_blocks_as_they_are(spark):
    """Blocks of clean data, and of the same data with one row in 1970 and one in 9999."""
    start = datetime(2024, 1, 1)
    clean = telemetry(spark, [("A", start + timedelta(minutes=m)) for m in range(5000)])
    odd = telemetry(spark, [("A", datetime(1970, 1, 1)), ("A", datetime(9999, 12, 31))])
    sizes = lambda t: t.groupBy(blocks.time_block("ts", 86400)).count().agg(F.max("count")).first()[0]
    assert sizes(clean) == sizes(clean.unionByName(odd)) == 1440


def test_totals_of_hours_are_exact(spark):
    """Hours that doubles cannot hold exactly: the same total wherever blocks end."""
    hours = [0.1, 0.7, 9.87, 11.3]
    rows = perf(spark, shifts("T1", 2000)).withColumn("oper_h", F.element_at(F.array(*map(F.lit, hours)), (F.pmod(F.xxhash64("day", "shift"), F.lit(4)) + 1).cast("int")))
    got = [{(r["day"], r["shift"]): r["oper_h_total"] for r in features.failure_features(rows, m).collect()} for m in (1, 12, 1000)]
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("rows", [1, 2, 5, 100])
def test_fill_forward_across_blocks(spark, rows):
    data = [("a", i, v) for i, v in enumerate([None, "x", None, None, None, None, None, "y", None, None])] + [("b", 0, None), ("b", 9, "z")]
    df = spark.createDataFrame(data, "k string, ord int, v string")
    got = blocks.fill_forward(df, ["k"], "ord", F.col("v"), "filled", rows)
    by_key = {(r["k"], r["ord"]): r["filled"] for r in got.collect()}
    assert [by_key["a", i] for i in range(10)] == [None] + ["x"] * 6 + ["y"] * 3
    assert by_key["b", 0] is None and by_key["b", 9] == "z"


def test_label_coverage(spark):
    failure = features.failure_features(perf(spark, shifts("T1", 6, fails={2, 3})))
    process = features.process_features(telemetry(spark, [("A", datetime(2024, 1, 1, h)) for h in range(4)]))
    got = {r["tbl"]: r for r in features.label_coverage(failure, process).collect()}
    assert (got["failure"]["n_rows"], got["failure"]["labelled"], got["failure"]["positives"]) == (6, 5, 2)
    assert got["process"]["labelled_grade"] == 4
    assert features.training_rows(failure).count() == 5


def nameless(spark, n=3000):
    """Rows of no truck, many to a shift and some without a day, beside two trucks."""
    rng = random.Random(4)
    rows = [(None, None if rng.random() < 0.1 else date(2024, 1, 1) + timedelta(days=rng.randrange(300)), rng.choice(["Día", "Noche"]), rng.choice([0.0, 0.0, 1.1])) for _ in range(n)]
    full = [(t, d, s, "Andina", "M", 300.0, rng.random() * 12, rng.random(), f, rng.random(), 1.0) for t, d, s, f in rows + shifts("T1", 400, {7, 90}) + shifts("T2", 5)]
    return spark.createDataFrame(full, PERF)


def test_long_stretches_are_cut_by_rank_and_change_no_digit(spark):
    data = nameless(spark)
    want = sorted(map(tuple, features.failure_features(data, stretch_rows=10**9).collect()), key=str)
    for months, rows in ((12, 100), (1, 100), (12, 999), (12, 3)):
        assert sorted(map(tuple, features.failure_features(data, months, rows).collect()), key=str) == want
    assert len(want) == 3405


def test_rows_of_no_truck_are_spread_over_blocks_of_bounded_size(spark):
    data = nameless(spark).withColumns({"shift_ord": F.lit(1), "tie": F.xxhash64("oper_h"), "block": F.lit(7) * F.lit(features.CUTS)})
    cut = features._cut_by_rank(data, 100)
    sizes = {(r["truck"], r["block"] >> 32): [] for r in cut.select("truck", "block").distinct().collect()}
    for r in cut.groupBy("truck", "block").count().collect():
        sizes[r["truck"], r["block"] >> 32].append(r["count"])
    assert max(sizes[None, 7]) <= 100 and len(sizes[None, 7]) >= 30 and sum(sizes[None, 7]) == 3000
    assert sizes["T2", 7] == [5] and sum(sizes["T1", 7]) == 400


def test_ranks_over_the_whole_table(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(5)
    got = ranks.ranked(rows, [F.col("x").desc()], "rank")
    assert got.count() == 5000 and got.where("rank <> 4999 - x").count() == 0
    assert ranks.ranked(rows.where("false"), ["x"], "rank").count() == 0
    equal = spark.range(100).select(F.lit(1).alias("x"))
    assert sorted(r["rank"] for r in ranks.ranked(equal, ["x"], "rank").collect()) == list(range(100))


def test_features_of_a_folder_read_truck_shifts_as_a_build_stores_them(spark):
    """The aggregate and the join behind truck shifts were done again for each reader of their rows."""
    from verify.registry import QUERIES

    for name in ("ml_failure_features", "ml_failure_features_blocked", "ml_failure_features_ranked"):
        found = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_suppkey" not in found and "cyc_h" not in found
