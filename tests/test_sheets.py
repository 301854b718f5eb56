from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodeworks import schemas
from lodeworks.operators import sheets


def cell(v):
    if v is None:
        return (None, None)
    if isinstance(v, (int, float)):
        return (float(v), str(v))
    return (None, v)


def table(spark, **named):
    rows = [
        (name, i, [cell(v) for v in row]) for name, lines in named.items() for i, row in enumerate(lines, start=1)
    ]
    return spark.createDataFrame(rows, schemas.SHEET_ROWS)


#: A made-up sheet with a title, a header, three levels, footnote marks, missing values and a closing note.
HARVEST = [
    ("Harvest by field, tonnes", None, None, None),
    (None, 2011, 2012, 2013),
    ("Cereals / Granos", 70, 72.5, 75),
    ("  Wheat (1)", 40, 41, "s.i."),
    ("    Winter   wheat", 31, "12,5", "about 9"),
    ("\xa0\xa0Rye", 30),
    ("Fruit", None, None, None),
    ("  Apples", 8, 9, 10),
    ("", 5, 5, 5),
    ("Sum", 78, 81.5, 85),
    ("(1) soft and hard", None, None, None),
    ("  Pears", 1, 2, 3),
]


@pytest.mark.parametrize("block_rows", [1, 2, 4, 500])
def test_sheet_to_long(spark, block_rows):
    got = sheets.parse_sheets(table(spark, farm=HARVEST), {"farm": "t"}, block_rows).collect()
    of = {(r["label"], r["yr"]): r.asDict() for r in got}
    tree = {label: (of[label, 2012]["ord"], of[label, 2012]["lvl"], of[label, 2012]["parent"], of[label, 2012]["grp"]) for label, _ in of}
    assert tree == {
        "Cereals": (1, 0, None, "Cereals"), "Wheat": (2, 1, "Cereals", "Cereals"), "Winter wheat": (3, 2, "Wheat", "Cereals"),
        "Rye": (4, 1, "Cereals", "Cereals"), "Apples": (6, 1, "Fruit", "Fruit"), "Sum": (7, 0, None, "Sum"),
    }
    assert len(got) == 6 * 3 and {r["unit"] for r in got} == {"t"}
    values = lambda label: [(of[label, y]["value"], of[label, y]["value_text"]) for y in (2011, 2012, 2013)]
    assert values("Wheat") == [(40.0, "40"), (41.0, "41"), (None, "s.i.")]
    assert [v for v, _ in values("Winter wheat")] == [31.0, 12.5, None] and values("Winter wheat")[2][1] == "about 9"
    assert values("Rye")[1:] == [(None, None)] * 2  # a short row


def test_title_only_rows_stay_before_they_are_dropped(spark):
    long = sheets.unpivot(table(spark, farm=HARVEST))
    assert long.count() == 7 * 3
    assert long.where("label = 'Fruit' and value is null and value_text is null").count() == 3


def test_text_years_are_no_header_and_bad_sheets_are_reported(spark):
    rows = table(
        spark, good=HARVEST, text=[("x", "2023", "2024", "2025")], two=[("x", 2023, 2024)], odd=[("x", 2023.5, 2024, 2025, 1899)]
    )
    assert {r["sheet"]: r["n_rows"] for r in sheets.bad_sheets(rows).collect()} == {"text": 1, "two": 1, "odd": 1}
    assert [r["sheet"] for r in sheets.headers(rows).collect()] == ["good"]
    assert {r["tab"] for r in sheets.parse_sheets(rows).collect()} == {"good"}
    with pytest.raises(ValueError, match="3 sheets"):
        sheets.require_headers(rows)
    sheets.require_headers(rows.where("sheet = 'good'"))


def test_note_before_the_header_does_not_end_the_sheet(spark):
    lines = [("Fuente: y", None, None, None), (None, 2001, 2002, 2003), ("a", 1, 2, 3), (None, 2004, 2005, 2006), ("b", 4, 5, 6)]
    for block_rows in (1, 2, 100):
        got = sheets.parse_sheets(table(spark, s=lines), block_rows=block_rows).collect()
        assert {(r["label"], r["yr"]) for r in got} == {(x, y) for x in "ab" for y in (2001, 2002, 2003)}


def expected_tree(indents):
    """Parent, root and level of each row; its parent is the nearest earlier row that is indented less."""
    parents = [max((j for j in range(i) if indents[j] < k), default=None) for i, k in enumerate(indents)]

    def line(i):
        return [i] if parents[i] is None else [*line(parents[i]), i]

    return [(parents[i], line(i)[0], len(line(i)) - 1) for i in range(len(indents))]


@pytest.mark.parametrize("block_rows", [3, 50, 10_000])
def test_hierarchy_of_random_sheets_with_one_that_holds_most_rows(spark, block_rows):
    rng = random.Random(11)
    named, want = {}, {}
    for s in range(12):
        n = 600 if s == 0 else rng.randint(1, 40)
        indents = [rng.choice([0, 2, 4, 4, 7, 9, 12]) for _ in range(n)]
        named[f"s{s}"] = [(None, 2001, 2002, 2003)] + [(" " * k + f"r{i}", 1, 1, 1) for i, k in enumerate(indents)]
        for i, (parent, root, level) in enumerate(expected_tree(indents)):
            want[f"s{s}", i + 1] = (f"r{i}", None if parent is None else f"r{parent}", f"r{root}", level)
    got = sheets.hierarchy(table(spark, **named), block_rows).collect()
    assert {(r["sheet"], r["ord"]): (r["label"], r["parent"], r["grp"], r["lvl"]) for r in got} == want


def test_body_numbers_rows_across_blocks(spark):
    lines = [(None, 2001, 2002, 2003)] + [(f"r{i}" if i % 3 else None, 1, 1, 1) for i in range(30)]
    got = sheets.body(table(spark, s=lines), 4).orderBy("row_num").collect()
    assert [r["ord"] for r in got] == list(range(1, 21))


def test_hundreds_of_indentations(spark):
    rng = random.Random(5)
    indents = [rng.randint(0, 400) for _ in range(1500)]
    rows = [(None, 2001, 2002, 2003)] + [(" " * k + f"r{i}", 1, 1, 1) for i, k in enumerate(indents)]
    want = {i + 1: (f"r{i}", None if p is None else f"r{p}", f"r{g}", lvl) for i, (p, g, lvl) in enumerate(expected_tree(indents))}
    few = [(None, 2001, 2002, 2003)] + [(" " * (k % 2) + f"r{i}", 1, 1, 1) for i, k in enumerate(indents)]
    for block_rows in (64, 5000):
        got = sheets.hierarchy(table(spark, s=rows), block_rows)
        assert {r["ord"]: (r["label"], r["parent"], r["grp"], r["lvl"]) for r in got.collect()} == want
        text = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
        assert text(got) == text(sheets.hierarchy(table(spark, s=few), block_rows))


def test_headers_and_notes_in_other_blocks_than_the_body(spark):
    """Sheets of many blocks: a header late, notes before it in its own block, blocks without any body row, no sheet name."""
    lines = [("Fuente a", None, None, None)] * 5 + [("Fuente: b", None, None, None), (None, 2001, 2002, 2003), ("(1) at once", None, None, None), ("late", 1, 2, 3)]
    other = [(None, 2001, 2002, 2003)] + [(None, 1, 1, 1)] * 20 + [("a", 1, 2, 3)] + [(" ", 1, 1, 1)] * 9 + [("  b", 4, 5, 6), ("n.d. x", 1, 1, 1), ("c", 1, 1, 1)]
    for block_rows in (1, 3, 7, 100):
        rows = table(spark, cut=lines, sparse=other).withColumn("sheet", F.when(F.col("sheet") != "sparse", F.col("sheet")))
        named = rows.where("sheet is not null").unionByName(table(spark, sparse=other))
        got = [(r["sheet"], r["ord"], r["label"], r["parent"], r["lvl"]) for r in sheets.hierarchy(named, block_rows).collect()]
        assert sorted(got) == [("sparse", 1, "a", None, 0), ("sparse", 2, "b", "a", 1)]
        limits = {(r["sheet"], r["header_row"], r["note_row"]) for r in sheets.bounds(named, block_rows).collect()}
        assert limits == {("cut", 7, 8), ("sparse", 1, 33)}


def test_many_small_sheets_take_the_same_plan_and_give_the_same_rows(spark):
    one = table(spark, farm=HARVEST)
    many = spark.range(2_000).select(F.concat(F.lit("s"), "id").alias("name")).crossJoin(F.broadcast(one)).select(F.col("name").alias("sheet"), "row_num", "cells")
    got = sheets.hierarchy(many).groupBy("ord", "label", "parent", "grp", "lvl").count().collect()
    assert len(got) == 7 and {r["count"] for r in got} == {2_000}


def test_walk_is_the_same_for_any_batches():
    """A block may go on in a later batch, with its stack; labels are taken by place from both."""
    import pyarrow as pa

    rng = random.Random(3)
    schema = pa.schema([("sheet", pa.string()), ("block", pa.int64()), ("row_num", pa.int64()), ("label", pa.string()), ("level_indent", pa.int32()), ("rows_before", pa.int64())])
    rows, want = [], []
    for sheet, block in [("a", 0), ("a", 10), ("b", 10), ("c", 0)]:
        stack, n = [], 0
        if block and sheet == "a":  # two ancestors and seven rows from the blocks before
            stack, n = [(0, "a-top"), (2, "a-sub")], 7
            rows += [(sheet, block, i, label, level, 7) for i, (level, label) in enumerate(stack)]
        for i in range(9):
            level, label = rng.choice([0, 2, 4, 6]), f"{sheet}{block}-{i}"
            rows.append((sheet, block, block + i, label, level, None))
            stack, n = [e for e in stack if e[0] < level], n + 1
            want.append((sheet, block, block + i, n, label, stack[-1][1] if stack else None, stack[0][1] if stack else label, len(stack)))
            stack.append((level, label))
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows[i : i + size]], schema=schema) for i in range(0, len(rows), size)]
        assert [tuple(r.values()) for b in sheets._walked(iter([*batches, batches[0][:0]])) for r in b.to_pylist()] == want


def test_only_sheets_of_several_blocks_are_composed_in_python(spark):
    named = spark.createDataFrame([("one", 0, 1, "x", 0), ("two", 0, 1, "y", 0), ("two", 10, 11, "z", 2)], "sheet string, block long, row_num long, label string, level_indent int")
    found = sheets._stacks(named)
    assert "(blocks" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("two", 10, 1, 0, "y", 1)]


def test_sheets_made_of_a_small_file_are_dealt_over_all_tasks(spark, tmp_path):
    """The rows of a file of one task were all written by that task, and read by one again."""
    from verify import fixtures

    spark.range(400).selectExpr("id as c_custkey", "0e0 as c_acctbal").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([], fixtures.DRIVER_TABLES["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    rows = fixtures.sheet_rows(spark, str(tmp_path))
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert sum(held) == 4_800 and len(held) >= 4 and max(held) < 2_400
