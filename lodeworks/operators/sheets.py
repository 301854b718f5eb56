"""Wide statistical sheets to long rows.

Input: one row per sheet row, ``(sheet, row_num, cells)``, with ``cells`` an array of
``struct<num double, txt string>``: ``num`` is set for a numeric cell, ``txt`` holds any cell's text. Row numbers
are unique within a sheet. The first cell is the label; its leading blanks give the hierarchy.

One sheet may hold much of the table, and there may be any number of sheets, so nothing is gathered by sheet but one
summary row for each block, a fixed range of row numbers:

* What a whole sheet shares (header, years, first footnote) is found from the blocks' summaries, and is kept once for
  each block that it covers. So it meets the rows by (sheet, block), of any number of sheets, and none is broadcast.
* A row's ancestors are a stack: the latest earlier rows of ever smaller indentation. A block is reduced to the stack
  that it leaves behind; the stacks of a sheet are composed block by block (a block takes away what is indented as
  much as its least indented row, and adds its own), which gives the stack that each block begins with. Its rows are
  then walked once. The plan is the same for two indentations or four hundred.
* Walking needs labels and indentations only. The wide rows are shuffled once, and sorted among these results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.text import clean_label, indent, is_blank, is_note, parse_value
from lodeworks.operators.blocks import BLOCK_ROWS, earlier_blocks, row_block
from lodeworks.session import scratch_folder
from lodeworks.sources.tables import write_table

# What makes a row the header row.
YEAR_RANGE = (1990, 2100)
MIN_YEARS = 3

KEYS = ["sheet", "block"]


def _is_year(cell: Column) -> Column:
    low, high = YEAR_RANGE
    return cell["num"].between(low, high) & (cell["num"] == F.floor(cell["num"]))


def year_columns(cells: Column) -> Column:
    """array<struct<pos, yr>> of a header row's year cells; null for any other row.

    Most rows are not headers: they cost one look at each cell and build no arrays.
    """
    placed = F.transform(cells, lambda c, i: F.struct(i.alias("pos"), c["num"].alias("num")))
    years = F.transform(F.filter(placed, _is_year), lambda c: F.struct(c["pos"].alias("pos"), c["num"].cast("int").alias("yr")))
    return F.when(F.size(F.filter(cells, _is_year)) >= MIN_YEARS, years)


def _label() -> Column:
    return F.get("cells", F.lit(0))["txt"]


def headers(rows: DataFrame) -> DataFrame:
    """(sheet, header_row, years): the first row with at least three numeric years."""
    return _first_years(rows.select("sheet", "row_num", year_columns(F.col("cells")).alias("years")))


def bad_sheets(rows: DataFrame) -> DataFrame:
    """(sheet, n_rows) of the sheets that have no header row."""
    has_header = F.max(year_columns(F.col("cells")).isNotNull())
    return (
        rows.groupBy("sheet")
        .agg(F.count("*").alias("n_rows"), has_header.alias("ok"))
        .where(~F.col("ok"))
        .select("sheet", "n_rows")
    )


def require_headers(rows: DataFrame) -> None:
    """Raise if any sheet lacks a header row; the message names the first few and their number."""
    bad = bad_sheets(rows)
    n = bad.count()
    if n:
        names = [r["sheet"] for r in bad.orderBy("sheet").limit(5).collect()]
        raise ValueError(f"{n} sheets have no year header, among them {', '.join(names)}")


def bounds(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(sheet, block, header_row, years, note_row) of every block of a good sheet that body rows may lie in.

    note_row is the sheet's first footnote after its header. A block's footnotes are kept until the header is known:
    no more numbers than a block has rows, and mostly none.
    """
    marks = rows.select("sheet", row_block("row_num", block_rows).alias("block"), "row_num", year_columns(F.col("cells")).alias("years"), is_note(_label()).alias("note"))
    at = F.when(F.col("years").isNotNull(), F.col("row_num"))
    here = marks.groupBy(*KEYS).agg(
        F.min(at).alias("first"), F.min_by("years", at).alias("years"), F.collect_list(F.when(F.col("note"), F.col("row_num"))).alias("notes")
    )
    sheet = Window.partitionBy("sheet")
    found = here.withColumns({"header_row": F.min("first").over(sheet), "years": F.min_by("years", "first").over(sheet)})
    after = F.array_min(F.filter("notes", lambda n: n > F.col("header_row")))
    found = found.withColumn("note_row", F.min(after).over(sheet)).select(*KEYS, "header_row", "years", "note_row")
    covered = (F.col("block") + block_rows > F.col("header_row")) & (F.col("note_row").isNull() | (F.col("block") <= F.col("note_row")))
    return found.where(covered)


def _first_years(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("years").isNotNull())
        .groupBy("sheet")
        .agg(F.min("row_num").alias("header_row"), F.min_by("years", "row_num").alias("years"))
    )


def _kept_bounds(rows: DataFrame, block_rows: int) -> DataFrame:
    return write_table(bounds(rows, block_rows), scratch_folder(rows.sparkSession, "sheet-bounds"))


def _open_body(rows: DataFrame, limits: DataFrame, block_rows: int) -> DataFrame:
    """(sheet, block, row_num, label, level_indent) of the labelled rows between header and first footnote."""
    block, label = row_block("row_num", block_rows).alias("block"), clean_label(_label()).alias("label")
    labelled = rows.where(~is_blank(_label())).select("sheet", block, "row_num", label, indent(_label()).alias("level_indent"))
    both = labelled.join(limits.select(*KEYS, "header_row", "note_row").hint("merge"), KEYS)
    inside = (F.col("row_num") > F.col("header_row")) & (F.col("note_row").isNull() | (F.col("row_num") < F.col("note_row")))
    return both.where(inside).drop("header_row", "note_row")


def body(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(sheet, ord, row_num, label, level_indent): labelled body rows, numbered from 1 per sheet."""
    named = _open_body(rows, _kept_bounds(rows, block_rows), block_rows)
    counts = named.groupBy(*KEYS).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(earlier_blocks(["sheet"], "block")), F.lit(0))
    state = counts.select(*KEYS, before.alias("rows_before"))
    number = F.col("rows_before") + F.row_number().over(Window.partitionBy(*KEYS).orderBy("row_num"))
    return named.join(state.hint("merge"), KEYS).select("sheet", number.cast("int").alias("ord"), "row_num", "label", "level_indent")


def hierarchy(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(sheet, ord, label, parent, grp, lvl, cells, years): body rows with parent, root and number of ancestors.

    A row's parent is the nearest earlier row that is indented less; ``grp`` is its first ancestor, or itself.
    """
    limits = _kept_bounds(rows, block_rows)
    named = _open_body(rows, limits, block_rows)
    placed = named.unionByName(_stacks(named), allowMissingColumns=True).repartition(*KEYS).sortWithinPartitions(*KEYS, "row_num")
    found = placed.select("sheet", "block", "row_num", "label", "level_indent", "rows_before").mapInArrow(_walked, WALKED)

    # results, wide rows and years of a block meet by order: the years first, then each result before its wide row
    place = F.struct("row_num", "ord", "label", "parent", "grp", "lvl")
    block = row_block("row_num", block_rows).alias("block")
    wide = rows.where(~is_blank(_label())).select("sheet", block, "row_num", F.lit(1).alias("kind"), "cells")
    every = (
        wide.unionByName(found.select(*KEYS, "row_num", F.lit(0).alias("kind"), place.alias("place")), allowMissingColumns=True)
        .unionByName(limits.select(*KEYS, "years"), allowMissingColumns=True)
        .repartition(*KEYS)
    )
    run = Window.partitionBy(*KEYS).orderBy(F.col("row_num").asc_nulls_first(), "kind")
    years = F.max("years").over(run.rowsBetween(Window.unboundedPreceding, 0))
    met = every.select("kind", "sheet", "row_num", "cells", years.alias("years"), F.lag("place").over(run).alias("p"))
    mine = (F.col("kind") == 1) & (F.col("p.row_num") == F.col("row_num"))
    return met.where(mine).select("sheet", "p.ord", "p.label", "p.parent", "p.grp", "p.lvl", "cells", "years")


def _stacks(named: DataFrame) -> DataFrame:
    """(sheet, block, row_num, label, level_indent, rows_before): the ancestors that a block begins with.

    A block leaves those of its rows behind that every later one of its rows is indented more than.
    """
    later = Window.partitionBy(*KEYS).orderBy(F.desc("row_num")).rowsBetween(Window.unboundedPreceding, -1)
    least = F.min("level_indent").over(later)
    entry = F.struct(F.col("row_num"), F.col("level_indent"), F.col("label"))
    left = F.when(least.isNull() | (F.col("level_indent") < least), entry)
    summary = named.withColumn("left", left).groupBy(*KEYS).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("left")).alias("stack"))
    # a sheet of one block hands nothing on; most sheets are that small, and need not be seen by Python
    ordered = summary.repartition("sheet").sortWithinPartitions(*KEYS).withColumn("blocks", F.count("*").over(Window.partitionBy("sheet")))
    return ordered.where(F.col("blocks") > 1).drop("blocks").mapInArrow(_composed, STACKS)


STACKS = "sheet string, block long, row_num long, level_indent int, label string, rows_before long"
WALKED = "sheet string, block long, row_num long, ord int, label string, parent string, grp string, lvl int"


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sheet, block, n, stack) in order, to the stack before each block: one stack is held at a time."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
    current, stack, before = None, [], 0
    for batch in batches:
        out = []
        entries = batch.column(3).flatten()
        left = list(zip(*[entries.field(c).to_pylist() for c in ("row_num", "level_indent", "label")], strict=True))
        sizes = batch.column(3).value_lengths().to_pylist()
        start = 0
        for sheet, block, n, size in zip(*[c.to_pylist() for c in batch.columns[:3]], sizes, strict=True):
            if sheet != current:
                current, stack, before = sheet, [], 0
            out += [(sheet, block, *entry, before) for entry in stack]
            own = left[start : start + size]
            stack = [e for e in stack if e[1] < own[0][1]] + own
            before += n
            start += size
        columns = list(zip(*out, strict=True)) or [()] * len(types)
        names = [c.split()[0] for c in STACKS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (sheet, block) in order, each block's stack before them, to number, parent, root and level.

    The walk is over numbers; labels stay in Arrow and are taken by their places.
    """
    current, levels, labels, n = None, [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sheet, block, row, label, level, before = batch.columns
        known = label if labels is None else pa.concat_arrays([labels, label])  # of the open stack, then of the batch
        same = pc.and_(pc.equal(sheet[1:], sheet[:-1]), pc.equal(block[1:], block[:-1])).to_pylist()
        same.insert(0, (sheet[0].as_py(), block[0].as_py()) == current)
        held = len(levels)
        stack = list(zip(levels, range(held), strict=True))
        own, number, parent, root, depth = [], [], [], [], []
        places = range(held, held + batch.num_rows)
        for i, goes_on, indented, rows_before in zip(places, same, level.to_pylist(), before.to_pylist(), strict=True):
            if not goes_on:
                stack, n = [], 0
            if rows_before is not None:
                n = rows_before
            else:
                while stack and stack[-1][0] >= indented:
                    stack.pop()
                n += 1
                own.append(i - held)
                number.append(n)
                parent.append(stack[-1][1] if stack else None)
                root.append(stack[0][1] if stack else i)
                depth.append(len(stack))
            stack.append((indented, i))
        kept = pa.array(own, pa.int64())
        named = [known.take(pa.array(at, pa.int64())) for at in (parent, root)]
        columns = [sheet.take(kept), block.take(kept), row.take(kept), pa.array(number, pa.int32()), label.take(kept), *named, pa.array(depth, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in WALKED.split(", ")])
        current, levels = (sheet[-1].as_py(), block[-1].as_py()), [indented for indented, _ in stack]
        labels = known.take(pa.array([i for _, i in stack], pa.int64()))


def unpivot(rows: DataFrame, units: dict[str, str] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per (body row, year column), title-only rows included; short rows give nulls."""
    return _long(hierarchy(rows, block_rows), units)


def parse_sheets(
    rows: DataFrame, units: dict[str, str] | None = None, block_rows: int = BLOCK_ROWS, strict: bool = False
) -> DataFrame:
    """Long table of all good sheets without title-only rows, whose ``ord`` stays a gap.

    Sheets without a header row are left out, or with ``strict`` raise an error (see ``bad_sheets``).

    A title-only row has no cell in any year column. That shows on the wide row, so rows are dropped
    before they are unpivoted.
    """
    if strict:
        require_headers(rows)
    wide = hierarchy(rows, block_rows)
    filled = F.exists("years", lambda y: F.get("cells", y["pos"])["txt"].isNotNull() | F.get("cells", y["pos"])["num"].isNotNull())
    return _long(wide.where(filled), units)


def _long(wide: DataFrame, units: dict[str, str] | None) -> DataFrame:
    cell = F.get("cells", F.col("y.pos"))
    unit = F.lit(None).cast("string")
    if units:
        unit = F.try_element_at(F.create_map(*[F.lit(x) for kv in units.items() for x in kv]), F.col("sheet"))
    return wide.withColumn("y", F.explode("years")).select(
        F.col("sheet").alias("tab"),
        "ord",
        "lvl",
        "label",
        "parent",
        "grp",
        F.col("y.yr").alias("yr"),
        parse_value(cell["num"], cell["txt"]).alias("value"),
        cell["txt"].alias("value_text"),
        unit.alias("unit"),
    )
