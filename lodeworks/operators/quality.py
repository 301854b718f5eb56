"""Data-quality checks. Each returns the rows that break the rule; a suite returns counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FractionalType

from lodeworks.operators.dimension import orphans


# -- rules on one row: a Column that is true on a violation, never null ---------------------------


def null_rule(column: str) -> Column:
    return F.col(column).isNull()


def values_rule(column: str, values: Sequence) -> Column:
    """Outside the accepted values; null passes."""
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


def range_rule(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Outside the inclusive range; either end may be open; null passes."""
    x = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (x < low)
    if high is not None:
        broken = broken | (x > high)
    return F.coalesce(broken, F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(null_rule(column))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(values_rule(column, values))


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.where(range_rule(column, low, high))


def negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(range_rule(column, low=0))


# -- rules on keys ------------------------------------------------------------------------------


def duplicates(df: DataFrame, columns: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """Key values that occur more than once, with their row count.

    ``unique`` on one column skips nulls; a unique combination counts a null as a value. The count is
    summed per task before the shuffle, so a value that fills the table is still one row per task.
    """
    rows = df
    if skip_nulls:
        rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return rows.groupBy(*columns).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    return duplicates(df, [column], skip_nulls=True)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return duplicates(df, columns)


def relationships(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str, where: Column | None = None
) -> DataFrame:
    """Foreign-key values without a parent, and how many child rows hold each."""
    return orphans(child if where is None else child.where(where), parent, column, parent_column)


# -- reconciliation -----------------------------------------------------------------------------


def reconcile(
    parts: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    relative: float | None = None,
    absolute: float | None = None,
    strict: bool = False,
) -> DataFrame:
    """Keys where ``part_sum`` differs from ``published`` by more than the tolerance.

    As published, a key without a total row passes, and so does a null on either side. ``strict``
    reports those too.
    """
    both = parts.join(totals, list(keys), "left" if strict else "inner")
    gap = F.abs(F.col("part_sum") - F.col("published"))
    limit = F.lit(absolute) if absolute is not None else F.lit(relative) * F.col("published")
    broken = gap > limit
    if strict:
        broken = F.coalesce(broken, F.lit(True))
    return both.where(broken).select(*keys, "part_sum", "published")


# -- suites -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared test: kind is not_null, accepted_values, accepted_range, unique,
    unique_combination or relationships."""

    table: str
    kind: str
    columns: tuple[str, ...]
    args: Mapping = field(default_factory=dict)

    def row_rule(self) -> Column | None:
        name = self.columns[0]
        if self.kind == "not_null":
            return null_rule(name)
        if self.kind == "accepted_values":
            return values_rule(name, self.args["values"])
        if self.kind == "accepted_range":
            return range_rule(name, self.args.get("low"), self.args.get("high"))
        return None


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], bits: int = 64) -> DataFrame:
    """(tbl, test, col, n_bad) for every check.

    n_bad counts rows for row rules, and key values for uniqueness and relationships. All row rules of a table are
    counted in one pass over it. All key checks of all tables take one more pass over each table and share one
    shuffle of fingerprints of ``bits`` bits, which are combined per task before.
    """
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    parts: list[DataFrame] = []
    for name, group in by_table.items():
        counted = [(c, r) for c in group if (r := c.row_rule()) is not None]
        if counted:
            one = tables[name].agg(*[F.count_if(r).alias(str(i)) for i, (_, r) in enumerate(counted)])
            parts.append(one.select(F.inline(F.array(*[_line(c, F.col(str(i))) for i, (c, _) in enumerate(counted)]))))
    keyed = [c for c in checks if c.row_rule() is None]
    if keyed:
        parts.append(_key_counts(tables, keyed, bits))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class _Key:
    """What a check takes from each row of a table: the key's columns, typed as the other table's if there is one."""

    check: int
    columns: tuple[Column, ...]
    types: tuple[DataType, ...]
    known: bool
    counts: Column

    def fingerprint(self, bits: int) -> Column:
        """A hash of the values as they are typed: equal for equal values only of one check, NaN and -0.0 as Spark groups them.

        Which values are null is hashed too, as a hash passes over a null.
        """
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in self.columns])
        return F.shiftrightunsigned(F.xxhash64(F.lit(self.check), nulls, *self.columns), 64 - bits)

    def second(self) -> Column:
        """32 bits of another hash, by which different values of one fingerprint show."""
        return F.hash(F.lit("second"), *[F.coalesce(c.isNull(), F.lit(True)) for c in self.columns], *self.columns)

    def exact(self) -> Column:
        """The values as text, from which they can be told without doubt."""
        # adding zero makes -0.0 the zero that it equals
        plain = [c + F.lit(0).cast(t) if isinstance(t, FractionalType) else c for c, t in zip(self.columns, self.types, strict=True)]
        return F.to_json(F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(plain)]))


def _keys_of(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> dict[str, list[_Key]]:
    found: dict[str, list[_Key]] = {}

    def add(table: str, number: int, columns: Sequence[Column], known: bool, counts: Column) -> None:
        types = tuple(f.dataType for f in tables[table].select(*columns).schema)
        found.setdefault(table, []).append(_Key(number, tuple(columns), types, known, counts))

    for number, check in enumerate(checks):
        columns = [F.col(c) for c in check.columns]
        present = columns[0].isNotNull()
        if check.kind == "unique_combination":
            add(check.table, number, columns, False, F.lit(True))
        elif check.kind == "unique":
            add(check.table, number, columns, False, present)
        elif check.kind == "relationships":
            where, parent = check.args.get("where"), F.col(check.args["field"])
            mine, theirs = tables[check.table].schema[check.columns[0]].dataType, tables[check.args["to"]].schema[check.args["field"]].dataType
            # both sides as the one type that an equality of the two would compare
            add(check.table, number, [F.coalesce(columns[0], F.lit(None).cast(theirs))], False, present & F.coalesce(F.expr(where), F.lit(False)) if where else present)
            add(check.args["to"], number, [F.coalesce(parent, F.lit(None).cast(mine))], True, parent.isNotNull())
        else:
            raise ValueError(f"unknown check kind {check.kind!r}")
    return found


def _key_counts(tables: Mapping[str, DataFrame], checks: Sequence[Check], bits: int) -> DataFrame:
    """The lines of all key checks, in two levels.

    Fingerprints are counted first: a number, its count and 32 bits of a second hash are all that is shuffled of a key.
    Where two second hashes meet under one fingerprint, different keys do, and only these are counted again by their
    exact values. Of n keys n^2 / 2^65 fingerprints do so in the mean, 271 of 10^11, so they are broadcast.
    """
    of_table = _keys_of(tables, checks)
    session = next(iter(tables.values())).sparkSession
    related = F.col("check").isin([i for i, c in enumerate(checks) if c.kind == "relationships"])
    broken = F.when(related, (F.col("n") > 0) & ~F.col("known")).otherwise(F.col("n") > 1)
    totals = [F.count_if(~F.col("known")).alias("n"), F.bool_or("known").alias("known")]

    def entries(table: str, *values: tuple[str, object]) -> DataFrame:
        """(check, ``values``, known) of each row that counts for a check, an entry per check."""
        of_row = [
            F.when(k.counts, F.struct(F.lit(k.check).alias("check"), *[make(k).alias(name) for name, make in values], F.lit(k.known).alias("known")))
            for k in of_table[table]
        ]
        return tables[table].select(F.explode(F.array_compact(F.array(*of_row))).alias("e")).select("e.*")

    mark = ("mark", lambda k: k.fingerprint(bits))
    marks = reduce(DataFrame.unionByName, [entries(t, mark, ("second", _Key.second)) for t in of_table])
    counted = marks.groupBy("check", "mark").agg(*totals, F.min("second").alias("low"), F.max("second").alias("high"))
    shared = counted.where("low <> high").select("check", "mark")
    exact = reduce(DataFrame.unionByName, [entries(t, mark, ("key", _Key.exact)) for t in of_table])
    again = exact.join(F.broadcast(shared), ["check", "mark"], "left_semi").groupBy("check", "key").agg(*totals)
    every = session.range(len(checks)).select(F.col("id").cast("int").alias("check"), F.lit(0).cast("long").alias("n_bad"))
    sums = [d.groupBy("check").agg(F.count_if(broken).alias("n_bad")) for d in (counted.where("low = high"), again)]
    found = reduce(DataFrame.unionByName, sums, every).groupBy("check").agg(F.sum("n_bad").alias("n_bad"))
    lines = F.array(*[_line(c, F.lit(0)) for c in checks])
    return found.select(F.get(lines, F.col("check")).alias("line"), "n_bad").select("line.tbl", "line.test", "line.col", F.col("n_bad").cast("bigint"))


def _line(check: Check, n: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("tbl"),
        F.lit(check.kind).alias("test"),
        F.lit(",".join(check.columns)).alias("col"),
        n.cast("bigint").alias("n_bad"),
    )


# -- schema contract ----------------------------------------------------------------------------


class ContractError(RuntimeError):
    """The tables do not have what the contract promises; the message lists every gap."""


def contract_gaps(tables: Mapping[str, DataFrame], contract: Mapping[str, Sequence[str]]) -> dict[str, list[str] | None]:
    """Per contract table with a gap: its missing columns, or None when the whole table is missing.

    The gaps are the contract's (table, column) pairs less the pairs that the tables have.
    """
    promised = {(t, c) for t, columns in contract.items() for c in columns}
    lacking = promised.difference((t, c) for t, df in tables.items() for c in df.columns)
    absent = contract.keys() - tables.keys()
    incomplete = {t for t, _ in lacking} | absent
    return {t: None if t in absent else sorted(c for u, c in lacking if u == t) for t in contract if t in incomplete}


def require_contract(tables: Mapping[str, DataFrame], contract: Mapping[str, Sequence[str]]) -> None:
    """Raise one error that lists all missing tables and columns."""
    gaps = contract_gaps(tables, contract)
    if gaps:
        lines = [f"{t}: table is missing" if c is None else f"{t}: no column {', '.join(c)}" for t, c in gaps.items()]
        raise ContractError("schema contract broken:\n" + "\n".join(lines))


def contract_report(tables: Mapping[str, DataFrame], contract: Mapping[str, Sequence[str]]) -> DataFrame:
    """(tbl, n_rows, missing) for every present table of the contract."""
    gaps = contract_gaps(tables, contract)
    parts = [
        tables[name].agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("tbl"), "n_rows", F.lit(",".join(gaps.get(name) or [])).alias("missing")
        )
        for name in contract
        if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)
