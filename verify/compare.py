"""Run registered queries against their oracles: ``python -m verify.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from lodeworks.session import local_session
from verify.oracles import ORACLES
from verify.registry import QUERIES


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def canonical(rows, order):
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def compare(spark, con, sf: str, name: str) -> str | None:
    """None when the query's columns and rows equal the oracle's, else what differs."""
    df = QUERIES[name](spark, sf)
    got, names = [tuple(r) for r in df.collect()], df.columns
    if name not in ORACLES:
        return None if got or name.startswith("dq_") else "no rows"
    cur = con.execute(ORACLES[name])
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} vs {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    cols = sorted(names)
    a = canonical(got, [names.index(c) for c in cols])
    b = canonical(want, [want_names.index(c) for c in cols])
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, e.g. {cols}: {bad[0][0]} vs {bad[0][1]}" if bad else None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal; without oracle: {[n for n in names if n not in ORACLES]}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
