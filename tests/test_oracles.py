"""Registered queries against their SQL, on the smallest driver data.

All of them take minutes (``python -m verify.compare`` runs them at any scale); the tests take one query of
each kind, or all if LODEWORKS_ALL_ORACLES is set.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
if not Path(SF).exists():
    pytest.skip("driver data not present", allow_module_level=True)

from verify.compare import compare, connect  # noqa: E402
from verify.oracles import ORACLES  # noqa: E402
from verify.registry import QUERIES  # noqa: E402

SOME = [
    "shift_kpis", "equipment_performance_salted", "ml_failure_features", "ml_process_features_bucketed", "yb_section_fill",
    "sector_year", "energy_cost_year", "yb_drop_title_rows", "dq_suite", "dq_reconcile_abs", "rpt_histogram_by_incident",
    "rpt_base_index", "src_csv_roundtrip",
]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("LODEWORKS_ALL_ORACLES") else SOME)
def test_query_equals_its_oracle(spark, con, name):
    assert compare(spark, con, SF, name) is None
