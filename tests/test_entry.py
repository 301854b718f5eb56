from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_warehouse_queries_stay_when_a_dependency_of_the_other_part_is_absent():
    code = """
import sys
sys.modules["public_tokenizers"] = None
import __spark_entry__ as e
from verify.registry import QUERIES
assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()), len(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
