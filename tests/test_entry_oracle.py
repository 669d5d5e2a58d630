"""Driver contract and a Spark-vs-DuckDB comparison on the smallest tables."""

import subprocess
import sys
import os

import __spark_entry__ as entry_mod

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["channel_group", "channel_category", "orders", "revenue", "customers"]


def model_keys():
    """The registered queries apart from the text operators', which have tests of their own."""
    return [k for k in entry_mod.queries() if k not in entry_mod.TEXT_QUERIES]


def test_every_query_has_an_oracle():
    assert set(model_keys()) <= set(entry_mod.oracle_sql())


def test_oracle_agreement_all_keys_sf0001():
    """Every registered query against its DuckDB twin on the smallest tables."""
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "scripts", "check_oracle.py"), "/root/testdata/sf0.001", *model_keys()],
        capture_output=True, text=True, timeout=2400,
    )
    assert out.stdout.count(" OK ") == len(model_keys()), out.stdout[-3000:]
    assert "mismatches: 0" in out.stdout, out.stdout[-3000:]
