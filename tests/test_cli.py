"""The command line: check and report on the smallest tables."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    return subprocess.run([sys.executable, "-m", "tidewater", *args], cwd=ROOT, capture_output=True, text=True,
                          timeout=900)


def test_check_passes():
    out = run("check", "--tables", "/root/testdata/sf0.001")
    assert out.returncode == 0, out.stdout[-2000:] + out.stderr[-2000:]
    assert "0 failing check(s)" in out.stdout


def test_report_prints_rows():
    out = run("report", "channel_revenue", "--tables", "/root/testdata/sf0.001", "--limit", "3")
    assert out.returncode == 0, out.stderr[-2000:]
    assert "channel_group" in out.stdout and "unattributed" in out.stdout


def test_layout_and_dated_report(tmp_path):
    root = str(tmp_path / "raw")
    out = run("layout", "--tables", "/root/testdata/sf0.001", "--out", root, "--buckets", "4")
    assert out.returncode == 0, out.stderr[-2000:]
    out = run("report", "revenue_daily", "--layout", root, "--from", "1997-02-10", "--to", "1997-02-20")
    assert out.returncode == 0, out.stderr[-2000:]
    assert "1997-02-1" in out.stdout and "1997-02-20" not in out.stdout and "1997-03" not in out.stdout
    assert run("report", "revenue_daily", "--layout", root, "--from", "1997-02-10").returncode == 2
