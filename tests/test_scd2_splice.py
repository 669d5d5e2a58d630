"""Snapshots in any order of arrival give the history of their time order."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.scd2 import OPEN_END, scd2_initial, scd2_splice

T = [dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1), dt.datetime(2020, 4, 1)]
SCHEMA = "id long, seg string, note string"


def brute(snaps):
    """(id, seg, from, to) by walking each key through the snapshots in time order."""
    times, out = sorted(snaps), []
    for k in {r[0] for rows in snaps.values() for r in rows}:
        open_ = None
        for t in times:
            seg = {r[0]: (r[1],) for r in snaps[t]}.get(k)
            if open_ and (seg is None or seg[0] != open_[0]):
                out.append((k, open_[0], open_[1], t))
                open_ = None
            if seg and not open_:
                open_ = (seg[0], t)
        if open_:
            out.append((k, open_[0], open_[1], OPEN_END))
    return sorted(out, key=repr)


def spliced(spark, snaps, arrival):
    frame = lambda t: spark.createDataFrame(snaps[t], SCHEMA)
    h = scd2_initial(frame(arrival[0]), key="id", effective_from=F.lit(arrival[0]).cast("timestamp_ntz"))
    for n, t in enumerate(arrival[1:], 1):
        h = scd2_splice(h, frame(t), key="id", tracked=["seg"], at=t, observed=list(arrival[:n]))
    return h


@pytest.mark.parametrize("arrival", [(0, 1, 2, 3), (0, 2, 1, 3), (3, 2, 1, 0), (1, 3, 0, 2), (0, 3, 1, 1)])
def test_order_of_arrival_does_not_matter(spark, arrival):
    rng = random.Random(7)
    snaps = {t: [(k, rng.choice(["A", "B", None]), f"{k}-{i}") for k in [*range(30), None] if rng.random() < 0.7] for i, t in enumerate(T)}
    order = [T[i] for i in arrival]  # the last case delivers one snapshot twice
    h = spliced(spark, snaps, order)
    got = sorted(((r.id, r.seg, r.effective_from, r.effective_to) for r in h.collect()), key=repr)
    assert got == brute({t: snaps[t] for t in order})
    assert h.where("is_current <> (effective_to = timestamp_ntz'9999-12-31')").count() == 0
    assert h.select("history_key").distinct().count() == h.count()


def test_cases(spark):
    snaps = {T[0]: [(1, "A", "x"), (2, "A", "x")], T[2]: [(1, "A", "z"), (3, "C", "z")], T[1]: [(1, "B", "y"), (3, "C", "y")]}
    rows = spliced(spark, snaps, [T[0], T[2], T[1]]).collect()
    assert sorted((r.id, r.seg, r.note, r.effective_from, r.effective_to) for r in rows) == [
        (1, "A", "x", T[0], T[1]), (1, "A", "x", T[2], OPEN_END),  # B was seen in between
        (1, "B", "y", T[1], T[2]),
        (2, "A", "x", T[0], T[1]),  # already gone in the late snapshot
        (3, "C", "y", T[1], OPEN_END),  # starts earlier than was known
    ]


def test_empty_snapshots(spark):
    for gone in itertools.product([0, 1], repeat=3):
        snaps = {t: [] if g else [(1, "A", "x")] for t, g in zip(T, gone)}
        got = [(r.id, r.seg, r.effective_from, r.effective_to) for r in spliced(spark, snaps, [T[2], T[0], T[1]]).collect()]
        assert sorted(got, key=repr) == brute(snaps)
