"""As-of join: edge cases and brute-force comparison, including a hot key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidewater.operators import asof
from tidewater.operators.asof import asof_last_before

COLS = {"event_id": "m_id", "tag": "m_tag", "t": "m_t"}


def brute(left, right):
    out = {}
    for lid, key, lt in left:
        best = None
        for eid, rkey, rt, tag in right:
            if rkey == key and key is not None and rt is not None and lt is not None and rt < lt:
                if best is None or (rt, eid) > (best[2], best[0]):
                    best = (eid, tag, rt)
        out[lid] = best
    return out


def run(spark, left, right, bucket, target_rows=1_000_000):
    l_df = spark.createDataFrame(left, "lid long, k long, lt timestamp_ntz")
    r_df = spark.createDataFrame(right, "event_id long, k long, t timestamp_ntz, tag string")
    res = asof_last_before(l_df, r_df, by="k", left_time="lt", right_time="t", right_tiebreak="event_id",
                           right_cols=COLS, bucket_seconds=bucket, target_rows=target_rows)
    return {r.lid: (None if r.m_id is None else (r.m_id, r.m_tag, r.m_t)) for r in res.collect()}


def t(day, sec=0):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day, seconds=sec)


def test_edge_cases(spark):
    left = [
        (1, 10, t(5)),          # equal-time event must not match; earlier one does
        (2, 10, t(3)),          # two events at the same time: higher event_id
        (3, 20, t(1)),          # only a later event
        (4, 30, t(9)),          # no events for key
        (5, None, t(9)),        # NULL key never matches
        (6, 10, None),          # NULL time never matches
        (7, 10, t(40)),         # match carried from many buckets back
    ]
    right = [
        (100, 10, t(5), "same_time"),
        (101, 10, t(4), "before"),
        (102, 10, t(2), "tie_low"),
        (103, 10, t(2), "tie_high"),
        (104, 20, t(2), "later"),
        (105, None, t(0), "null_key"),
    ]
    got = run(spark, left, right, 86400)
    assert got[1][0] == 101
    assert got[2][0] == 103
    assert got[3] is None and got[4] is None and got[5] is None and got[6] is None
    assert got[7][0] == 100
    assert got == brute(left, right)


def test_random_against_brute_force_with_hot_key(spark):
    rng = random.Random(7)
    left, right = [], []
    for i in range(400):
        key = 1 if i % 3 == 0 else rng.randint(2, 30)  # key 1 holds a third of the rows
        left.append((i, key, t(rng.randint(0, 60), rng.randint(0, 5) * 3600)))
    for j in range(600):
        key = 1 if j % 3 == 0 else rng.randint(2, 30)
        right.append((1000 + j, key, t(rng.randint(0, 60), rng.randint(0, 5) * 3600), f"x{j}"))
    want = brute(left, right)
    for bucket in (3600, 86400, 7 * 86400, 10**9):
        assert run(spark, left, right, bucket) == want
    # data-derived width: the hot key (~333 rows) is cut into ~333/target buckets
    for target in (5, 40, 10**6):
        assert run(spark, left, right, None, target_rows=target) == want


def test_only_hot_keys_are_split(spark):
    from tidewater.operators.asof import _hot_keys
    rows = [(1, i * 1_000_000) for i in range(100)] + [(2, i) for i in range(5)]
    df = spark.createDataFrame(rows, "_key long, _us long")
    hot = {r._hk: r for r in _hot_keys(df, target_rows=10, max_hot_keys=1000).collect()}
    assert set(hot) == {1}
    # quantiles of the key's own times: every one of its 100 distinct times but the last bounds a bucket
    assert list(hot[1]._hbounds) == sorted(set(hot[1]._hbounds)) and 90 <= len(hot[1]._hbounds) <= 100
    # the target rises with the total so the hot-key table stays bounded
    assert _hot_keys(df, target_rows=10, max_hot_keys=1).count() == 0


def test_hot_key_is_split_across_buckets(spark):
    """The per-(key, bucket) window partitions a hot key by time bucket."""
    left = spark.createDataFrame([(i, 1, t(i)) for i in range(20)], "lid long, k long, lt timestamp_ntz")
    right = spark.createDataFrame([(i, 1, t(i, 1), "e") for i in range(20)],
                                  "event_id long, k long, t timestamp_ntz, tag string")
    res = asof_last_before(left, right, by="k", left_time="lt", right_time="t", right_tiebreak="event_id",
                           right_cols=COLS, bucket_seconds=86400)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_b" in plan
    got = {r.lid: r.m_id for r in res.collect()}
    assert got[0] is None and all(got[i] == i - 1 for i in range(1, 20))


def test_result_does_not_depend_on_shuffle_partitions(spark):
    rng = random.Random(5)
    left = [(i, rng.randint(1, 4), t(rng.randint(0, 20), rng.randint(0, 3) * 600)) for i in range(120)]
    right = [(500 + j, rng.randint(1, 4), t(rng.randint(0, 20), rng.randint(0, 3) * 600), "r") for j in range(160)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = {}
    try:
        for parts in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got[parts] = run(spark, left, right, None, target_rows=10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got["1"] == got["37"] == brute(left, right)


def instants(n=3000):
    """One key; a third of its rows on either side at one instant, another instant with right rows only."""
    rng = random.Random(4)
    left = [(i, 1, t(100) if i % 3 == 0 else t(rng.randrange(200), rng.randrange(86400))) for i in range(n)]
    right = [(i, 1, t(100) if i % 3 == 0 else t(50) if i % 3 == 1 else t(rng.randrange(200), rng.randrange(86400)), f"e{i}") for i in range(n)]
    left += [(n + i, 2 + i % 50, t(rng.randrange(200))) for i in range(200)]
    right += [(n + i, 2 + i % 50, t(rng.randrange(200)), f"e{n + i}") for i in range(200)]
    return left, right


def test_a_third_of_the_rows_at_one_instant(spark):
    left, right = instants()
    got = run(spark, left, right, None, target_rows=100)
    best = {}  # the latest right row strictly before: by key, over rows sorted by (time, id)
    by_key = {}
    for e in right:
        by_key.setdefault(e[1], []).append((e[2], e[0], e[3]))
    for k in by_key:
        by_key[k].sort()
    import bisect

    for lid, k, lt in left:
        rows = by_key.get(k, [])
        at = bisect.bisect_left(rows, (lt,))
        best[lid] = (rows[at - 1][1], rows[at - 1][2], rows[at - 1][0]) if at else None
    assert got == best


def test_an_instant_is_split(spark):
    """No window partition holds more than a small share of the hot key's rows."""
    left, right = instants()
    rows = [(i, k, lt, None, 0) for i, k, lt in left] + [(i, k, rt, i, 1) for i, k, rt, _ in right]
    both = spark.createDataFrame(rows, "lid long, _key long, _t timestamp_ntz, _tie long, _side int").selectExpr(
        "lid", "_key", "_side", "unix_micros(cast(_t as timestamp)) _us")
    parts = asof.in_buckets(both, ["lid"], None, 100)
    used = parts.where("_side = 0 or _subs = 0").groupBy("_key", "_b", "_sub").count()
    assert used.agg(F.max("count")).first()[0] <= 8 * len(rows) // asof.PARTS
    hot = parts.where("_key = 1 and _us = %d" % (t(100) - t(0) + (t(0) - dt.datetime(1970, 1, 1))).__floordiv__(dt.timedelta(microseconds=1)))
    assert hot.where("_side = 0").select("_sub").distinct().count() > 20
    assert hot.select("_b").distinct().count() == 1


def test_sources_are_read_once(spark):
    from tidewater.registry import model_graph

    plan = model_graph(spark, "/root/testdata/sf0.001").int_orders_attributed._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "/asof-" in plan  # the match reads the narrow working table only
