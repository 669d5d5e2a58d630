"""Missing and repeated ids, sub-cent money, stored marts, shared folder."""

import datetime as dt
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import customer, item, order, raw
from tidewater import session
from tidewater.functions.numeric import money_sum
from tidewater.operators.asof import asof_last_before
from tidewater.operators.scd2 import scd2_initial, scd2_merge
from tidewater.params import RunParams
from tidewater.plans.graph import ModelGraph
from tidewater.registry import model_graph

SF = "/root/testdata/sf0.001"


def graph(spark, customers, orders=(), items=()):
    return ModelGraph(spark, raw(spark, customers=customers, orders=orders, items=items), RunParams(as_of=dt.datetime(2000, 6, 1)))


def test_customers_without_or_with_repeated_id_keep_a_row(spark):
    rows = [customer(1), customer(2), (None, *customer(3)[1:]), customer(2)]
    g = graph(spark, rows, [order(1, 1, "2000-03-01 00:00:00")], [item(1, 1)])
    scored = g.int_customers_rfm_scored
    assert sorted((r.customer_id is None, r.customer_id or 0) for r in scored.collect()) == [
        (False, 1), (False, 2), (False, 2), (True, 0)]
    failures = {(r.kind, r.model, r.column_name): r.failures for r in g.check_results(("unique", "not_null")).collect()}
    assert failures["unique", "int_customers_rfm_scored", "customer_id"] == 1
    assert failures["not_null", "int_customers_rfm_scored", "customer_id"] == 1


def test_sub_cent_and_negative_money(spark):
    df = spark.createDataFrame([(12.345,), (12.345,), (-0.005,), (-0.0001,), (None,)], "x double")
    assert df.agg(money_sum(F.col("x")).alias("s")).first().s == 24.6849


def test_scd2_compares_columns_and_keeps_null_keys_once(spark):
    at = [dt.datetime(2000, 1, 1), dt.datetime(2001, 1, 1)]
    old = spark.createDataFrame([(1, "a-b", "c"), (2, None, "x"), (None, "n", "n"), (3, "s", None)], "id long, p string, q string")
    new = spark.createDataFrame([(1, "a", "b-c"), (2, None, "x"), (None, "n", "n"), (3, "s", "t"), (4, "z", "z")], "id long, p string, q string")
    first = scd2_initial(old, key="id", effective_from=F.lit(at[0]).cast("timestamp_ntz"))
    out = scd2_merge(first, new, key="id", tracked=["p", "q"], change_at=at[1])
    got = sorted((r.id is None, r.id or 0, r.is_current, r.p or "", r.q or "") for r in out.collect())
    assert got == [
        (False, 1, False, "a-b", "c"), (False, 1, True, "a", "b-c"), (False, 2, True, "", "x"),
        (False, 3, False, "s", ""), (False, 3, True, "s", "t"), (False, 4, True, "z", "z"), (True, 0, True, "n", "n"),
    ]


def test_asof_keyless_rows_and_bunched_times(spark):
    start = dt.datetime(2000, 1, 1)
    orders = [(i, 1 if i % 2 else None, start + dt.timedelta(days=0 if i == 1 else 400, seconds=i % 60)) for i in range(600)]
    touches = [(i, 1, start + dt.timedelta(days=400, seconds=i % 50), f"c{i}") for i in range(300)]
    left = spark.createDataFrame(orders, "oid long, k long, t timestamp_ntz")
    right = spark.createDataFrame(touches, "eid long, k long, et timestamp_ntz, ch string")
    got = asof_last_before(left, right, by="k", left_time="t", right_time="et", right_tiebreak="eid",
                           right_cols={"eid": "hit"}, target_rows=50)
    best = {}
    for oid, k, t in orders:
        seen = [(et, eid) for eid, ek, et, _ in touches if ek == k and et < t]
        best[oid] = max(seen)[1] if seen else None
    assert {r.oid: r.hit for r in got.collect()} == best


def test_reports_over_stored_marts_are_the_same(spark):
    built = model_graph(spark, SF)
    folder = tempfile.mkdtemp(prefix="tw-marts-")
    built.write_models(folder)
    opened = model_graph(spark, SF)
    assert opened.open_models(folder) == list(ModelGraph.MODEL_ORDER)
    for name in ("channel_revenue", "revenue_daily", "segment_details", "kpi_summary"):
        assert opened.report(name).collect() == model_graph(spark, SF).report(name).collect()
    assert all(folder in f for f in opened.fct_orders.inputFiles())


def test_a_cluster_needs_a_shared_folder():
    none = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    conf = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=none, conf=conf))
