"""Date-bounded reports: the date dimension prunes the facts' month folders."""

import datetime as dt
import os

import pytest

from tidewater.registry import PERIOD, model_graph

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    paths = model_graph(spark, SF).write_models(root, ("dim_date", "dim_channels", "fct_orders"))
    return root, paths["fct_orders"]


def test_only_the_months_of_the_period_are_read(spark, marts):
    root, fact = marts
    g = model_graph(spark, SF)
    g.open_models(root)
    report = g.report_between("revenue_daily", *PERIOD)
    rows = report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert rows and all(PERIOD[0] <= r.order_date < PERIOD[1] for r in rows)
    months = {d for d in os.listdir(fact) if d.startswith("order_month=")}
    # folders of other months can be gone without anyone noticing
    kept = {f"order_month={PERIOD[0] + dt.timedelta(days=i):%Y-%m}" for i in range((PERIOD[1] - PERIOD[0]).days)}
    assert len(months) > len(kept) and kept <= months
    scans = [n for n in _nodes(report) if n.nodeName().startswith("Scan parquet") and "order_month" in n.simpleString(10_000)]
    read = [n.metrics().get("numPartitions").get().value() for n in scans]
    assert read and max(read) == len(kept)


def _nodes(df):
    """The executed plan's nodes, through adaptive stages."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        n = todo.pop()
        out.append(n)
        name = n.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(n.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(n.plan())
        kids = n.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


@pytest.mark.parametrize("name", ["revenue_daily", "revenue_rolling7", "kpi_summary", "aov_monthly", "channel_revenue"])
def test_stored_and_derived_agree(spark, marts, name):
    derived, stored = model_graph(spark, SF), model_graph(spark, SF)
    stored.open_models(marts[0])
    a, b = (sorted(map(repr, g.report_between(name, *PERIOD).collect())) for g in (derived, stored))
    assert a == b
    whole = (dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    if name in ("revenue_daily", "aov_monthly"):
        assert sorted(map(repr, stored.report_between(name, *whole).collect())) == sorted(map(repr, stored.report(name).collect()))
    assert stored.report_between("revenue_daily", PERIOD[0], PERIOD[0]).count() == 0
