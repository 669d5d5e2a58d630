"""The bucketed layout: same results, and no exchange of line items."""

import re

import pytest

from helpers import customer, event, item, order, payment, product, raw
from tidewater import ModelGraph, RunParams, from_test_tables
from tidewater.plans import intermediate as im
from tidewater.sources.bucketed import LayoutError, count_rows, lay_out, open_layout

SF = "/root/testdata/sf0.001"


def line_exchanges(df, items_path: str) -> list[str]:
    """Shuffles of line items: exchanges with the items' scan below and no final aggregate between (which is per order)."""
    found, stack = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        m = re.match(r"^([\s:|+\-]*)(\S.*)$", line)
        if not m or line.startswith("=="):
            continue
        depth, node = len(m[1]), m[2]
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if "FileScan" in node and items_path in node:
            for _, above in reversed(stack):
                if "Aggregate" in above and "partial_" not in above:
                    break
                if re.search(r"(^|\s)Exchange ", above):
                    found.append(above)
        stack.append((depth, node))
    return found


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layout") / "raw")
    lay_out(from_test_tables(spark, SF), root, buckets=8)
    return root


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")  # dimensions only, as with large tables
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rfm(g):
    return im.rfm_base(g.stg_customers, g.stg_orders, g.stg_order_items, g.params)


MODELS = {
    "int_orders_enriched": lambda g: g.int_orders_enriched,
    "rfm_base": rfm,
    "fct_orders": lambda g: g.fct_orders,
}


@pytest.mark.parametrize("name", MODELS)
def test_line_items_are_not_exchanged(spark, layout, no_broadcast, name):
    g = ModelGraph(spark, open_layout(spark, layout), RunParams())
    built = MODELS[name](g)
    scan = r"raw_order_items"
    assert scan in built._jdf.queryExecution().executedPlan().toString()
    assert line_exchanges(built, scan) == []
    plain = MODELS[name](ModelGraph(spark, from_test_tables(spark, SF), RunParams()))
    assert line_exchanges(plain, "lineitem")  # without the layout they are
    got, want = (sorted(map(repr, df.collect())) for df in (built, plain))
    assert got == want


def test_unfinished_layout_is_refused(spark, tmp_path):
    raw_tables = raw(spark, customers=[customer(1)])
    raw_tables.customers.write.parquet(str(tmp_path / "raw_customers"))
    with pytest.raises(LayoutError):
        open_layout(spark, str(tmp_path))


def test_null_and_repeated_order_ids(spark, tmp_path):
    tables = raw(
        spark,
        customers=[customer(1)],
        orders=[order(10, 1, "2001-01-01 00:00:00"), order(10, 1, "2001-01-02 00:00:00"), order(None, 1, "2001-01-03 00:00:00")],
        items=[item(1, 10), item(2, 10), item(3, None)],
        products=[product(1)],
        payments=[payment(10)],
        events=[event(1, 1, "ad_click", "email", "2000-12-01 00:00:00")],
    )
    root = str(tmp_path / "it's")  # a quote in the path
    a, b = ModelGraph(spark, tables), ModelGraph(spark, lay_out(tables, root, buckets=3))
    for name in MODELS:
        assert sorted(map(repr, MODELS[name](a).collect())) == sorted(map(repr, MODELS[name](b).collect()))
    empty = lay_out(raw(spark), str(tmp_path / "empty"))
    assert ModelGraph(spark, empty).int_orders_enriched.count() == 0


def test_counts_come_from_the_footers(spark, layout):
    counts = count_rows(spark, layout)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 6 and "ReadSchema: struct<count(*):bigint>" in plan
    tables = open_layout(spark, layout).as_dict()
    assert {r.table_name: r.row_count for r in counts.collect()} == {n: t.count() for n, t in tables.items()}
    with pytest.raises(LayoutError):
        count_rows(spark, layout + "/raw_orders")
