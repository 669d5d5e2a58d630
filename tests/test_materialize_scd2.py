import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tidewater.operators.scd2 import scd2_initial, scd2_merge
from tidewater.registry import model_graph

SF = "/root/testdata/sf0.001"


def test_write_models_partitions_and_rereads(spark):
    p = model_graph(spark, SF)
    lazy_counts = {n: p.model(n).count() for n in ("fct_orders", "dim_customers")}
    out = tempfile.mkdtemp(prefix="tw-models-")
    paths = p.write_models(out, ("int_orders_enriched", "int_customers_rfm_scored", "int_orders_attributed",
                                 "dim_date", "dim_customers", "dim_products", "dim_channels", "fct_orders"))
    assert any(d.startswith("order_month=") for d in os.listdir(paths["fct_orders"]))
    assert p.fct_orders.count() == lazy_counts["fct_orders"]
    assert p.dim_customers.count() == lazy_counts["dim_customers"]
    # a second full refresh replaces the table in place
    p.write_models(out, ("dim_products",))
    assert spark.read.parquet(paths["dim_products"]).count() == p.dim_products.count()


def test_scd2_history(spark):
    s1 = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id long, seg string")
    s2 = spark.createDataFrame([(1, "A"), (2, "X"), (4, "D")], "id long, seg string")
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    h1 = scd2_initial(s1, key="id", effective_from=F.lit(t1).cast("timestamp_ntz"))
    h2 = scd2_merge(h1, s2, key="id", tracked=["seg"], change_at=t2)
    rows = sorted((r.id, r.seg, r.effective_from, r.effective_to, r.is_current) for r in h2.collect())
    end = dt.datetime(9999, 12, 31)
    assert rows == [
        (1, "A", t1, end, True),
        (2, "B", t1, t2, False),
        (2, "X", t2, end, True),
        (3, "C", t1, end, True),
        (4, "D", t2, end, True),
    ]
    assert h2.select("history_key").distinct().count() == 5


def test_results_do_not_depend_on_session_time_zone(spark):
    keys = ("scd2_merge", "session_ids", "orders_attributed", "dim_date")
    from __spark_entry__ import queries
    qs = queries()

    def snap():
        return {k: sorted(map(tuple, qs[k](spark, SF).collect())) for k in keys}

    base = snap()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = snap()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
