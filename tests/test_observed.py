"""Row-local checks counted while a model is written."""

from pyspark.sql import functions as F

from tidewater.operators.quality import Check, observe_checks, run_checks
from tidewater.registry import model_graph

SF = "/root/testdata/sf0.001"
CHECKS = [Check("not_null", "m", "k"), Check("accepted_values", "m", "v", values=("a", "b")),
          Check("accepted_values", "m", "w", values=(1, 2)), Check("unique", "m", "k")]


def test_counts_equal_a_scan(spark, tmp_path):
    rows = [(i if i % 7 else None, "abx"[i % 3], 1 + i % 2) for i in range(100)] + [(1, None, None), (1, "y", 2)]
    df = spark.createDataFrame(rows, "k long, v string, w long")
    watched, counts = observe_checks(df.repartitionByRange(5, "k"), CHECKS)
    watched.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    seen = counts()
    assert seen == {"not_null_m_k": 15, "accepted_values_m_v": 34, "accepted_values_m_w": 0}
    with_seen = run_checks(CHECKS, lambda n: stored, observed=seen).collect()
    without = run_checks(CHECKS, lambda n: stored).collect()
    assert sorted(map(tuple, with_seen)) == sorted(map(tuple, without))
    assert {r.test_name: r.failures for r in without}["accepted_values_m_v"] == 2  # distinct failing values: x and y


def test_no_second_scan(spark):
    """not_null and accepted_values read nothing once their models are written."""
    g = model_graph(spark, SF)
    g.materialize(("dim_products", "dim_channels", "dim_date"))
    assert g.observed and set(g.observed.values()) == {0}
    checks = [Check("not_null", "dim_products", "product_key"), Check("not_null", "dim_date", "date_key")]
    plan = run_checks(checks, g.model, observed=g.observed)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_written_model_with_failures(spark):
    g = model_graph(spark, SF)
    g.__dict__["dim_products"] = g.dim_products.withColumn("product_key", F.when(F.col("product_id") % 2 == 0, F.col("product_key")))
    g.materialize(("dim_products",))
    n = g.dim_products.where("product_key is null").count()
    assert n > 0 and g.observed["not_null_dim_products_product_key"] == n
