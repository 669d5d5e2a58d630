"""Snapshot commits: readers see one whole build; a killed build changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater import ModelGraph
from tidewater.plans.graph import ModelGraph as Graph
from tidewater.registry import model_graph
from tidewater.sources import snapshots

SF = "/root/testdata/sf0.001"
NAMES = ("dim_products", "dim_channels", "dim_date")


def test_build_is_published_as_a_whole(spark, tmp_path):
    root = str(tmp_path / "marts")
    first = model_graph(spark, SF)
    first.write_models(root, NAMES)
    reader = model_graph(spark, SF)
    assert sorted(reader.open_models(root)) == sorted(NAMES)
    before = reader.dim_products  # opened before the refresh, read after it
    n = before.count()

    second = model_graph(spark, SF)
    second.__dict__["dim_products"] = second.dim_products.where(F.col("product_id") % 2 == 0)
    second.write_models(root, ("dim_products",))
    assert before.count() == n
    again = model_graph(spark, SF)
    again.open_models(root)
    assert 0 < again.dim_products.count() < n
    assert again.dim_channels.count() == first.dim_channels.count()  # unchanged tables stay

    assert snapshots.vacuum(spark, root, keep=2) == []
    assert before.count() == n
    assert len(snapshots.vacuum(spark, root, keep=1)) == 1  # the first dim_products
    kept = model_graph(spark, SF)
    kept.open_models(root)
    assert kept.dim_products.count() == again.dim_products.count()


def test_killed_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    model_graph(spark, SF).write_models(root, NAMES)
    number, tables = snapshots.current(spark, root)

    def dies(self, path, name, *args, real=Graph._write_one):
        out = real(self, path, name, *args)
        if name == "dim_date":
            raise KeyboardInterrupt  # after some tables are written, before the commit
        return out

    monkeypatch.setattr(ModelGraph, "_write_one", dies)
    with pytest.raises(KeyboardInterrupt):
        model_graph(spark, SF).write_models(root, NAMES, threads=1)
    monkeypatch.undo()
    assert snapshots.current(spark, root) == (number, tables)
    reader = model_graph(spark, SF)
    assert sorted(reader.open_models(root)) == sorted(NAMES) and reader.dim_date.count() > 0
    gone = snapshots.vacuum(spark, root, keep=1)
    assert gone and all(f"{root}/{g}" not in tables.values() for g in gone)
    assert reader.dim_products.count() > 0


def test_two_writers(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(3).write.parquet(a := snapshots.new_version(root, "t"))
    spark.range(4).write.parquet(b := snapshots.new_version(root, "t"))
    assert snapshots.current(spark, root) == (0, {})
    assert snapshots.commit(spark, root, 0, {"t": a}) == 1
    with pytest.raises(snapshots.ConcurrentRefresh):
        snapshots.commit(spark, root, 0, {"t": b})
    assert snapshots.current(spark, root) == (1, {"t": a})
    assert snapshots.commit(spark, root, 1, {"t": b}) == 2
    assert spark.read.parquet(snapshots.current(spark, root)[1]["t"]).count() == 4
    assert not [n for n in os.listdir(f"{root}/_snapshots") if "draft" in n and not n.endswith(".crc")]
