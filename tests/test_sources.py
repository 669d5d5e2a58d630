import tempfile

import pytest

from tidewater import ModelGraph, from_raw_parquet, from_test_tables
from tidewater.session import scale_conf
from tidewater.sources.contracts import ContractError, conform, RAW_ORDERS

SF = "/root/testdata/sf0.001"


def test_raw_parquet_round_trip(spark):
    raw = from_test_tables(spark, SF)
    root = tempfile.mkdtemp(prefix="tw-raw-")
    for name, df in raw.as_dict().items():
        df.write.parquet(f"{root}/{name}")
    stored = from_raw_parquet(spark, root)
    a = ModelGraph(spark, raw).int_orders_attributed.collect()
    b = ModelGraph(spark, stored).int_orders_attributed.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_contract_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "order_id long, customer_id long")
    with pytest.raises(ContractError):
        conform(df, RAW_ORDERS, "raw_orders")


def test_scale_conf_sizes_partitions():
    conf = scale_conf(shuffle_bytes=100 * (1 << 40), total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    assert int(scale_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 128  # two waves minimum
