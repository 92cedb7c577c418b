"""The staging -> analytics DAG on the test binding (A31) and the flagship entry."""
import os
import tempfile

from ampere.plans.products import Warehouse, dependency_order, materialize

SF = "/root/testdata/sf0.001"


def test_dependency_order_respects_refs():
    order = dependency_order(Warehouse.DEPENDENCIES)
    for node, deps in Warehouse.DEPENDENCIES.items():
        for d in deps:
            if d in Warehouse.DEPENDENCIES:
                assert order.index(d) < order.index(node)


def test_materialize_writes_tables_and_views(spark):
    from ampere.queries import _build_warehouse
    wh = _build_warehouse(spark, SF, "hour")   # fresh: materialize() swaps products for stored tables
    out = tempfile.mkdtemp(prefix="dag-", dir="/tmp")
    written = materialize(wh, out, ["stg_prices", "stg_neighbour_prices", "fct_market_prices", "fct_price_spreads"])
    assert set(written) == {"fct_market_prices", "fct_price_spreads"}
    assert all(os.path.isdir(p) for p in written.values())
    assert spark.table("stg_prices").count() == spark.read.parquet(written["fct_market_prices"]).count()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "price_rolling_avg_7d_same_hour" in df.columns
