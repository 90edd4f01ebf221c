"""Distinct orders from the cube against the fact."""
import random

from chanfold.operators import loyalty, loyalty_cube
from chanfold.plans.layers import Layers
from conftest import SF_SMALL, rows

FACT = "channel string, order_id string, member boolean, order_status string, revenue_eur double, qty_sold bigint, qty_ordered bigint"


def _cube(spark, fact, path):
    loyalty_cube.placed_orders(fact.repartition(5)).write.parquet(path)
    numbers = loyalty_cube.order_numbers(spark.read.parquet(path))
    return loyalty_cube.cell_sums(fact), loyalty_cube.cell_orders(fact, numbers), numbers


def test_cube_equals_fact(spark, tmpdir_path):
    rng = random.Random(2)
    data = [(rng.choice(["retail", "app", "ecomm"]), rng.choice([None, *(f"o{i}" for i in range(400))]),
             rng.choice([True, False, None]), rng.choice(["delivered", "returned", "cancelled", None]),
             rng.choice([None, 1.25, -3.5, 1e13]), 1, 2) for _ in range(3000)]
    data += [("retail", "hot", True, "delivered", 2.0, 1, 1)] * 1500          # one order holds a third of the rows
    fact = spark.createDataFrame(data, FACT).repartition(6)
    sums, orders, numbers = _cube(spark, fact, f"{tmpdir_path}/placed")
    ids = {o for _, o, *_ in data if o}
    assert sorted(r["order_no"] for r in numbers.collect()) == list(range(1, len(ids) + 1))
    assert rows(loyalty_cube.member_comparison(sums, orders)) == rows(loyalty.member_comparison(fact))
    assert rows(loyalty_cube.member_orders_by_channel(sums, orders)) == rows(loyalty.member_orders_by_channel(fact))
    assert rows(loyalty_cube.orders_by_member(sums, orders)) == rows(loyalty.orders_by_member(fact))
    by_channel = {r["channel"]: r["n_orders"] for r in loyalty_cube.orders_of(orders, ["channel"]).collect()}
    want = {}
    for c, o, _, s, *_ in data:
        if o and s in ("delivered", "returned"):
            want.setdefault(c, set()).add(o)
    assert by_channel == {c: len(o) for c, o in want.items()}


def test_many_buckets_and_no_rows(spark, tmpdir_path):
    fact = spark.range(100_000).selectExpr("if(id % 2 = 0, 'app', 'retail') channel", "cast(id % 70000 as string) order_id",
                                           "id % 3 = 0 member", "'delivered' order_status", "1.5D revenue_eur", "1L qty_sold",
                                           "1L qty_ordered")
    sums, orders, _ = _cube(spark, fact, f"{tmpdir_path}/placed")
    assert orders.select("bucket").distinct().count() == 3
    assert rows(loyalty_cube.orders_by_member(sums, orders)) == rows(loyalty.orders_by_member(fact))
    empty = fact.limit(0)
    sums, orders, _ = _cube(spark, empty, f"{tmpdir_path}/none")
    assert loyalty_cube.member_comparison(sums, orders).count() == 0


def test_no_fact_scan_in_the_queries(spark):
    from chanfold.plans import registry
    Layers(spark, SF_SMALL).loyalty_cube()
    for key in ("member_comparison", "member_orders_by_channel", "orders_by_member", "member_uplift"):
        df = registry.QUERIES[key](spark, SF_SMALL)
        assert all("/loyalty_" in f for f in df.inputFiles()), key
