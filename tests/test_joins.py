from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import stored_seed
from tillstream.operators import joins
from tillstream.plans.reports import sales_report_view, shipping_report_view


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 0, some have no key."""
    fact = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 700).alias("k"))
    dim = spark.range(0, 700, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(skewed, how):
    fact, dim = skewed
    salted = joins.salted_join(fact, dim, ["k"], how, ["id"], share=0.1, salts=7)
    plain = fact.join(dim, ["k"], how)
    if how in ("left_semi", "left_anti"):
        plain = plain.select("id", "k")
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salting_spreads_the_hot_key(spark, skewed):
    fact, dim = skewed
    hot = joins.hot_keys(fact, ["k"], 0.1)
    assert [r.k for r in hot.collect()] == [0]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        salted = joins.salted_join(fact, dim, ["k"], "inner", ["id"], share=0.1, salts=64)
        sizes = [r["n"] for r in salted.filter("k = 0").groupBy(
            F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 4 and max(sizes) < 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_only_below_the_limit(spark, skewed, monkeypatch):
    fact, dim = skewed
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(joins.lookup_join(fact, dim, "k"))
    plain = joins.lookup_join(fact, dim, "k", limit=1)
    assert "strategy=broadcast" not in plan(plain) and "_salt" not in plan(plain)
    monkeypatch.setattr(joins, "SALT_FLOOR", 1)
    salted = joins.lookup_join(fact, dim, "k", limit=1)
    assert "_salt" in plan(salted) and salted.count() == plain.count()


def test_hot_keys_by_size(spark, monkeypatch):
    """A key of 0.3 per cent of the rows is hot if it is more than a task should hold."""
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    df = spark.range(100_000).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("k"))
    assert [(r["k"], r["_pieces"]) for r in joins.hot_keys(df, ["k"]).collect()] == [(-1, 3)]


def test_hot_keys_are_few(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert joins.hot_keys(df, ["k"], 0.02).count() == 0
    assert joins.hot_keys(df, ["k"], 0.005).count() == 100


def test_parents_and_children(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    child = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None)], "c int, p int")
    assert {r.p for r in joins.without_children(parent, child, "p").collect()} == {2, 3}
    assert {r.p for r in joins.with_children(parent, child, "p").collect()} == {1}
    assert {r.c for r in joins.children_of(child, parent, "p").collect()} == {1, 2}
    assert {r.c for r in joins.not_children_of(child, parent, "p").collect()} == {3, 4}
    assert {r.c for r in joins.orphans(child, parent, "p").collect()} == {3}


def test_join_values_of_any_number(spark):
    df = spark.range(5)
    assert joins.join_values(df, [(1, "a")], "id long, v string", "id").count() == 1
    many = [(i,) for i in range(20_000)]
    assert joins.join_values(df, many, "id long", "id", limit=10).count() == 5


def test_sales_report_of_the_sample(spark):
    t = stored_seed(spark)
    args = [t[n] for n in ("orders", "customers", "order_items", "products_sku", "products",
                           "payment_types")]
    rows = sales_report_view(*args, ordered=True).collect()
    assert len(rows) == 7
    assert [(r.order_id, r.item_count) for r in rows] == [
        (6, 2), (6, 2), (7, 1), (8, 1), (9, 2), (9, 2), (10, 1)]
    assert rows[0].customer_name == "Ada Brook" and rows[0].payment_types == "Credit Card"


def test_shipping_report_keeps_untracked_shipments(spark):
    t = stored_seed(spark)
    rows = shipping_report_view(t["shipments"], t["warehouses"], t["delivery_tracking"]).collect()
    assert sorted((r.shipment_id, r.checkpoint_location) for r in rows if r.checkpoint_location) == [
        (1, "Arden"), (1, "Denby"), (2, "Corley"), (3, "Borrow"), (5, "Esk")]
    assert [r.shipment_id for r in rows if r.checkpoint_location is None] == [4]
    closed = t["warehouses"].withColumn("deleted_at", F.when(F.col("warehouse_id") == 1,
                                                             F.col("created_at")))
    left = shipping_report_view(t["shipments"], closed, t["delivery_tracking"])
    assert left.filter("warehouse_id = 1").count() == 0 and left.count() == 4
