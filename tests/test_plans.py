"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tillstream.catalog import mapping
from tillstream.catalog.mapping import entity, table
from tillstream.operators import decode, latest
from tillstream.operators.joins import without_children
from tillstream.sources import tables
from tillstream.specs import spec

SF = "/root/testdata/sf0.001"
LAZY = ["sales_report_view", "shipping_report_view", "inventory_report_view", "product_view",
        "bronze_orders", "silver_orders", "merge_upsert", "merge_actions", "change_feed",
        "latest_child", "reconcile", "integrity_report", "purge_cascade", "purge_products",
        "run_retention", "patch_coalesce", "quality_flags", "revenue_by_category",
        "reference_report", "children_of_expired_salted", "mask", "row_scope"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                "SinglePartition, REPARTITION"):
        assert bad not in text


def test_messages_are_parsed_once(spark):
    lines = spark.createDataFrame([("x",)], "value string")
    assert plan(decode.decode_cdc(lines, spec("orders"))).count("from_json") == 1


def test_latest_is_pruned_before_the_shuffle(spark):
    text = plan(latest.latest_per_key(entity(spark, SF, "order_items"), "order_item_id"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_child_keys_are_aggregated_before_the_shuffle(spark):
    o, i = (table(spark, SF, t) for t in ("orders", "lineitem"))
    text = plan(without_children(o, i.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey"))
    below = text[text.index("HashAggregate"):]
    assert below.count("HashAggregate") == 2 and "ReadSchema: struct<l_orderkey:bigint>" in below


def test_look_back_reaches_the_scan(spark, tmp_path):
    contract.session.configure(spark)
    path = str(tmp_path / "bronze")
    e = table(spark, SF, "events").withColumnRenamed("ts", "ingestion_time")
    tables.write_partitioned(e, path, "ingestion_time")
    text = plan(latest.recent(spark.read.parquet(path), "2024-01-20"))
    assert "PartitionFilters: [isnotnull(month" in text
    assert "GreaterThanOrEqual(ingestion_time,2024-01-06" in text


def test_only_needed_columns_are_read(spark):
    text = plan(entity(spark, SF, "orders").groupBy("payment_status").agg(F.sum("total_amount")))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


@pytest.mark.parametrize("name, moves", [("bronze_orders", 1), ("silver_orders", 2)])
def test_messages_are_moved_once_and_without_their_hash(spark, name, moves):
    """One exchange by key, the same one on both sides of the silver merge; nothing is hashed or sorted below it."""
    text = plan(contract.queries()[name](spark, SF))
    assert text.count("Exchange hashpartitioning(order_id") == text.count("Exchange hashpartitioning") == moves
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "sha2(" not in below and "Sort " not in below


@pytest.mark.parametrize("name, key", [
    ("silver_inventory", "inventory_id"), ("silver_purchase_order_items", "po_item_id"),
    ("bronze_order_items", "order_item_id")])
def test_a_replay_that_has_run_has_moved_its_messages_once(spark, name, key):
    """One shuffle, by the key alone; the other side of a silver merge has read the same one again."""
    df = contract.queries()[name](spark, SF)
    df.collect()
    text, _ = plan(df).split("== Initial Plan ==")
    moves = [line for line in text.splitlines() if " Exchange " in line and "hashpartitioning(l_" not in line]
    again = [line for line in moves if "ReusedExchange" in line]
    assert len(moves) - len(again) == 1 and len(again) == name.startswith("silver")
    assert all(re.search(rf"Exchange hashpartitioning\({key}#\d+L, \d+\)", line) for line in moves)


def test_no_table_is_run_to_count_its_partitions(spark, monkeypatch):
    monkeypatch.setattr(tables, "SPREAD_FLOOR", -1)
    df = entity(spark, SF, "orders").groupBy("customer_id").count()
    assert tables.spread(df) is df
    ran = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    tables.spread(df)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == ran


def test_grouped_rows_are_not_put_together_ahead_of_their_messages(spark, monkeypatch):
    monkeypatch.setattr(mapping, "SPREAD_FLOOR", -1, raising=False)
    text = plan(contract.queries()["bronze_inventory"](spark, SF))
    assert text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM") == 2
    grouped = text[text.rindex("Exchange hashpartitioning"):]
    assert grouped.startswith("Exchange hashpartitioning(l_suppkey") and "to_json" not in grouped
