from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import stored_seed
from tillstream.operators import retention as r

AS_OF = datetime(2025, 6, 1)
CUT = datetime(2025, 3, 1)
OLD = CUT - timedelta(days=1)


def ids(df, col):
    return sorted(x[0] for x in df.select(col).collect())


def test_cut_off_is_strict(spark):
    df = spark.createDataFrame([(1, CUT), (2, CUT - timedelta(microseconds=1)), (3, None)],
                               "id int, ts timestamp")
    split = r.purge_older(df, "ts", AS_OF)
    assert ids(split.keep, "id") == [1, 3] and ids(split.purged, "id") == [2]
    assert ids(r.purge_older(df, "ts", AS_OF, months=6).purged, "id") == []


def test_expired_product_with_ordered_sku_stays(spark):
    products = spark.createDataFrame(
        [("A", OLD), ("B", OLD), ("C", None), ("D", CUT)], "product_id string, deleted_at timestamp")
    skus = spark.createDataFrame(
        [(1, "A"), (2, "A"), (3, "B"), (4, "C"), (5, "D")], "sku_id long, product_id string")
    items = spark.createDataFrame([(10, 1), (11, 1)], "order_item_id long, sku_id long")
    p, s = r.purge_products(products, skus, items, AS_OF)
    assert ids(s.purged, "sku_id") == [2, 3] and ids(s.keep, "sku_id") == [1, 4, 5]
    assert ids(p.purged, "product_id") == ["B"] and ids(p.keep, "product_id") == ["A", "C", "D"]


def test_cascade_takes_the_children(spark):
    skus = spark.createDataFrame([(1, OLD), (2, None)], "sku_id long, deleted_at timestamp")
    items = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "order_item_id long, sku_id long")
    s, i = r.purge_cascade(skus, items, "sku_id", AS_OF)
    assert ids(s.purged, "sku_id") == [1] and ids(i.purged, "order_item_id") == [10]
    assert ids(i.keep, "order_item_id") == [11, 12]


def _tables(spark):
    t = stored_seed(spark)
    t["order_items"] = t["order_items"].withColumn(
        "order_date", F.when(F.col("order_item_id") < 4, F.lit(OLD)).otherwise(F.lit(AS_OF)))
    t["orders"] = t["orders"].withColumn("order_date", F.lit(OLD))
    return t


def test_run_goes_on_after_a_failure(spark):
    t = _tables(spark)
    del t["shipments"]
    run = r.run_retention(t, AS_OF)
    assert set(run.failures) == {"shipments"}
    deleted = {(x.step, x.table_name): x.rows_deleted for x in run.counts.collect()}
    assert deleted["order_items", "order_items"] == 3
    assert deleted["orders", "orders"] == 2          # 6 and 7 lost all their items
    assert ids(run.tables["orders"], "order_id") == [8, 9, 10]
    assert "employees" in {x.step for x in run.counts.collect()}


@pytest.mark.parametrize("materialize", [False, True])
def test_nothing_is_lost_between_kept_and_purged(spark, materialize):
    t = _tables(spark)
    steps = [s for s in r.RETENTION_STEPS if s[0] in ("order_items", "orders", "products_sku")]
    run = r.run_retention(t, AS_OF, steps=[*steps, r.WAREHOUSE_STEP], materialize=materialize)
    for name in ("order_items", "orders", "products_sku", "warehouses"):
        back = run.tables[name]
        for gone in run.purged.get(name, []):
            back = back.unionByName(gone)
        assert back.exceptAll(t[name]).count() == 0 and t[name].exceptAll(back).count() == 0
    kept = run.tables["order_items"].select("order_id").distinct()
    assert kept.join(run.tables["orders"], "order_id", "left_anti").count() == 0


def test_materialized_run_writes_each_table_of_a_step_once(spark, monkeypatch):
    """Both halves in one pass, and the same outcome as the lazy run."""
    t, written, real = _tables(spark), [], r.settle
    for name in ("products", "products_sku", "categories", "suppliers", "employees"):
        key = F.xxhash64(F.col(t[name].columns[0]).cast("string"))
        t[name] = t[name].withColumn("deleted_at", F.when(F.pmod(key, F.lit(2)) == 0, F.lit(OLD)).cast("timestamp"))
    monkeypatch.setattr(r, "settle", lambda df, label: written.append(label) or real(df, label))
    stored, lazy = r.run_retention(t, AS_OF, materialize=True), r.run_retention(t, AS_OF)
    assert len(written) == 14 and not any(label.endswith("-purged") for label in written)
    assert sorted(map(tuple, stored.counts.collect())) == sorted(map(tuple, lazy.counts.collect()))
    for name in t:
        assert stored.tables[name].columns == t[name].columns
        assert stored.tables[name].exceptAll(lazy.tables[name]).isEmpty(), name
        assert lazy.tables[name].exceptAll(stored.tables[name]).isEmpty(), name


def test_materialized_marks_with_null_keys_and_repeated_rows(spark):
    p = spark.createDataFrame([(1, OLD), (1, OLD), (2, OLD), (3, None), (None, OLD)], "k int, ts timestamp")
    c = spark.createDataFrame([(2, "a"), (2, "a"), (None, "b")], "k int, flag string")
    for split in (r.purge_childless(p, c, "k", "ts", AS_OF), *r.purge_cascade(
            p.withColumnRenamed("ts", "deleted_at"), c, "k", AS_OF)):
        both = r._settled(split, "marks")
        for half in ("keep", "purged"):
            assert sorted(map(str, getattr(both, half).collect())) == sorted(map(str, getattr(split, half).collect()))


def test_archive_adds_up(spark, tmp_path):
    t = _tables(spark)
    split = r.purge_older(t["order_items"], "order_date", AS_OF)
    r.archive(split.purged, str(tmp_path / "cold"), "order_date")
    cold = spark.read.parquet(str(tmp_path / "cold"))
    assert cold.count() == 3 and {str(x.month) for x in cold.collect()} == {"202502"}


def test_stock_of_expired_parents(spark):
    t = stored_seed(spark)
    t["warehouses"] = t["warehouses"].withColumn(
        "deleted_at", F.when(F.col("warehouse_id") == 1, F.lit(OLD)))
    t["products"] = t["products"].withColumn(
        "deleted_at", F.when(F.col("product_id") == "PROD_00005", F.lit(OLD)))
    split = r.purge_stock(t, AS_OF)
    assert ids(split.purged, "inventory_id") == [1, 5, 7]
    assert ids(split.keep, "inventory_id") == [2, 3, 4, 6, 8]


def test_purge_of_a_month_table(spark, tmp_path):
    from tillstream.sources.current import purge_table
    from tillstream.sources.tables import write_partitioned
    path, cold = str(tmp_path / "t"), str(tmp_path / "cold")
    df = spark.createDataFrame(
        [(1, datetime(2025, 1, 5)), (2, datetime(2025, 2, 28)), (3, datetime(2025, 3, 9)),
         (4, datetime(2025, 3, 10)), (5, datetime(2025, 5, 1)), (6, None)], "id int, ts timestamp")
    write_partitioned(df, path, "ts")
    done = purge_table(spark, path, "ts", datetime(2025, 6, 10), archive_to=cold)
    assert done == (2, 3)
    assert ids(spark.read.parquet(path), "id") == [4, 5, 6]
    assert ids(spark.read.parquet(cold), "id") == [1, 2, 3]
    assert purge_table(spark, path, "ts", datetime(2025, 6, 10)) == (0, 0)
    assert purge_table(spark, path, "ts", datetime(2025, 7, 1)) == (1, 1)
    assert ids(spark.read.parquet(path), "id") == [5, 6]
