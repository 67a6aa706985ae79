from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import stored_seed
from tillstream.operators import doomed, retention
from tillstream.session import run_dir

AS_OF = datetime(2025, 6, 1)
CUT = datetime(2025, 3, 1)
OLD = CUT - timedelta(days=1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _tables(spark):
    """Sample rows of which some are old, with parents that keep, lose or never had children."""
    t = stored_seed(spark)
    t["order_items"] = t["order_items"].withColumn(
        "order_date", F.when(F.col("order_item_id") < 4, F.lit(OLD)).otherwise(F.lit(AS_OF)))
    t["orders"] = t["orders"].withColumn("order_date", F.lit(OLD))
    for name in ("products", "products_sku", "categories", "suppliers", "employees"):
        key = F.xxhash64(F.col(t[name].columns[0]).cast("string"))
        t[name] = t[name].withColumn("deleted_at", F.when(F.pmod(key, F.lit(2)) == 0, F.lit(OLD)).cast("timestamp"))
    return t


def test_equal_to_the_step_by_step_run(spark):
    t = _tables(spark)
    slow, fast = retention.run_retention(t, AS_OF), doomed.run_retention_keys(t, AS_OF)
    assert rows(slow.counts) == rows(fast.counts) and fast.failures == {}
    for name in t:
        assert rows(slow.tables[name]) == rows(fast.tables[name]), name
    assert sum(r.rows_deleted for r in fast.counts.collect()) == sum(df.count() for df in fast.purged.values()) > 0


def test_a_step_that_fails_marks_nothing(spark):
    t = _tables(spark)
    del t["shipments"]
    t["products_sku"] = t["products_sku"].drop("deleted_at")
    run = doomed.run_retention_keys(t, AS_OF)
    assert set(run.failures) == {"products_sku", "shipments"}
    done = {(r.step, r.table_name) for r in run.counts.collect()}
    assert ("order_items", "order_items") in done and ("products_sku", "order_items") not in done
    with pytest.raises(ValueError):
        doomed.run_retention_keys({}, AS_OF)


STEPS = (("follow", (doomed.Follow("c", "p", "k", "gone"), doomed.Old("p", "gone"))),
         ("lonely", (doomed.Lonely("q", "gone", "c", "k"),)))


def test_null_keys_repeated_rows_and_empty_tables(spark):
    p = spark.createDataFrame([(1, OLD), (1, OLD), (2, CUT), (None, OLD)], "k int, gone timestamp")
    q = spark.createDataFrame([(1, OLD), (2, OLD), (2, None), (None, OLD)], "k int, gone timestamp")
    c = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, flag string")
    run = doomed.run_retention_keys({"p": p, "q": q, "c": c}, AS_OF, steps=STEPS)
    assert rows(run.tables["c"]) == rows(c.filter("k = 2 or k is null"))
    assert rows(run.tables["p"]) == [(2, CUT)]
    assert rows(run.tables["q"]) == rows(q.filter("k = 2"))
    none = doomed.run_retention_keys({"p": p, "q": q, "c": c.limit(0)}, AS_OF, steps=STEPS)
    assert rows(none.tables["q"]) == [(2, None)] and none.tables["c"].count() == 0


def test_stored_run_after_a_death(spark, monkeypatch):
    """Dies between two tables; the next run does the rest, and a third finds nothing."""
    base = run_dir(spark, "doomed")
    p = spark.createDataFrame([(1, OLD), (2, None), (3, OLD)], "k int, gone timestamp")
    c = spark.createDataFrame([(1, 202501), (1, 202502), (2, 202502), (3, 202503)], "k int, month int")
    p.write.parquet(f"{base}/p")
    c.write.partitionBy("month").parquet(f"{base}/c")
    paths, real = {"p": f"{base}/p", "c": f"{base}/c"}, doomed.settle

    def die(df, label):
        if label == "p-kept":
            raise OSError("host lost")
        return real(df, label)

    monkeypatch.setattr(doomed, "settle", die)
    with pytest.raises(OSError):
        doomed.purge_stored(spark, paths, AS_OF, steps=STEPS[:1], archive_to=f"{base}/cold")
    monkeypatch.setattr(doomed, "settle", real)
    assert rows(spark.read.parquet(f"{base}/c").select("k", "month")) == [(2, 202502)]
    assert rows(spark.read.parquet(f"{base}/cold/c").select("k", "step_no")) == [(1, 1), (1, 1), (3, 1)]
    doomed.purge_stored(spark, paths, AS_OF, steps=STEPS[:1])
    assert rows(spark.read.parquet(f"{base}/p")) == [(2, None)]
    again = doomed.purge_stored(spark, paths, AS_OF, steps=STEPS[:1])
    assert {r.rows_deleted for r in again.collect()} == {0}


def test_months_are_written_once_and_a_month_on_its_way_is_put_back(spark, monkeypatch):
    """Dies between the removal of a month and the move of its new folder."""
    base = run_dir(spark, "moved")
    p = spark.createDataFrame([(1, OLD), (2, None)], "k int, gone timestamp")
    c = spark.createDataFrame([(1, 202501), (2, 202501), (1, 202502), (2, 202502), (1, 202503), (2, None)],
                              "k int, month int")
    p.write.parquet(f"{base}/p")
    c.write.partitionBy("month").parquet(f"{base}/c")
    paths, real, settled = {"p": f"{base}/p", "c": f"{base}/c"}, doomed.replace_folder, []

    def die(session, new, old):
        doomed.remove(session, old)
        raise OSError("host lost")

    monkeypatch.setattr(doomed, "settle", lambda df, label, settle=doomed.settle: settled.append(label) or settle(df, label))
    monkeypatch.setattr(doomed, "replace_folder", die)
    with pytest.raises(OSError):
        doomed.purge_stored(spark, paths, AS_OF, steps=STEPS[:1])
    assert spark.read.parquet(f"{base}/c").select("k").count() == 4      # a month is missing
    monkeypatch.setattr(doomed, "replace_folder", real)
    done = doomed.purge_stored(spark, paths, AS_OF, steps=STEPS[:1])
    assert rows(spark.read.parquet(f"{base}/c").select("k", "month")) == rows(c.filter("k = 2"))
    assert {(r.table_name, r.rows_deleted) for r in done.collect()} == {("c", 2), ("p", 1)}
    assert "c-kept" not in settled and not doomed.folders(spark, doomed.staging(paths["c"]))


def test_a_stored_run_tells_of_steps_that_failed(spark):
    """The other steps are carried out all the same."""
    base = run_dir(spark, "failed")
    tables = {"p": spark.createDataFrame([(1, OLD), (2, None)], "k int, gone timestamp"),
              "c": spark.createDataFrame([(1,), (2,)], "k int"), "q": spark.createDataFrame([(1,), (3,)], "k int")}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
    with pytest.raises(doomed.StepsFailed, match="lonely") as told:
        doomed.purge_stored(spark, {n: f"{base}/{n}" for n in tables}, AS_OF, steps=STEPS)
    assert set(told.value.failures) == {"lonely"}
    assert {(r.table_name, r.rows_deleted) for r in told.value.counts.collect()} == {("c", 1), ("p", 1)}
    assert {n: rows(spark.read.parquet(f"{base}/{n}").select("k")) for n in tables} == {
        "p": [(2,)], "c": [(2,)], "q": [(1,), (3,)]}


def test_children_are_read_through_a_bloom_filter_of_their_parents(spark):
    base = run_dir(spark, "bloom")
    spark.range(20_000).selectExpr("id k", f"timestamp '{OLD}' gone").write.parquet(f"{base}/p")
    spark.range(20_000).selectExpr("id k", f"timestamp '{AS_OF}' at").write.parquet(f"{base}/c")
    run = doomed._Run({n: spark.read.parquet(f"{base}/{n}") for n in "pc"}, retention.cutoff(AS_OF))
    run.marks["c"] = [doomed.Mark(1, "c", "at")]
    lowered = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
               "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in lowered.items():
        spark.conf.set(key, value)
    try:
        aged = run.living("p", "k", "gone").filter(run.old("gone")).select("k")
        joined = doomed.keyed_join(run.living("c", "k").distinct(), aged, "k", "left_semi", limit=0)
        plan = joined._jdf.queryExecution().toString()
    finally:
        for key in lowered:
            spark.conf.unset(key)
    physical = plan[plan.index("== Physical Plan =="):]
    assert "might_contain" in physical and "GreaterThanOrEqual(at" in physical and "LessThan(gone" in physical
