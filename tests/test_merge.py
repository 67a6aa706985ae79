from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.functions.scalars import row_hash
from tillstream.operators import merge
from tillstream.operators.audit import audit_rows, change_feed
from tillstream.operators.merge import empty_silver, merge_upsert, stale_rows
from tillstream.operators.reconcile import integrity_report, reconcile, repair
from tillstream.sources.current import merge_into, read_current, versions
from tillstream.specs import AUDIT_SILVER, spec

ACCOUNTS = spec("accounts")
T0 = datetime(2024, 1, 1)
NOW = datetime(2024, 6, 1)


def versions_of(spark, rows, s=ACCOUNTS, kind="u"):
    """rows: (id, type, day) or (id, type, day, kind) of accounts."""
    data = [(r[0], f"n{r[0]}", r[1], T0 + timedelta(days=r[2]),
             T0 + timedelta(days=r[2]), r[3] if len(r) > 3 else kind) for r in rows]
    df = spark.createDataFrame(
        data, "account_id long, account_name string, account_type string, "
              "updated_at timestamp, ingestion_time timestamp, transaction_type string")
    return df.withColumn("hash", row_hash(df, s.columns))


def state(result):
    return {r.account_id: r.account_type for r in result.df.collect()}


def counts(result):
    return tuple(result.metrics().first())


@pytest.mark.parametrize("way", ["broadcast", "shuffle", "auto"])
def test_insert_update_keep(spark, way):
    old = merge_upsert(empty_silver(spark, ACCOUNTS), versions_of(
        spark, [(1, "a", 0), (2, "b", 0)]), ACCOUNTS, NOW).df
    result = merge_upsert(old, versions_of(
        spark, [(1, "a", 0), (2, "c", 1), (3, "d", 1)]), ACCOUNTS, NOW, way=way)
    assert state(result) == {1: "a", 2: "c", 3: "d"}
    assert counts(result) == (1, 1, 0)
    assert {(r.account_id, r.action) for r in result.actions.collect()} == {
        (1, "keep"), (2, "update"), (3, "insert")}


@pytest.mark.parametrize("way", ["broadcast", "shuffle"])
def test_random_logs_equal_a_fold(spark, way):
    rng = random.Random(7)
    table, expect = empty_silver(spark, ACCOUNTS), {}
    for step in range(3):
        batch = [(rng.randrange(12), rng.choice("xyz"), step * 50 + i) for i in range(25)]
        rng.shuffle(batch)
        result = merge_upsert(table, versions_of(spark, batch), ACCOUNTS, NOW, way=way)
        table = spark.createDataFrame(result.df.collect(), ACCOUNTS.silver_schema())
        for key, kind, day in sorted(batch, key=lambda r: r[2]):
            expect[key] = kind
        assert {r.account_id: r.account_type for r in table.collect()} == expect


def test_second_run_changes_nothing(spark):
    batch = versions_of(spark, [(1, "a", 0), (1, "b", 1), (2, "c", 0)])
    once = merge_upsert(empty_silver(spark, ACCOUNTS), batch, ACCOUNTS, NOW)
    assert counts(merge_upsert(once.df, batch, ACCOUNTS, NOW)) == (0, 0, 0)


def test_tags_that_differ_are_no_cross_join(spark):
    """Batches of one tag each, ids alike: joined by the id, not every row with every row."""
    def logs(tag, *ids):
        rows = spark.createDataFrame([(i, f"u{i}", T0) for i in ids], "log_id long, user_name string, ingestion_time timestamp")
        rows = rows.withColumns({c: F.lit("x") for c in ("action_type", "object_type", "object_name", "query")})
        return rows.withColumns({"log_time": F.lit(T0), "hash": F.col("user_name"), "origin": F.lit(tag)})

    one = merge_upsert(empty_silver(spark, AUDIT_SILVER), logs("Pos", 1, 2, None), AUDIT_SILVER, NOW).df
    two = merge_upsert(one, logs("ERP", 2, 3, None), AUDIT_SILVER, NOW)
    three = merge_upsert(two.df, logs("Pos", 2, 4).withColumn("hash", F.lit("new")), AUDIT_SILVER, NOW)
    for result in (two, three):
        assert "NestedLoop" not in result.df._jdf.queryExecution().executedPlan().toString()
    assert counts(two) == (3, 0, 0) and counts(three) == (1, 1, 0)
    assert sorted(((r.origin, r.log_id, r.hash) for r in three.df.collect()), key=str) == [
        ("ERP", 2, "u2"), ("ERP", 3, "u3"), ("ERP", None, "uNone"), ("Pos", 1, "u1"), ("Pos", 2, "new"),
        ("Pos", 4, "new"), ("Pos", None, "uNone")]


def test_equal_times_give_one_row(spark):
    batch = versions_of(spark, [(1, "a", 0), (1, "b", 0)])
    rows = merge_upsert(empty_silver(spark, ACCOUNTS), batch, ACCOUNTS, NOW).df.collect()
    flipped = merge_upsert(empty_silver(spark, ACCOUNTS), batch.orderBy("account_type"),
                           ACCOUNTS, NOW).df.collect()
    assert len(rows) == 1 and rows == flipped


def test_older_version_arriving_late(spark):
    stored = merge_upsert(empty_silver(spark, ACCOUNTS), versions_of(spark, [(1, "new", 5)]),
                          ACCOUNTS, NOW).df
    late = versions_of(spark, [(1, "old", 1)])
    assert state(merge_upsert(stored, late, ACCOUNTS, NOW)) == {1: "new"}
    assert state(merge_upsert(stored, late, ACCOUNTS, NOW, guard=False)) == {1: "old"}
    assert stale_rows(late, stored, ACCOUNTS).count() == 1


def test_deletes_only_on_request(spark):
    stored = merge_upsert(empty_silver(spark, ACCOUNTS), versions_of(
        spark, [(1, "a", 0), (2, "b", 0)]), ACCOUNTS, NOW).df
    batch = versions_of(spark, [(1, None, 2, "d"), (9, None, 2, "d")])
    assert state(merge_upsert(stored, batch, ACCOUNTS, NOW)) == {1: "a", 2: "b"}
    applied = merge_upsert(stored, batch, ACCOUNTS, NOW, on_delete="delete")
    assert state(applied) == {2: "b"} and counts(applied) == (0, 0, 1)


def test_stamps_and_overrides(spark):
    inv = spec("inventory")
    row = [(1, 1, "P", 6, 10, T0, T0, "u", "h1")]
    schema = ("inventory_id long, warehouse_id long, product_id string, sku_id long, "
              "stock_quantity int, last_updated timestamp, ingestion_time timestamp, "
              "transaction_type string, hash string")
    out = merge_upsert(empty_silver(spark, inv), spark.createDataFrame(row, schema), inv, NOW)
    got = out.df.first()
    assert (got.updated_at, got.ingestion_time, got.last_updated) == (NOW, NOW, T0)

    cust = spec("customers")
    cols = cust.schema().add("ingestion_time", "timestamp").add("hash", "string")
    first = spark.createDataFrame([("C", "n", b"e", b"p", "a", T0, T0, T0, "h1")], cols)
    later = spark.createDataFrame(
        [("C", "m", b"e", b"p", "a", T0, T0 + timedelta(1), T0 + timedelta(2), "h2")], cols)
    stored = merge_upsert(empty_silver(spark, cust), first, cust, NOW).df
    assert (stored.first().updated_at, stored.first().ingestion_time) == (T0, T0)
    changed = merge_upsert(stored, later, cust, NOW).df.first()
    assert (changed.name, changed.updated_at, changed.ingestion_time) == (
        "m", NOW, T0 + timedelta(2))


def test_audit_logs_with_equal_ids(spark):
    rows = [(1, T0, tag, "u", "INSERT", "TABLE", "t", q, T0, f"h{tag}{q}")
            for tag, q in (("Pos", "a"), ("ERP", "b"))]
    cols = AUDIT_SILVER.silver_schema()
    stored = merge_upsert(empty_silver(spark, AUDIT_SILVER), spark.createDataFrame(rows, cols),
                          AUDIT_SILVER, NOW).df
    assert stored.count() == 2
    newer = spark.createDataFrame(
        [(1, T0, "ERP", "u", "INSERT", "TABLE", "t", "c", T0 + timedelta(1), "hx")], cols)
    out = merge_upsert(stored, newer, AUDIT_SILVER, NOW).df
    assert {(r.origin, r.query) for r in out.collect()} == {("Pos", "a"), ("ERP", "c")}


def test_changes_equal_change_feed(spark):
    old = merge_upsert(empty_silver(spark, ACCOUNTS), versions_of(
        spark, [(1, "a", 0), (2, "b", 0), (4, "z", 0)]), ACCOUNTS, NOW).df
    result = merge_upsert(old, versions_of(
        spark, [(2, "c", 1), (3, "d", 1), (4, None, 3, "d")]), ACCOUNTS, NOW, on_delete="delete")
    direct = result.changes()
    compared = change_feed(old, result.df, "account_id").select(direct.columns)
    assert direct.exceptAll(compared).count() == 0 and compared.exceptAll(direct).count() == 0
    kinds = sorted(r["_change_type"] for r in direct.collect())
    assert kinds == ["delete", "insert", "update_postimage", "update_preimage"]
    audit = audit_rows(direct, "me", "accounts", NOW, "merge")
    assert sorted(r.action_type for r in audit.collect()) == ["DELETE", "INSERT", "UPDATE"]


def test_reconcile_and_repair(spark):
    a = versions_of(spark, [(1, "a", 0), (2, "b", 0), (3, "c", 0)])
    b = versions_of(spark, [(1, "a", 0), (2, "x", 0), (4, "d", 0)])
    diff = reconcile(a, b, "account_id")
    assert {(r.account_id, r.status) for r in diff.collect()} == {
        (2, "different"), (3, "missing"), (4, "extra")}
    fixed = repair(b, a, diff, ACCOUNTS, NOW)
    assert state(fixed) == {1: "a", 2: "b", 3: "c", 4: "d"}
    report = integrity_report(a, b.unionAll(b), "account_id").first()
    assert tuple(report) == (3, 6, 3, 3, 1, 1)


def orders(spark, rows):
    """rows: (id, order day, status, updated day)"""
    data = [(i, "C", T0 + timedelta(days=d), None, "addr", 1, st, T0 + timedelta(days=u),
             T0, f"h{i}{d}{st}{u}") for i, d, st, u in rows]
    cols = spec("orders").schema().add("ingestion_time", "timestamp").add("hash", "string")
    return spark.createDataFrame(data, cols)


def test_merge_by_month_moves_rows(spark, tmp_path):
    s, path = spec("orders"), str(tmp_path / "orders")
    merge_into(spark, path, orders(spark, [(1, 0, "a", 0), (2, 40, "a", 40), (3, 70, "a", 70)]),
               s, NOW)
    result = merge_into(spark, path, orders(
        spark, [(2, 0, "moved", 50), (3, 70, "b", 71), (4, 100, "new", 100)]), s, NOW)
    assert result == (1, 2, 0)
    got = {(r.order_id, r.order_date.month, r.payment_status)
           for r in read_current(spark, path, s).collect()}
    assert got == {(1, 1, "a"), (2, 1, "moved"), (3, 3, "b"), (4, 4, "new")}
    feed = str(tmp_path / "feed")
    assert merge_into(spark, path, orders(spark, [(2, 0, "moved", 50)]), s, NOW) == (0, 0, 0)
    gone = orders(spark, [(4, 100, None, 101)]).withColumn("transaction_type", F.lit("d"))
    assert merge_into(spark, path, gone, s, NOW, feed=feed, on_delete="delete") == (0, 0, 1)
    assert {r.order_id for r in read_current(spark, path, s).collect()} == {1, 2, 3}
    assert [r["_change_type"] for r in spark.read.parquet(feed).collect()] == ["delete"]


def test_a_merge_that_died_is_finished(spark, tmp_path, monkeypatch):
    from tillstream.sources import current
    s, path = spec("orders"), str(tmp_path / "orders")
    merge_into(spark, path, orders(spark, [(1, 0, "a", 0), (2, 40, "a", 40)]), s, NOW)
    real = current._delete

    def dies(*_):
        raise OSError("executor host lost")
    monkeypatch.setattr(current, "_delete", dies)
    with pytest.raises(OSError):
        merge_into(spark, path, orders(spark, [(2, 0, "moved", 50)]), s, NOW)
    monkeypatch.setattr(current, "_delete", real)
    assert merge_into(spark, path, orders(spark, [(2, 0, "moved", 50)]), s, NOW) == (0, 0, 0)
    got = sorted((r.order_id, r.payment_status) for r in read_current(spark, path, s).collect())
    assert got == [(1, "a"), (2, "moved")]


def test_rows_without_a_date(spark, tmp_path):
    s, path = spec("orders"), str(tmp_path / "orders")
    undated = orders(spark, [(1, 0, "a", 0)]).withColumn("order_date", F.lit(None).cast("timestamp"))
    merge_into(spark, path, undated.unionByName(orders(spark, [(2, 0, "b", 0)])), s, NOW)
    assert merge_into(spark, path, orders(spark, [(1, 0, "dated", 1)]), s, NOW) == (0, 1, 0)
    assert sorted(r.payment_status for r in read_current(spark, path, s).collect()) == ["b", "dated"]


def test_versions_count_up_and_old_ones_go(spark, tmp_path):
    path, feed = str(tmp_path / "accounts"), str(tmp_path / "feed")
    merge_into(spark, path, versions_of(spark, [(1, "a", 0)]), ACCOUNTS, NOW)
    for want in ((1, 1, 0), (0, 0, 0)):      # the same micro-batch twice
        done = merge_into(spark, path, versions_of(spark, [(1, "b", 1), (2, "c", 1)]), ACCOUNTS,
                          NOW, feed=feed)
        assert done == want
    assert versions(spark, path) == [1, 2]
    assert spark.read.parquet(feed).count() == 3
    assert {r.account_id: r.account_type for r in read_current(spark, path, ACCOUNTS).collect()} \
        == {1: "b", 2: "c"}


def test_empty_batch_and_feed_of_a_merge_that_died(spark, tmp_path, monkeypatch):
    from tillstream.sources import current
    s, path, feed = spec("orders"), str(tmp_path / "orders"), str(tmp_path / "feed")
    rows = orders(spark, [(1, 0, "a", 0), (2, 40, "a", 40)])
    merge_into(spark, path, rows, s, NOW)
    assert merge_into(spark, path, rows.filter("order_id = 9"), s, NOW) == (0, 0, 0)
    real = current._publish

    def dies(spark, path, spec):
        if current.exists(spark, path + "_pending"):
            raise OSError("host lost")
    monkeypatch.setattr(current, "_publish", dies)
    new = orders(spark, [(2, 40, "b", 50)])
    with pytest.raises(OSError):
        merge_into(spark, path, new, s, NOW, feed=feed)
    monkeypatch.setattr(current, "_publish", real)
    merge_into(spark, path, new, s, NOW, feed=feed)
    assert spark.read.parquet(feed).filter("payment_status = 'b'").count() == 1


def test_a_row_without_time_does_not_win(spark):
    stored = versions_of(spark, [(1, "a", 0)])
    late = versions_of(spark, [(1, "b", 1)]).withColumn("updated_at", F.lit(None).cast("timestamp"))
    assert state(merge_upsert(stored, late, ACCOUNTS, NOW)) == {1: "a"}
    assert state(merge_upsert(late, stored, ACCOUNTS, NOW)) == {1: "a"}


def test_empty_target_is_empty(spark, tmp_path):
    assert read_current(spark, str(tmp_path / "none"), spec("orders")).count() == 0
    assert read_current(spark, str(tmp_path / "none"), ACCOUNTS).select(F.count("*")).first()[0] == 0


def test_a_large_batch_is_not_broadcast(spark, monkeypatch):
    batch = versions_of(spark, [(1, "a", 0), (2, "c", 1)])
    monkeypatch.setattr(merge, "is_small", lambda df: False)
    result = merge_upsert(versions_of(spark, [(2, "b", 0), (3, "d", 0)]), batch, ACCOUNTS, NOW, way="broadcast")
    assert "Broadcast" not in result.plan._jdf.queryExecution().executedPlan().toString()
    assert state(result) == {1: "a", 2: "c", 3: "d"}
