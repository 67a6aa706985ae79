from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.test_decode import ORDER, frame, message
from tillstream import session
from tillstream.catalog import ingest
from tillstream.catalog.messages import messages
from tillstream.functions.scalars import row_hash
from tillstream.operators.audit import run_logged
from tillstream.operators.decode import decode_cdc
from tillstream.sources import tables
from tillstream.sources.cdc import cdc_batch
from tillstream.sources.current import read_current
from tillstream.sources.seed import load_seed
from tillstream.specs import spec
from tillstream.streaming.flows import (
    bronze_files, bronze_files_aside, bronze_replay, bronze_replay_from, bronze_stream, bronze_stream_aside,
    silver_stream)
from tillstream.streaming.runs import dedup_rows, dedup_stream, late_rows

ORDERS = spec("orders")
HOUR = 3_600_000
START = 1704067200000


def order(i, ts, status="pending"):
    return message(ts=str(ts), **{**ORDER, "order_id": i, "payment_status": status})


def put(spark, folder, *values):
    frame(spark, *values).coalesce(1).write.mode("append").text(folder)


def test_stream_equals_replay(spark, tmp_path):
    base = str(tmp_path)
    lines = [order(i % 40, START + i * 1000, f"s{i % 3}") for i in range(200)]
    put(spark, f"{base}/in", *lines, message("d"), "", "{broken")
    bronze_stream(spark, ORDERS, f"{base}/in", f"{base}/bronze", f"{base}/state")
    got = spark.read.parquet(f"{base}/bronze").select("order_id", "hash")
    want = bronze_replay_from(spark, ORDERS, f"{base}/in").select("order_id", "hash")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 120 and cdc_batch(spark, f"{base}/in").columns == ["value"]


def test_restart_drops_repeats_and_late_rows(spark, tmp_path):
    base = str(tmp_path)
    args = (spark, ORDERS, f"{base}/in", f"{base}/bronze", f"{base}/state")
    put(spark, f"{base}/in", order(1, START + 5 * HOUR), order(2, START + 5 * HOUR))
    bronze_stream(*args)
    put(spark, f"{base}/in", order(1, START + 5 * HOUR),        # repeated
        order(3, START + HOUR),                                  # behind the watermark
        order(4, START + 5 * HOUR))
    query = bronze_stream(*args)
    rows = spark.read.parquet(f"{base}/bronze")
    assert sorted(r.order_id for r in rows.collect()) == [1, 2, 4]
    assert late_rows(query) == 1


def test_file_drops_are_read_once(spark, tmp_path):
    base, s = str(tmp_path), spec("accounts")
    accounts = tables.to_drop(load_seed(spark)["accounts"], s)
    now = F.lit("2025-09-03").cast("timestamp")
    assert tables.extract_full(accounts.filter("false"), f"{base}/drop", date(2025, 9, 1)) is None
    for day, rows in ((2, accounts.filter("account_id < 4")), (3, accounts)):
        tables.extract_full(rows, f"{base}/drop", date(2025, 9, day))
        bronze_files(spark, s, f"{base}/drop", f"{base}/bronze", f"{base}/state", now)
    got = spark.read.parquet(f"{base}/bronze")
    assert sorted(r.account_id for r in got.collect()) == [1, 2, 3, 4, 5]
    assert got.filter("source like '%dt=202509%'").count() == 5


@pytest.mark.parametrize("name", ["orders", "customers"])
def test_silver_stream_batch_by_batch(spark, tmp_path, name):
    base, s = str(tmp_path), spec(name)
    now = datetime(2025, 1, 1)
    def batch(first, last, day):
        body = {"orders": lambda i: order(i, START + day * HOUR, f"day{day}"),
                "customers": lambda i: message(
                    ts=str(START + day * HOUR), customer_id=f"C{i}", name=f"day{day}", email=None,
                    phone=None, address="a", created_at="2024-01-01T00:00:00Z",
                    updated_at=f"2024-01-0{day}T00:00:00Z")}[name]
        rows = bronze_replay(s, frame(spark, *[body(i) for i in range(first, last)]))
        tables.batch_append(rows.coalesce(1), f"{base}/bronze")
        silver_stream(spark, s, f"{base}/bronze", f"{base}/silver", f"{base}/state", now)
    batch(0, 4, 1)
    batch(2, 6, 2)
    rows = read_current(spark, f"{base}/silver", s).collect()
    value = {"orders": "payment_status", "customers": "name"}[name]
    assert sorted(r[value] for r in rows) == ["day1"] * 2 + ["day2"] * 4


def test_months(spark, tmp_path):
    assert tables.next_month_bounds(date(2025, 11, 28)) == (
        "202512", date(2025, 12, 1), date(2026, 1, 1))
    assert tables.next_month_bounds(date(2025, 12, 28))[0] == "202601"
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(1, datetime(2025, 1, 31, 23, 59, 59)), (2, datetime(2025, 2, 1))], "id int, ts timestamp")
    tables.write_partitioned(df, path, "ts")
    tables.write_partitioned(df.filter("id = 2").withColumn("id", F.lit(9)), path, "ts")
    assert {(r.id, str(r.month)) for r in spark.read.parquet(path).collect()} == {
        (1, "202501"), (9, "202502")}


def test_truncate_and_evolution(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.batch_append(spark.range(3), path)
    tables.batch_append(spark.range(2).withColumn("extra", F.lit("x")), path)
    schema = spark.range(0).withColumn("extra", F.lit("x")).schema
    rows = tables.read_evolving(spark, path, schema)
    assert rows.count() == 5 and rows.filter("extra is null").count() == 3
    tables.truncate(spark, path, schema)
    assert tables.read_table(spark, path).count() == 0
    wide = tables.align_to(spark.range(1).withColumn("z", F.lit(1)), schema)
    assert wide.columns == ["id", "extra", "z"]


def test_incremental_extract(spark):
    df = spark.createDataFrame([(1, datetime(2025, 1, 1)), (2, datetime(2025, 1, 2))],
                               "id int, ts timestamp")
    new, mark = tables.extract_incremental(df, "ts", datetime(2025, 1, 1))
    assert [r.id for r in new.collect()] == [2] and mark.first()[0] == datetime(2025, 1, 2)
    none, same = tables.extract_incremental(df, "ts", datetime(2025, 1, 2))
    assert none.count() == 0 and same.first()[0] == datetime(2025, 1, 2)
    assert tables.extract_incremental(df, "ts", None)[0].count() == 2


def test_jdbc_options_split_the_read():
    opts = tables.jdbc_options("jdbc:x", "orders", "order_id", 0, 100, 8, user="u")
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "order_id"


def test_bucketed_tables_join_without_shuffle(spark):
    a = spark.range(100).withColumn("v", F.lit("a"))
    names = [f"bucketed_{n}_{datetime.now():%H%M%S%f}" for n in "ab"]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in names:
            tables.save_bucketed(a, n, "id", 4)
        joined = spark.table(names[0]).join(spark.table(names[1]), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        for n in names:
            spark.sql(f"drop table if exists {n}")


def test_run_log(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    ok = run_logged(spark, "job", "t", spark.range(10), lambda d: d.filter("id < 3"),
                    lambda d: d.write.parquet(out), log)
    assert (ok["rows_in"], ok["rows_out"], ok["status"]) == (10, 3, "success")
    with pytest.raises(Exception, match="nope"):
        run_logged(spark, "job", "t", spark.range(10), lambda d: d.select("nope"),
                   lambda d: d.write.parquet(out), log)
    bad = spark.read.parquet(log).filter("status = 'failed'").first()
    assert "nope" in bad["error"] and spark.read.parquet(log).count() == 2


def test_shared_folder_is_the_one_named(spark):
    def session_with(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: None))
    named = session_with("yarn", **{"spark.checkpoint.dir": "hdfs:/shared"})
    assert session.run_dir(named, "x").startswith("hdfs:/shared/x-")
    with pytest.raises(RuntimeError):
        session.shared_dir(session_with("yarn"))


def test_seed_matches_its_schemas(spark):
    for name, df in load_seed(spark).items():
        assert df.schema.simpleString() == spec(name).schema().simpleString()
        assert df.count() >= 5


def test_message_shape():
    assert json.loads(order(1, START))["payload"]["after"]["order_id"] == 1
    assert timedelta(milliseconds=HOUR) == timedelta(hours=1)


def test_nothing_is_lost_beside_a_stream(spark, tmp_path):
    """Each message is in bronze, or aside with its reason, once; also when a batch is run again."""
    base = str(tmp_path)
    args = (spark, ORDERS, f"{base}/in", f"{base}/bronze", f"{base}/state", f"{base}/aside")
    put(spark, f"{base}/in", order(1, START + 5 * HOUR), order(1, START + 5 * HOUR), message("d"), "", "{broken",
        order(2, START + 4 * HOUR, "paid"), message(ts=str(START), **{**ORDER, "order_date": "soon"}))
    bronze_stream_aside(*args)
    put(spark, f"{base}/in", order(1, START + 5 * HOUR), order(3, START + HOUR), order(4, START + 6 * HOUR),
        order(2, START + 4 * HOUR, "paid"), order(2, START + 5 * HOUR, "late payment"), "[]")
    bronze_stream_aside(*args)

    def state():
        bronze, late, rejects = (spark.read.parquet(f"{base}/{p}") for p in ("bronze", "aside/late", "aside/rejects"))
        return (sorted((r.order_id, r.payment_status) for r in bronze.collect()),
                sorted((r.order_id, r.batch) for r in late.collect()),
                sorted((r.reason, r.batch) for r in rejects.collect()))

    first = state()
    assert first == ([(1, "pending"), (2, "late payment"), (2, "paid"), (4, "pending")], [(2, 1), (3, 1)],
                     [("malformed message", 0), ("malformed message", 1), ("unreadable: order_date", 0)])
    # As after a host that died before the second batch was recorded as done.
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "query" / "commits" / name).unlink()
    bronze_stream_aside(*args)
    assert state() == first


def test_file_drops_by_month_with_rejects(spark, tmp_path):
    base, skus = str(tmp_path), spec("products_sku")
    rows = spark.createDataFrame([("1", "A", "9.50"), ("2", "B", "cheap"), ("3", "C", None)], "sku_id string, sku string, price string")
    drop = tables.align_to(rows, skus.drop_schema())
    for day, now in (("20240131", "2024-01-31 01:00:00"), ("20240201", "2024-02-01 01:00:00"),
                     ("20240202", "2024-02-02 01:00:00")):
        drop.write.parquet(f"{base}/drop/dt={day}")
        bronze_files_aside(spark, skus, f"{base}/drop", f"{base}/bronze", f"{base}/state", f"{base}/aside",
                           F.lit(now).cast("timestamp"))
    # A batch goes by the times of those before it: the second day still knows the first, the third not.
    got = spark.read.parquet(f"{base}/bronze").select("sku_id", "month", "batch").collect()
    assert sorted(map(tuple, got)) == [(1, 202401, 0), (1, 202402, 2), (3, 202401, 0), (3, 202402, 2)]
    bad = spark.read.parquet(f"{base}/aside/rejects").collect()
    assert [(json.loads(r.value)["price"], r.reason) for r in bad] == [("cheap", "unreadable: price")] * 3


def test_a_stream_remembers_hashes_as_bytes(spark):
    told = ["ab" * 32, "AB", "x", "abc", "", "ab\n", None]
    df = spark.createDataFrame([(1, h) for h in told for _ in range(2)], "k long, hash string")
    once = dedup_stream(df, "k", bounded_state=False)
    assert once.columns == df.columns and sorted(r.hash or "-" for r in once.collect()) == sorted(h or "-" for h in told)
    assert "_digest" in once._jdf.queryExecution().executedPlan().toString()


def test_rows_alike_are_those_with_equal_hashes(spark):
    """Whatever is null, empty, long or holds the separator; and rows come out as they went in."""
    texts = [None, "", "a", "|", "a|", "|a", "a|a", "a" * 80]
    rows = [(k, a, n, b, x) for k in (None, "", "k", "k|") for a in texts for n in (None, 1) for b in texts
            for x in (None, b"", b"a")]
    df = spark.createDataFrame(rows * 2, "k string, a string, n long, b string, x binary")
    columns = df.columns
    df = df.withColumn("source", F.lit("s")).withColumn("hash", row_hash(df, columns))
    want, got = (d.select(*df.columns) for d in (dedup_stream(df, "k", False), dedup_rows(df, "k", columns, False)))
    both = [sorted(map(str, d.select("k", "hash").collect())) for d in (want, got)]
    assert both[0] == both[1] and len(both[1]) < len(rows)
    assert got.count() == got.distinct().count() == got.join(
        df.distinct(), [got[c].eqNullSafe(df[c]) for c in df.columns], "left_semi").count()


def test_a_stream_moves_columns_and_no_hash(spark, tmp_path):
    """What follows from the columns is made behind the shuffle, and files are packed by an entropy coder."""
    rows = spark.createDataFrame([(1, "a", None), (1, "a", None)], "order_id long, payment_status string, hash string")
    text = dedup_rows(rows, "order_id", ["order_id", "payment_status"], False)._jdf.queryExecution().executedPlan().toString()
    moved = text[text.index("Exchange"):].splitlines()[0]
    assert "payment_status" in moved and "hash#" not in moved
    base = str(tmp_path)
    put(spark, f"{base}/in", order(1, START), order(1, START), order(2, START + HOUR))
    bronze_stream(spark, ORDERS, f"{base}/in", f"{base}/bronze", f"{base}/state")
    assert list((tmp_path / "bronze").glob("month=*/*.zstd.parquet"))
    want = bronze_replay_from(spark, ORDERS, f"{base}/in")
    assert sorted(map(str, spark.read.parquet(f"{base}/bronze").select(*want.columns).collect())) == sorted(
        map(str, want.collect()))


@pytest.mark.parametrize("name", ["order_items", "delivery_tracking", "inventory", "purchase_order_items"])
def test_no_hash_is_moved_by_the_streams(spark, name):
    """Shuffle and state are by the key and the other columns; a digest is there for odd rows only."""
    s = spec(name)
    rows = decode_cdc(messages(spark, "/root/testdata/sf0.001", name), s)
    text = dedup_rows(rows, s.key, s.columns, False)._jdf.queryExecution().executedPlan().toString()
    moved = next(line for line in text.splitlines() if "Exchange hashpartitioning(" in line)
    by = moved[moved.index("(") + 1:moved.index(")")].split(", ")[:-1]
    assert {column.split("#")[0] for column in by} == {*s.columns, "_digest"}


def test_messages_are_sent_packed(spark, tmp_path):
    ingest._send(spark.createDataFrame([("a",), (None,), ("b",)], "value string"), str(tmp_path / "in"))
    assert {p.suffix for p in (tmp_path / "in").glob("part-*")} == {".gz"}
    assert sorted(r.value for r in cdc_batch(spark, str(tmp_path / "in")).collect()) == ["a", "b"]
