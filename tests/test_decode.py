from __future__ import annotations

import base64
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream.functions.scalars import decode_decimal, encode_decimal, row_hash
from tillstream.operators.decode import cast_drop, decode_cdc, decode_drop, rejects
from tillstream.operators.latest import dedup_batch
from tillstream.sources.tables import to_drop
from tillstream.specs import spec
from tillstream.streaming.flows import bronze_replay

EDGE = ["0", "0.01", "-0.01", "1.27", "1.28", "-1.28", "-1.29", "529.98", "9999999999.99",
        "-9999999999.99"]


def shortest(amount: str) -> str:
    """The encoding a connector sends: as few bytes as hold the signed value."""
    unscaled = int(Decimal(amount).scaleb(2))
    size = (unscaled if unscaled >= 0 else ~unscaled).bit_length() // 8 + 1
    return base64.b64encode(unscaled.to_bytes(size, "big", signed=True)).decode()


def message(op="c", ts="1704067200250", table="orders", **after) -> str:
    body = {"op": op, "after": after or None, "ts_ms": ts,
            "source": {"connector": "postgresql", "name": "pos_server", "db": "pos",
                       "schema": "public", "table": table}}
    return json.dumps({"payload": body})


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


ORDER = dict(order_id=1, customer_id="CUST_000001", order_date="2025-08-30T09:30:00Z",
             total_amount=shortest("529.98"), shipping_address="123 Le Loi", payment_type_id=2,
             payment_status="completed", updated_at="2025-08-30T09:30:00.123456Z")


def test_decimals(spark):
    df = spark.createDataFrame([(e, shortest(e)) for e in EDGE] + [(None, None)], "a string, b string")
    for a, got in df.select("a", decode_decimal(F.col("b"), 12, 2)).collect():
        assert got == (None if a is None else Decimal(a))


def test_decimal_round_trip_and_bad_input(spark):
    df = spark.createDataFrame([(Decimal(e),) for e in EDGE], "a decimal(12,2)")
    back = df.select("a", decode_decimal(encode_decimal(F.col("a"), 2), 12, 2).alias("b"))
    assert back.filter("not (a <=> b)").count() == 0
    bad = spark.createDataFrame([("###",), (base64.b64encode(b"123456789").decode(),),
                                 (shortest("99999999999999.99"),)], "b string")
    assert [r[0] for r in bad.select(decode_decimal(F.col("b"), 12, 2)).collect()] == [None] * 3


def test_order_message(spark):
    row = decode_cdc(frame(spark, message(**ORDER)), spec("orders")).first()
    assert row.total_amount == Decimal("529.98")
    assert row.order_date == datetime(2025, 8, 30, 9, 30)
    assert row.updated_at == datetime(2025, 8, 30, 9, 30, 0, 123456)
    assert row.ingestion_time == datetime(2024, 1, 1, 0, 0, 0, 250000)
    assert (row.transaction_type, row.connector, row.source) == (
        "c", "postgresql_pos_server", "pos.public.orders")


def test_bytes_and_truncated_time(spark):
    df = frame(spark, message(**ORDER)).select(F.col("value").cast("binary").alias("value"))
    row = decode_cdc(df, spec("orders"), truncate="second").first()
    assert row.ingestion_time == datetime(2024, 1, 1)


def test_dropped_messages(spark):
    df = frame(spark, message(**ORDER), message("d"), None, "", "{not json", "[1]",
               message("r", **ORDER), message("u", **ORDER), message("t", **ORDER))
    assert sorted(r.transaction_type for r in decode_cdc(df, spec("orders")).collect()) == [
        "c", "r", "u"]
    assert sorted(r.value for r in rejects(df, spec("orders")).collect()) == ["[1]", "{not json"]


def test_delete_as_tombstone(spark):
    body = json.loads(message("d"))
    body["payload"]["before"] = {"order_id": 7}
    rows = decode_cdc(frame(spark, json.dumps(body)), spec("orders"), on_delete="tombstone")
    row = rows.first()
    assert (row.order_id, row.transaction_type, row.customer_id) == (7, "d", None)


def test_bad_values_are_rejects(spark):
    df = frame(spark, message(**{**ORDER, "order_date": "yesterday", "total_amount": "?"}),
               message(ts="soon", **ORDER), message(**ORDER))
    assert decode_cdc(df, spec("orders")).count() == 1
    assert sorted(r.reason for r in rejects(df, spec("orders")).collect()) == [
        "unreadable: order_date, total_amount", "unreadable: ts_ms"]


def test_binary_and_micros(spark):
    c = decode_cdc(frame(spark, message(
        customer_id="C", name="N", email=base64.b64encode(b"\x00\xff").decode(), phone=None,
        address="A", created_at="2025-01-01T00:00:00Z", updated_at="2025-01-01T00:00:00Z")),
        spec("customers")).first()
    assert bytes(c.email) == b"\x00\xff" and c.phone is None
    a = decode_cdc(frame(spark, message(
        log_id=1, log_time="1704067200123456", user_name="u", action_type="INSERT",
        object_type="TABLE", object_name="orders", query="q")), spec("audit_log_pos")).first()
    assert a.log_time == datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_hash_null_modes(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    default = {r[0] for r in df.select(row_hash(df, df.columns)).collect()}
    skipping = {r[0] for r in df.select(row_hash(df, df.columns, "||", "skip")).collect()}
    assert len(default) == 2 and len(skipping) == 1


def test_hash_is_the_documented_digest(spark):
    import hashlib
    df = spark.createDataFrame([(1, None, bytearray(b"\x01\xab"))], "a long, b string, c binary")
    got = df.select(row_hash(df, df.columns)).first()[0]
    assert got == hashlib.sha256(b"1||01AB").hexdigest()


def test_replay_keeps_one_row_per_content(spark):
    late = message(ts="1704067260000", **ORDER)
    df = frame(spark, message(**ORDER), message(**ORDER), late,
               message(**{**ORDER, "payment_status": "failed"}))
    rows = bronze_replay(spec("orders"), df).collect()
    assert len(rows) == 2
    first = next(r for r in rows if r.payment_status == "completed")
    assert first.ingestion_time == datetime(2024, 1, 1, 0, 0, 0, 250000)


def test_same_hash_of_other_key_survives(spark):
    df = spark.createDataFrame([(1, "h"), (2, "h"), (2, "h")], "k int, hash string")
    assert dedup_batch(df, "k").count() == 2


@pytest.mark.parametrize("name", ["employees", "products_sku", "audit_log_erp", "suppliers"])
def test_drop_round_trip(spark, name):
    from tillstream.sources.seed import load_seed
    s = spec(name)
    if name.startswith("audit"):
        typed = spark.createDataFrame(
            [(1, datetime(2024, 1, 1, 1, 2, 3, 45), "u", "INSERT", "TABLE", None, "q")], s.schema())
    else:
        typed = load_seed(spark)[name]
    dropped = to_drop(typed, s)
    assert dropped.schema.simpleString() == s.drop_schema().simpleString()
    assert cast_drop(dropped, s).exceptAll(typed).count() == 0
    loaded = decode_drop(dropped, s, F.lit("2024-01-02").cast("timestamp"))
    assert set(loaded.columns) == set(s.bronze_schema().names)
    assert {r.transaction_type for r in loaded.collect()} == {"c"}
