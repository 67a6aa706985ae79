"""Queries on change decode, bronze loads and deduplication."""

from __future__ import annotations

from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity, entity_sql, hash_sql, table
from tillstream.catalog.messages import (
    UPDATE_AT, log_sql, messages, shown, shown_sql)
from tillstream.catalog.registry import Catalog
from tillstream.functions.scalars import decode_decimal, encode_decimal, line_amount, row_hash
from tillstream.operators import decode, latest
from tillstream.session import run_dir
from tillstream.sources.cdc import cdc_stream
from tillstream.sources.tables import extract_full, spread, to_drop
from tillstream.specs import SPECS
from tillstream.streaming.flows import (
    bronze_files, bronze_files_aside, bronze_replay, bronze_replay_from, bronze_stream, bronze_stream_aside)
from tillstream.streaming.log import STREAM_LOG, counted, logged_streams
from tillstream.streaming.runs import run_available_now

CATALOG = Catalog()

STREAMED = ("customers", "orders", "order_items", "inventory", "shipments", "delivery_tracking",
            "purchase_orders", "purchase_order_items", "financial_transactions")


def _unique_sql(name: str, columns: list[str]) -> str:
    key = ", ".join(SPECS[name].key)
    return f"""{log_sql(name)}
        select {shown_sql(name, columns)} from (
            select *, row_number() over (
                partition by {key}, hash
                order by ingestion_time, transaction_type, connector, source) as rn
            from log) where rn = 1"""


def _add_bronze(name: str) -> None:
    spec = SPECS[name]

    def replay(spark, sf_dir):
        return shown(bronze_replay(spec, messages(spark, sf_dir, name)), name)

    CATALOG.add(f"bronze_{name}", replay, _unique_sql(name, spec.bronze_schema().names))


def _send(sent: DataFrame, folder: str) -> None:
    """Messages as a folder of JSON lines, packed: as plain text they are many times the tables. A packed
    file is read by one task, so none is long."""
    (sent.filter("value is not null").write.mode("append").option("compression", "gzip")
     .option("maxRecordsPerFile", 500_000).text(folder))


def _add_stream(name: str) -> None:
    spec = SPECS[name]
    # Which copy of a repeated row a stream keeps depends on arrival; its content does not.
    columns = [*spec.columns, "connector", "source", "hash"]

    def stream(spark, sf_dir):
        base = run_dir(spark, f"stream-{name}")
        _send(messages(spark, sf_dir, name), f"{base}/in")
        bronze_stream(spark, spec, f"{base}/in", f"{base}/bronze", f"{base}/state")
        return shown(spark.read.parquet(f"{base}/bronze").select(*columns), name)

    CATALOG.add(f"stream_{name}", stream, _unique_sql(name, columns))


def _add_files(name: str) -> None:
    spec = SPECS[name]
    columns = [*spec.columns, "ingestion_time", "transaction_type", "connector", "hash"]

    def files(spark, sf_dir):
        base = run_dir(spark, f"files-{name}")
        rows = to_drop(entity(spark, sf_dir, name), spec)
        extract_full(rows, f"{base}/drop", date(2024, 1, 2))
        bronze_files(spark, spec, f"{base}/drop", f"{base}/bronze", f"{base}/state",
                     now=F.lit("2024-01-02 01:00:00").cast("timestamp"))
        return shown(spark.read.parquet(f"{base}/bronze").select(*columns), name)

    CATALOG.add(f"files_{name}", files, f"""with e as {entity_sql(name)}
        select distinct {shown_sql(name, spec.columns)},
               timestamp '2024-01-02 01:00:00' as ingestion_time, 'c' as transaction_type,
               '{decode.BATCH_CONNECTOR}' as connector, {hash_sql(name, 'e.')} as hash
        from e""")


for _name, _spec in SPECS.items():
    _add_bronze(_name)
    if _name in STREAMED:
        _add_stream(_name)
    if _spec.file_fed:
        _add_files(_name)


@CATALOG.query("replay_folder", f"""{log_sql("shipments")}
    select {", ".join(SPECS["shipments"].columns)}, transaction_type, hash from log""")
def replay_folder(spark, sf_dir):
    """A folder of messages read as a bounded source, from the first one to the last."""
    path = run_dir(spark, "messages")
    _send(messages(spark, sf_dir, "shipments"), path)
    rows = bronze_replay_from(spark, SPECS["shipments"], path)
    return rows.select(*SPECS["shipments"].columns, "transaction_type", "hash")


@CATALOG.query("cdc_decimal_decode", f"""{ctes("orders")}
    select order_id, total_amount, cast(-total_amount as decimal(12,2)) as negated from orders""")
def cdc_decimal_decode(spark, sf_dir):
    o = entity(spark, sf_dir, "orders")
    sent = o.select("order_id", encode_decimal(F.col("total_amount"), 2).alias("t"),
                    encode_decimal(-F.col("total_amount"), 2).alias("n"))
    return sent.select("order_id", decode_decimal(F.col("t"), 12, 2).alias("total_amount"),
                       decode_decimal(F.col("n"), 12, 2).alias("negated"))


@CATALOG.query("cdc_op_filter", f"""{ctes("orders")}
    select 'r' as op, count(*) as messages from orders
    union all select 'u', 2 * count(*) from orders where payment_status = 'pending'""")
def cdc_op_filter(spark, sf_dir):
    spec = SPECS["orders"]
    kept = decode.keep_ops(decode.decode_envelope(messages(spark, sf_dir, "orders"), spec))
    return kept.groupBy(F.col("payload.op").alias("op")).agg(F.count(F.lit(1)).alias("messages"))


@CATALOG.query("cdc_rejects", """
    select props as value, 'malformed message' as reason from events""")
def cdc_rejects(spark, sf_dir):
    """Bodies without an envelope (event properties) beside good messages."""
    bad = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    good = messages(spark, sf_dir, "accounts")
    return decode.rejects(bad.unionByName(good), SPECS["accounts"])


_SPOILED = """case order_id % 4 when 0 then 'unreadable: total_amount'
    when 1 then 'unreadable: order_date' when 2 then 'unreadable: updated_at, ts_ms' end"""


def _spoiled(spark, sf_dir):
    """Order messages, each with one field made unreadable, or none."""
    o = entity(spark, sf_dir, "orders").select("order_id", (F.col("order_id") % 4).alias("kind"))
    time = F.lit("2024-01-01T00:00:00Z")
    after = F.struct("order_id", F.lit("C").alias("customer_id"),
                     F.when(F.col("kind") == 1, "yesterday").otherwise(time).alias("order_date"),
                     F.when(F.col("kind") == 0, "?").otherwise("AAAAAAAAAAAE0g==").alias("total_amount"),
                     F.when(F.col("kind") == 2, "later").otherwise(time).alias("updated_at"))
    payload = F.struct(F.lit("c").alias("op"), after.alias("after"),
                       F.when(F.col("kind") == 2, "soon").otherwise("1704067200000").alias("ts_ms"))
    return o.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"))


@CATALOG.query("cdc_field_rejects", f"""{ctes("orders")}
    select order_id, {_SPOILED} as reason from orders where order_id % 4 < 3""")
def cdc_field_rejects(spark, sf_dir):
    found = decode.rejects(_spoiled(spark, sf_dir), SPECS["orders"])
    return found.select(F.get_json_object("value", "$.payload.after.order_id").cast("bigint")
                        .alias("order_id"), "reason")


@CATALOG.query("cdc_decimal_wide", f"""{ctes("orders")}
    select order_id, cast(12.34 as decimal(12,2)) as total_amount from orders where order_id % 4 = 3""")
def cdc_decimal_wide(spark, sf_dir):
    """Amounts of ten bytes are read; messages with an unreadable field do not go on."""
    return decode.decode_cdc(_spoiled(spark, sf_dir), SPECS["orders"]).select("order_id", "total_amount")


@CATALOG.query("drop_field_rejects", f"""{ctes("products_sku")}
    select sku_id, 'unreadable: price' as reason from products_sku where sku_id % 3 = 0""")
def drop_field_rejects(spark, sf_dir):
    rows = to_drop(entity(spark, sf_dir, "products_sku"), SPECS["products_sku"])
    spoiled = rows.withColumn("price", F.when(F.col("sku_id").cast("bigint") % 3 == 0, "cheap")
                              .otherwise(F.col("price")))
    return decode.drop_rejects(spoiled, SPECS["products_sku"]).select(
        F.col("sku_id").cast("bigint").alias("sku_id"), "reason")


def _order_id(value: str = "value"):
    return F.get_json_object(value, "$.payload.after.order_id").cast("bigint").alias("order_id")


@CATALOG.query("stream_rejects", f"""{ctes("orders")}
    select order_id, {_SPOILED} as reason from orders where order_id % 4 < 3
    union all select null, 'malformed message' from events""")
def stream_rejects(spark, sf_dir):
    """What a stream of good, spoiled and malformed messages leaves in its side table."""
    base = run_dir(spark, "rejects")
    bad = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    _spoiled(spark, sf_dir).unionByName(bad).write.text(f"{base}/in")
    bronze_stream_aside(spark, SPECS["orders"], f"{base}/in", f"{base}/bronze", f"{base}/state", f"{base}/aside")
    return spark.read.parquet(f"{base}/aside/rejects").select(_order_id(), "reason")


@CATALOG.query("stream_run_log", f"""{ctes("orders")}
    select 'success' as status, count(*) as rows_in, count(*) filter (where order_id % 4 = 3) as rows_out
    from orders union all select 'failed', null, null""")
def stream_run_log(spark, sf_dir):
    """What the log holds of a stream in several micro-batches, and of one that fails."""
    base = run_dir(spark, "stream-log")
    _spoiled(spark, sf_dir).repartition(4).write.text(f"{base}/in")
    source = cdc_stream(spark, f"{base}/in", max_files=1)
    with logged_streams(spark, f"{base}/log"):
        rows = decode.decode_cdc(source, SPECS["orders"])
        run_available_now(counted(rows), f"{base}/out", f"{base}/state")
        try:
            run_available_now(source.filter(F.raise_error(F.lit("no more room")).isNull()), f"{base}/none",
                              f"{base}/none-state")
        except StreamingQueryException:
            pass
    return spark.read.schema(STREAM_LOG).parquet(f"{base}/log").groupBy("status").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))


_DELAY = "60 days"
_AT_SQL = "o_orderdate + (o_orderkey % 24) * interval 1 hour"


def _two_deliveries(spark, sf_dir):
    """Bronze and side folders of two deliveries: orders with an even key, then the others along with
    every third of the first ones again. Orders are sent at an hour of their day."""
    base, spec = run_dir(spark, "late"), SPECS["orders"]
    sent = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.unix_millis(F.expr(_AT_SQL)).cast("string").alias("ts_ms"))
    payload = F.struct(F.lit("c").alias("op"), F.struct(F.col("k").alias("order_id")).alias("after"), "ts_ms")
    body = F.to_json(F.struct(payload.alias("payload"))).alias("value")
    for wanted in ("k % 2 = 0", "k % 2 = 1 or k % 6 = 0"):
        sent.filter(wanted).select(body).write.mode("append").text(f"{base}/in")
        bronze_stream_aside(spark, spec, f"{base}/in", f"{base}/bronze", f"{base}/state", f"{base}/aside", _DELAY)
    return base


_MARK_SQL = f"(select max({_AT_SQL}) - interval {_DELAY} from orders where o_orderkey % 2 = 0)"


@CATALOG.query("stream_late_rows", f"""
    select o_orderkey as order_id, {_AT_SQL} as ingestion_time from orders
    where (o_orderkey % 2 = 1 or o_orderkey % 6 = 0) and {_AT_SQL} <= {_MARK_SQL}""")
def stream_late_rows(spark, sf_dir):
    late = spark.read.parquet(f"{_two_deliveries(spark, sf_dir)}/aside/late")
    return late.select("order_id", "ingestion_time")


@CATALOG.query("stream_in_time", f"""
    select o_orderkey as order_id, {_AT_SQL} as ingestion_time from orders
    where o_orderkey % 2 = 0 or {_AT_SQL} > {_MARK_SQL}""")
def stream_in_time(spark, sf_dir):
    """The bronze rows of the same flow: repeats once, late rows not."""
    rows = spark.read.parquet(f"{_two_deliveries(spark, sf_dir)}/bronze")
    return rows.select("order_id", "ingestion_time")


def _spoiled_drop(spark, sf_dir):
    """SKUs as a file drop, every third with a price that is none; both tables of the load."""
    base, spec = run_dir(spark, "drops"), SPECS["products_sku"]
    rows = to_drop(entity(spark, sf_dir, "products_sku"), spec)
    spoiled = rows.withColumn("price", F.when(F.col("sku_id").cast("bigint") % 3 == 0, "cheap").otherwise(F.col("price")))
    extract_full(spoiled, f"{base}/drop", date(2024, 1, 2))
    bronze_files_aside(spark, spec, f"{base}/drop", f"{base}/bronze", f"{base}/state", f"{base}/aside",
                       now=F.lit("2024-01-02 01:00:00").cast("timestamp"))
    return base


@CATALOG.query("files_rejects", f"""{ctes("products_sku")}
    select sku_id, sku, 'cheap' as price, 'unreadable: price' as reason from products_sku where sku_id % 3 = 0""")
def files_rejects(spark, sf_dir):
    found = spark.read.parquet(f"{_spoiled_drop(spark, sf_dir)}/aside/rejects")
    body = {c: F.get_json_object("value", f"$.{c}") for c in ("sku_id", "sku", "price")}
    return found.select(body["sku_id"].cast("bigint").alias("sku_id"), body["sku"].alias("sku"),
                        body["price"].alias("price"), "reason")


@CATALOG.query("files_by_month", f"""{ctes("products_sku")}
    select sku_id, sku, price, '202401' as month from products_sku where sku_id % 3 <> 0""")
def files_by_month(spark, sf_dir):
    """The good rows of the same load, in month folders."""
    rows = spark.read.parquet(f"{_spoiled_drop(spark, sf_dir)}/bronze")
    return rows.select("sku_id", "sku", "price", F.col("month").cast("string").alias("month"))


@CATALOG.query("cdc_deletes_kept", f"""{log_sql("orders")}
    select order_id, transaction_type, payment_status, total_amount, ingestion_time from log
    union all
    select order_id, transaction_type, payment_status, total_amount, ingestion_time from log
    where transaction_type = 'u'
    union all
    select order_id, 'd', null, null, timestamp '{UPDATE_AT}' from e
    where payment_status = 'pending'""")
def cdc_deletes_kept(spark, sf_dir):
    rows = decode.decode_cdc(messages(spark, sf_dir, "orders"), SPECS["orders"],
                             on_delete="tombstone")
    return rows.select("order_id", "transaction_type", "payment_status", "total_amount",
                       "ingestion_time")


@CATALOG.query("event_time_seconds", f"""{log_sql("accounts")}
    select account_id, transaction_type, date_trunc('second', ingestion_time) as ingestion_time
    from log union all
    select account_id, transaction_type, date_trunc('second', ingestion_time) from log
    where transaction_type = 'u'""")
def event_time_seconds(spark, sf_dir):
    rows = decode.decode_cdc(messages(spark, sf_dir, "accounts"), SPECS["accounts"],
                             truncate="second")
    return rows.select("account_id", "transaction_type", "ingestion_time")


@CATALOG.query("row_hash_cdc", f"""{ctes("orders")}
    select order_id, {hash_sql("orders")} as hash from orders""")
def row_hash_cdc(spark, sf_dir):
    o = entity(spark, sf_dir, "orders")
    return o.select("order_id", row_hash(o, SPECS["orders"].columns).alias("hash"))


@CATALOG.query("row_hash_wire", f"""{ctes("accounts")}
    select account_id, sha256(concat_ws('|', cast(account_id as varchar), account_name,
        account_type, strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ'))) as hash from accounts
    union
    select account_id, sha256(concat_ws('|', cast(account_id as varchar), account_name,
        account_type, strftime(updated_at + interval 1 day, '%Y-%m-%dT%H:%M:%SZ'))) as hash
    from accounts where account_type = 'asset'""")
def row_hash_wire(spark, sf_dir):
    rows = decode.decode_cdc(messages(spark, sf_dir, "accounts"), SPECS["accounts"],
                             hash_mode="raw")
    return rows.select("account_id", "hash").distinct()


@CATALOG.query("row_hash_batch", f"""{ctes("products_sku")}
    select sku_id, sha256(concat_ws('||', cast(sku_id as varchar), sku, product_id, color, size,
        cast(price as varchar), cast(created_at as varchar), cast(deleted_at as varchar),
        cast(updated_at as varchar))) as hash from products_sku""")
def row_hash_batch(spark, sf_dir):
    spec = SPECS["products_sku"]
    rows = to_drop(entity(spark, sf_dir, "products_sku"), spec)
    loaded = decode.decode_drop(rows, spec, F.lit("2024-01-02").cast("timestamp"), "raw")
    return loaded.select("sku_id", "hash")


@CATALOG.query("recent_lookback", """
    select event_id, ts from events where ts >= timestamp '2024-01-06 00:00:00'""")
def recent_lookback(spark, sf_dir):
    return latest.recent(table(spark, sf_dir, "events").select("event_id", "ts"),
                         "2024-01-20 08:00:00", 14, "ts")


@CATALOG.query("dedup_key_hash", f"""{ctes("order_items")}
    select distinct order_item_id, {hash_sql("order_items")} as hash from order_items""")
def dedup_key_hash(spark, sf_dir):
    items = spread(entity(spark, sf_dir, "order_items"))
    hashed = items.select("order_item_id", row_hash(items, items.columns).alias("hash"))
    return latest.dedup_batch(hashed, "order_item_id")


@CATALOG.query("dedup_hash", f"""{ctes("order_items")}
    select distinct {hash_sql("order_items")} as hash from order_items""")
def dedup_by_hash(spark, sf_dir):
    items = spread(entity(spark, sf_dir, "order_items"))
    return latest.dedup_hash(items.select(row_hash(items, items.columns).alias("hash")))


@CATALOG.query("latest_per_key", f"""{ctes("order_items")},
    h as (select *, {hash_sql("order_items")} as hash from order_items)
    select order_item_id, order_id, product_id, sku_id, quantity, unit_price, order_date,
           updated_at, hash
    from (select *, row_number() over (partition by order_item_id
                                       order by updated_at desc, hash desc) as rn from h)
    where rn = 1""")
def latest_per_key(spark, sf_dir):
    items = spread(entity(spark, sf_dir, "order_items"))
    hashed = items.withColumn("hash", row_hash(items, items.columns))
    return latest.latest_per_key(hashed, "order_item_id", "updated_at")


@CATALOG.query("latest_audit", """
    select user_id, event_id, event_type, ts from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc,
                                     event_type desc) as rn from events) where rn = 1""")
def latest_audit(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return latest.latest_per_key(e, "user_id", "ts", ["event_id", "event_type"])


@CATALOG.query("line_amounts", f"""{ctes("order_items")}
    select order_item_id, quantity, unit_price,
           cast(quantity * unit_price as decimal(18,2)) as amount from order_items""")
def line_amounts(spark, sf_dir):
    return entity(spark, sf_dir, "order_items").select(
        "order_item_id", "quantity", "unit_price", line_amount().alias("amount"))
