"""Queries on the current-state tables: silver loads, merges, change feeds, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity, hash_sql
from tillstream.catalog.messages import (
    log_sql, messages, shown, shown_sql)
from tillstream.catalog.registry import Catalog
from tillstream.functions.scalars import row_hash
from tillstream.operators import audit, merge
from tillstream.operators.decode import decode_cdc
from tillstream.session import run_dir
from tillstream.sources.current import merge_into, read_current
from tillstream.sources.tables import batch_append, spread
from tillstream.specs import AUDIT_SILVER, AUDIT_SOURCES, SPECS
from tillstream.streaming.flows import bronze_replay, silver_load, silver_stream

CATALOG = Catalog()

FIRST_RUN, SECOND_RUN = "2024-01-05 03:00:00", "2024-01-20 03:00:00"


def _audit_tag(name: str) -> str | None:
    return AUDIT_SOURCES[name.removeprefix("audit_log_")] if name.startswith("audit_log") else None


def _silver_sql(name: str, tagged: str | None) -> str:
    """Two scheduled loads: the snapshot is inserted, then the updates are merged into it.

    The snapshot is outside the look-back of the second run. One grouped pass: the newest message
    of each kind per key.
    """
    spec = SPECS[name]
    key, order = spec.key[0], spec.order_col
    on_update, on_insert = dict(spec.on_update), dict(spec.on_insert)
    held = ", ".join(f"'{c}': {c}" for c in (
        [*spec.columns, "ingestion_time", "hash"]))
    rank = f"row({order}, ingestion_time, hash)"

    def newest(kind: str) -> str:
        return f"arg_max({{{held}}}, {rank}) filter (where transaction_type = '{kind}')"
    guard = "true" if order in on_update else f"u.{order} >= s.{order}"
    out = []
    for c in spec.silver_schema().names:
        ins = f"timestamp '{FIRST_RUN}'" if on_insert.get(c) == "now" else f"s.{c}"
        upd = f"timestamp '{SECOND_RUN}'" if on_update.get(c) == "now" else f"u.{c}"
        out.append(f"case when hit then {upd} else {ins} end as {c}")
    tag = f", '{tagged}' as origin" if tagged else ""
    return f"""{log_sql(name)},
        n as (select {key} as k, {newest('r')} as s, {newest('u')} as u from log group by {key}),
        j as (select s, u, coalesce(u.hash <> s.hash and {guard}, false) as hit
              from n where s is not null),
        merged as (select {', '.join(out)}{tag} from j)
        select {shown_sql(name, _silver_columns(name, tagged))} from merged"""


def _silver_columns(name: str, tagged: str | None) -> list[str]:
    return (AUDIT_SILVER if tagged else SPECS[name]).silver_schema().names


def _add_silver(name: str) -> None:
    tagged = _audit_tag(name)
    spec = AUDIT_SILVER if tagged else SPECS[name]

    def load(spark, sf_dir):
        bronze = bronze_replay(SPECS[name], messages(spark, sf_dir, name))
        if tagged:
            bronze = bronze.withColumn("origin", F.lit(tagged))
        arrived = bronze.filter(F.col("ingestion_time") < F.lit(FIRST_RUN).cast("timestamp"))
        first = silver_load(spec, arrived, merge.empty_silver(spark, spec), FIRST_RUN)
        second = silver_load(spec, bronze, first.df, SECOND_RUN)
        return shown(second.df, name)

    CATALOG.add(f"silver_{name}", load, _silver_sql(name, tagged))


for _name in SPECS:
    _add_silver(_name)


ORDERS = SPECS["orders"]
LOADED, MERGED = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def _hashed(df):
    return df.withColumn("hash", row_hash(df, ORDERS.columns))


def _stored(spark, sf_dir):
    """Orders of the years before 2000, all still pending."""
    o = entity(spark, sf_dir, "orders").filter("order_date < timestamp '2000-01-01'")
    return (_hashed(spread(o).withColumn("payment_status", F.lit("pending")))
            .withColumn("ingestion_time", F.lit(LOADED).cast("timestamp")))


def _incoming(spark, sf_dir):
    """Orders since 1999 as they are now: some stored already, some new."""
    o = entity(spark, sf_dir, "orders").filter("order_date >= timestamp '1999-01-01'")
    return _hashed(spread(o)).withColumn("ingestion_time", F.lit(MERGED).cast("timestamp"))


def _merged(spark, sf_dir):
    return merge.merge_upsert(_stored(spark, sf_dir), _incoming(spark, sf_dir), ORDERS, MERGED)


def _hash_with(status: str) -> str:
    return hash_sql("orders").replace("cast(payment_status as varchar)", status)


_SIDES = f"""{ctes("orders")},
    stored as (select *, {_hash_with("'pending'")} as hash from orders
               where order_date < timestamp '2000-01-01'),
    incoming as (select *, {hash_sql("orders")} as hash from orders
                 where order_date >= timestamp '1999-01-01')"""
_COLS = ", ".join(c for c in ORDERS.columns if c not in ("order_id", "payment_status"))


@CATALOG.query("merge_upsert", f"""{_SIDES}
    select order_id, {_COLS}, payment_status, timestamp '{MERGED}' as ingestion_time, hash
    from incoming i where not exists (
        select 1 from stored s where s.order_id = i.order_id and s.hash = i.hash)
    union all
    select order_id, {_COLS}, 'pending', timestamp '{LOADED}', hash
    from stored s where not exists (
        select 1 from incoming i where s.order_id = i.order_id and s.hash <> i.hash)""")
def merge_upsert(spark, sf_dir):
    return _merged(spark, sf_dir).df


_METRICS = """
    select (select count(*) from incoming i where not exists (
                select 1 from stored s where s.order_id = i.order_id)) as rows_inserted,
           (select count(*) from incoming i join stored s on s.order_id = i.order_id
            where s.hash <> i.hash) as rows_updated,
           cast(0 as bigint) as rows_deleted"""


@CATALOG.query("merge_metrics", _SIDES + _METRICS)
def merge_metrics(spark, sf_dir):
    return _merged(spark, sf_dir).metrics()


@CATALOG.query("merge_idempotent", f"""{ctes("orders")}
    select cast(0 as bigint) as rows_inserted, cast(0 as bigint) as rows_updated,
           cast(0 as bigint) as rows_deleted, count(*) as rows_kept from orders""")
def merge_idempotent(spark, sf_dir):
    """The same batch again: nothing is inserted or updated, every row is kept."""
    once = _merged(spark, sf_dir).df
    again = merge.merge_upsert(once, _incoming(spark, sf_dir), ORDERS, "2024-02-03")
    a = F.col("action")
    return again.actions.agg(
        F.count(F.when(a == "insert", 1)).alias("rows_inserted"),
        F.count(F.when(a == "update", 1)).alias("rows_updated"),
        F.count(F.when(a == "delete", 1)).alias("rows_deleted"),
        F.count(F.when(a == "keep", 1)).alias("rows_kept"))


@CATALOG.query("merge_actions", f"""{_SIDES}
    select coalesce(i.order_id, s.order_id) as order_id,
           case when s.order_id is null then 'insert' when s.hash <> i.hash then 'update'
                else 'keep' end as action
    from incoming i full outer join stored s on s.order_id = i.order_id""")
def merge_actions(spark, sf_dir):
    """By the broadcast of the batch, the way taken for a large target."""
    return merge.merge_upsert(_stored(spark, sf_dir), _incoming(spark, sf_dir), ORDERS, MERGED,
                              way="broadcast").actions


@CATALOG.query("merge_deletes", f"""{log_sql("orders")}
    select order_id, payment_status, total_amount, hash from log
    where transaction_type = 'r' and payment_status <> 'pending'""")
def merge_deletes(spark, sf_dir):
    """Deletes applied: the last message of every pending order is its delete."""
    rows = decode_cdc(messages(spark, sf_dir, "orders"), ORDERS, on_delete="tombstone")
    snapshot = rows.filter("transaction_type = 'r'")
    stored = merge.merge_upsert(merge.empty_silver(spark, ORDERS), snapshot, ORDERS, LOADED).df
    gone = rows.filter("transaction_type = 'd'")
    return merge.merge_upsert(stored, gone, ORDERS, MERGED, on_delete="delete").df.select(
        "order_id", "payment_status", "total_amount", "hash")


_FEED = """
    , pairs as (select s.order_id as s_id, i.order_id as i_id, s.hash as s_hash,
                       i.hash as i_hash, i.payment_status as i_status,
                       i.total_amount as i_total, s.total_amount as s_total
                from stored s full outer join incoming i on s.order_id = i.order_id),
    feed as (select 'insert' as change, i_id as order_id, i_status as payment_status,
                    i_total as total_amount, i_hash as hash from pairs where s_id is null
             union all select 'update_preimage', s_id, 'pending', s_total, s_hash
             from pairs where s_hash <> i_hash
             union all select 'update_postimage', i_id, i_status, i_total, i_hash
             from pairs where s_hash <> i_hash)"""


@CATALOG.query("merge_changes", f"""{_SIDES}{_FEED}
    select change as _change_type, order_id, payment_status, total_amount, hash from feed""")
def merge_changes(spark, sf_dir):
    return _merged(spark, sf_dir).changes().select(
        "_change_type", "order_id", "payment_status", "total_amount", "hash")


@CATALOG.query("change_feed", f"""{_SIDES}{_FEED}
    select change as _change_type, order_id, payment_status, total_amount, hash from feed
    union all
    select 'delete', s_id, 'pending', s_total, s_hash from pairs where i_id is null""")
def change_feed(spark, sf_dir):
    """Two states compared; stored orders absent from the newer state are deletes."""
    return audit.change_feed(_stored(spark, sf_dir), _incoming(spark, sf_dir),
                             "order_id").select(
        "_change_type", "order_id", "payment_status", "total_amount", "hash")


@CATALOG.query("audit_rows", f"""{_SIDES}{_FEED}
    select timestamp '{MERGED}' as log_time, 'loader' as user_name,
           case change when 'insert' then 'INSERT' else 'UPDATE' end as action_type,
           'TABLE' as object_type, 'orders' as object_name, 'merge' as query, order_id
    from feed where change <> 'update_preimage'""")
def audit_rows(spark, sf_dir):
    feed = _merged(spark, sf_dir).changes().select("_change_type", "order_id")
    return audit.audit_rows(feed, "loader", "orders", MERGED, "merge")


_LOGS = [(f"audit_log_{db}", tag) for db, tag in AUDIT_SOURCES.items()]


@CATALOG.query("consolidate_audit", ctes(*[n for n, _ in _LOGS]) + " union all ".join(
    f"select *, '{tag}' as origin from {n}" for n, tag in _LOGS))
def consolidate_audit(spark, sf_dir):
    return audit.consolidate_audit({tag: entity(spark, sf_dir, n) for n, tag in _LOGS})


@CATALOG.query("merge_audit", ctes(*[n for n, _ in _LOGS]) + " union all ".join(
    f"""select log_id, '{tag}' as origin, user_name, action_type, {hash_sql(n)} as hash,
    timestamp '{MERGED}' as ingestion_time from {n}""" for n, tag in _LOGS))
def merge_audit(spark, sf_dir):
    """Three logs with equal ids in one table, keyed by id and source."""
    target = merge.empty_silver(spark, AUDIT_SILVER)
    for name, tag in _LOGS:
        rows = entity(spark, sf_dir, name)
        rows = (rows.withColumn("hash", row_hash(rows, SPECS[name].columns))
                .withColumn("origin", F.lit(tag))
                .withColumn("ingestion_time", F.lit(LOADED).cast("timestamp")))
        target = merge.merge_upsert(target, rows, AUDIT_SILVER, MERGED).df
    return target.select("log_id", "origin", "user_name", "action_type", "hash",
                         "ingestion_time")


@CATALOG.query("stale_rows", f"""{ctes("orders")}
    select order_id, updated_at, updated_at + interval 2 day as stored_at from orders
    where payment_status = 'failed'""")
def stale_rows(spark, sf_dir):
    o = entity(spark, sf_dir, "orders")
    stored = o.withColumn("updated_at", F.when(
        F.col("payment_status") == "failed", F.expr("updated_at + interval 2 day")
    ).otherwise(F.col("updated_at")))
    return merge.stale_rows(o, stored, ORDERS).select("order_id", "updated_at", "stored_at")


@CATALOG.query("merge_guard", f"""{ctes("orders")}
    select order_id, case when payment_status = 'failed' then payment_status else 'completed' end
        as payment_status from orders""")
def merge_guard(spark, sf_dir):
    """Older versions do not overwrite newer rows; equal or newer ones do."""
    o = entity(spark, sf_dir, "orders")
    newer = o.withColumn("updated_at", F.when(
        F.col("payment_status") == "failed", F.expr("updated_at + interval 2 day")
    ).otherwise(F.col("updated_at")))
    stored = _hashed(newer).withColumn("ingestion_time", F.lit(LOADED).cast("timestamp"))
    sent = _hashed(o.withColumn("payment_status", F.lit("completed"))).withColumn(
        "ingestion_time", F.lit(MERGED).cast("timestamp"))
    return merge.merge_upsert(stored, sent, ORDERS, MERGED).df.select("order_id", "payment_status")


@CATALOG.query("merge_months", f"""{_SIDES}
    select order_id, payment_status, hash from incoming i where not exists (
        select 1 from stored s where s.order_id = i.order_id and s.hash = i.hash)
    union all
    select order_id, 'pending', hash from stored s where not exists (
        select 1 from incoming i where s.order_id = i.order_id and s.hash <> i.hash)""")
def merge_months(spark, sf_dir):
    """The same merge against a stored table, rewriting only the months it touches."""
    path = run_dir(spark, "orders-current")
    merge_into(spark, path, _stored(spark, sf_dir), ORDERS, LOADED)
    merge_into(spark, path, _incoming(spark, sf_dir), ORDERS, MERGED)
    return read_current(spark, path, ORDERS).select("order_id", "payment_status", "hash")


@CATALOG.query("silver_stream", f"""{log_sql("purchase_orders")},
    r as (select *, row_number() over (partition by po_id order by updated_at desc,
                                       ingestion_time desc, hash desc) as rn from log)
    select po_id, supplier_id, order_date, status, total_amount, updated_at, hash
    from r where rn = 1""")
def silver_from_stream(spark, sf_dir):
    spec = SPECS["purchase_orders"]
    base = run_dir(spark, "silver-stream")
    batch_append(bronze_replay(spec, messages(spark, sf_dir, "purchase_orders")), f"{base}/bronze")
    silver_stream(spark, spec, f"{base}/bronze", f"{base}/silver", f"{base}/state", now=MERGED)
    return read_current(spark, f"{base}/silver", spec).select(*spec.columns, "hash")


def _accounts(spark, sf_dir):
    a = entity(spark, sf_dir, "accounts")
    return (a.withColumn("hash", row_hash(a, SPECS["accounts"].columns))
            .withColumn("ingestion_time", F.lit(LOADED).cast("timestamp")))


@CATALOG.query("merge_stored_mixed", f"""{ctes("accounts")}
    select account_id, case account_id % 3 when 0 then 'first' when 1 then 'second' else 'third' end
        as account_name from accounts""")
def merge_stored_mixed(spark, sf_dir):
    """A stream, a scheduled merge in between, and a stream started anew: nothing is lost."""
    spec, base = SPECS["accounts"], run_dir(spark, "mixed")
    rows = _accounts(spark, sf_dir)
    for k, (name, way) in enumerate((("first", "stream"), ("second", "merge"), ("third", "stream"))):
        part = rows.filter(F.col("account_id") % 3 == k).withColumn("account_name", F.lit(name))
        if way == "merge":
            merge_into(spark, f"{base}/silver", part, spec, MERGED)
            continue
        for c in ("transaction_type", "connector", "source"):
            part = part.withColumn(c, F.lit("c"))
        part.select(spec.bronze_schema().names).write.parquet(f"{base}/bronze{k}")
        silver_stream(spark, spec, f"{base}/bronze{k}", f"{base}/silver", f"{base}/state{k}", now=MERGED)
    return read_current(spark, f"{base}/silver", spec).select("account_id", "account_name")


@CATALOG.query("merge_empty_batch", f"""{ctes("orders")}
    select order_id, payment_status from orders""")
def merge_empty_batch(spark, sf_dir):
    """A batch without rows leaves a table laid out by month as it is."""
    path, rows = run_dir(spark, "orders-empty"), _hashed(entity(spark, sf_dir, "orders"))
    rows = rows.withColumn("ingestion_time", F.lit(LOADED).cast("timestamp"))
    merge_into(spark, path, rows, ORDERS, LOADED)
    merge_into(spark, path, rows.filter("order_id < 0"), ORDERS, MERGED)
    return read_current(spark, path, ORDERS).select("order_id", "payment_status")


@CATALOG.query("merge_feed_repeated", f"""{ctes("accounts")}
    select 'insert' as _change_type, account_id from accounts""")
def merge_feed_repeated(spark, sf_dir):
    """The same batch twice: its changes are fed once."""
    path, rows = run_dir(spark, "accounts-fed"), _accounts(spark, sf_dir)
    for _ in range(2):
        merge_into(spark, f"{path}/silver", rows, SPECS["accounts"], MERGED, feed=f"{path}/feed")
    return spark.read.parquet(f"{path}/feed").select("_change_type", "account_id")


@CATALOG.query("merge_null_time", f"""{ctes("accounts")}
    select account_id, account_name from accounts""")
def merge_null_time(spark, sf_dir):
    """Rows without a time do not overwrite rows that have one."""
    rows, spec = _accounts(spark, sf_dir), SPECS["accounts"]
    timeless = rows.withColumns({"updated_at": F.lit(None).cast("timestamp"), "account_name": F.lit("?"),
                                 "hash": F.lit("?")})
    return merge.merge_upsert(rows, timeless, spec, MERGED).df.select("account_id", "account_name")
