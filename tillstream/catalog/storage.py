"""Queries on storage layout, extracts, personal data and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity, table
from tillstream.catalog.registry import Catalog
from tillstream.functions import pii
from tillstream.functions.sequences import continue_business_id
from tillstream.operators.audit import last_run, run_logged
from tillstream.operators.latest import watermark_value
from tillstream.session import run_dir, settle
from tillstream.sources import tables
from tillstream.sources.extracts import extract_overlap as extract_run
from tillstream.specs import SPECS

CATALOG = Catalog()


@CATALOG.query("month_partition", f"""{ctes("orders")}
    select strftime(order_date, '%Y%m') as month, order_id, total_amount from orders""")
def month_partition(spark, sf_dir):
    path = run_dir(spark, "orders-by-month")
    tables.write_partitioned(entity(spark, sf_dir, "orders"), path, "order_date")
    return spark.read.parquet(path).select(F.col("month").cast("string").alias("month"),
                                           "order_id", "total_amount")


@CATALOG.query("month_overwrite", f"""{ctes("orders")}
    select order_id, case when order_date >= timestamp '1999-01-01'
        and order_date < timestamp '2000-01-01' then 'redone' else payment_status end
        as payment_status from orders""")
def month_overwrite(spark, sf_dir):
    """Writing one year again replaces that year's months and no others."""
    path = run_dir(spark, "orders-by-month")
    o = entity(spark, sf_dir, "orders")
    tables.write_partitioned(o, path, "order_date")
    again = o.filter("order_date >= timestamp '1999-01-01' and order_date < timestamp '2000-01-01'")
    tables.write_partitioned(again.withColumn("payment_status", F.lit("redone")), path,
                             "order_date")
    return spark.read.parquet(path).select("order_id", "payment_status")


@CATALOG.query("hash_buckets", f"""{ctes("order_items")}
    select strftime(order_date, '%Y%m') as month,
           cast(cast('0x' || md5(cast(order_id as varchar))[1:8] as bigint) % 4 as int) as bucket,
           count(*) as row_count, count(distinct order_id) as order_count
    from order_items group by 1, 2""")
def hash_buckets(spark, sf_dir):
    """Order items laid out by month and, below it, by bucket of the order."""
    path = run_dir(spark, "items-by-bucket")
    tables.write_month_buckets(entity(spark, sf_dir, "order_items"), path, "order_date", "order_id")
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month"), "bucket").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_id").alias("order_count"))


@CATALOG.query("truncate_table", f"""{ctes("orders")}
    select count(*) as rows_before, 0 as rows_after from orders""")
def truncate_table(spark, sf_dir):
    """Rows of a stored table before and after it is emptied."""
    path, rows = run_dir(spark, "orders-emptied"), entity(spark, sf_dir, "orders")
    rows.write.parquet(path)
    before = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_before"))
    counted = settle(before, "before")
    tables.truncate(spark, path, rows.schema)
    left = spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).cast("int")).scalar()
    return counted.withColumn("rows_after", left)




@CATALOG.query("align_schema", f"""{ctes("products", "categories")}
    select product_id, name, category_id, created_at, deleted_at, updated_at,
           cast(null as varchar) as connector from products where category_id <= 3
    union all
    select product_id, name, category_id, null, deleted_at, updated_at, 'late' from products
    where category_id > 3""")
def align_schema(spark, sf_dir):
    """Files written before and after a column was added and one was left out."""
    path = run_dir(spark, "evolving")
    p = entity(spark, sf_dir, "products")
    tables.batch_append(p.filter("category_id <= 3"), path)
    tables.batch_append(p.filter("category_id > 3").drop("created_at")
                        .withColumn("connector", F.lit("late")), path)
    schema = SPECS["products"].schema().add("connector", "string")
    return tables.read_evolving(spark, path, schema)


@CATALOG.query("profile_table", f"""{ctes("order_items")}
    select count(*) as row_count, min(updated_at) as min_value, max(updated_at) as max_value
    from order_items""")
def profile_table(spark, sf_dir):
    return tables.profile_table(entity(spark, sf_dir, "order_items"), "updated_at")


@CATALOG.query("count_rows", "select count(*) as row_count from lineitem")
def count_rows(spark, sf_dir):
    return tables.count_rows(table(spark, sf_dir, "lineitem"))


@CATALOG.query("batch_append", "select count(*) as row_count, count(distinct event_id) as ids "
                               "from (select * from events union all select * from events)")
def batch_append(spark, sf_dir):
    path = run_dir(spark, "appended")
    for _ in range(2):
        tables.batch_append(table(spark, sf_dir, "events"), path)
    return tables.read_table(spark, path).agg(F.count(F.lit(1)).alias("row_count"),
                                              F.count_distinct("event_id").alias("ids"))


@CATALOG.query("extract_incremental", f"""{ctes("orders")}
    select order_id, updated_at from orders where updated_at > timestamp '2000-06-30 00:00:00'""")
def extract_incremental(spark, sf_dir):
    new, _ = tables.extract_incremental(entity(spark, sf_dir, "orders"), "updated_at",
                                        "2000-06-30")
    return new.select("order_id", "updated_at")


@CATALOG.query("extract_watermark", f"""{ctes("orders")}
    select max(updated_at) as high_watermark from orders
    where updated_at > timestamp '2000-06-30 00:00:00'""")
def extract_watermark(spark, sf_dir):
    return tables.extract_incremental(entity(spark, sf_dir, "orders"), "updated_at",
                                      "2000-06-30")[1]


# Rows as the source shows them at three times: a fifth of the rows is committed ten days late.
_LATE = "order_id % 5 = 0"
_SHOWN = [f"(updated_at <= timestamp '{day}' - interval 10 day or (not {_LATE} and updated_at <= timestamp '{day}'))"
          for day in ("1995-06-30", "1998-06-30", "2100-01-01")]


@CATALOG.query("extract_overlap", f"""{ctes("orders")},
    times as (select *, case when {_SHOWN[0]} then 0 when {_SHOWN[1]} then 1 else 2 end as run from orders),
    marks as (select run, max(updated_at) as newest from times group by run)
    select t.order_id, t.updated_at, t.run from times t
    where t.run = 0 or t.updated_at > (select max(newest) from marks m where m.run < t.run) - interval 20 day""")
def extract_overlap(spark, sf_dir):
    """Three runs, the second one repeated; rows that appear ten days late are within twenty days' overlap."""
    folder, orders = run_dir(spark, "extracts"), entity(spark, sf_dir, "orders")
    made = []
    for run in (0, 1, 1, 2):
        made.append(extract_run(orders.filter(_SHOWN[run]), "updated_at", folder, run, "20 days"))
    return spark.read.parquet(f"{folder}/rows").select("order_id", "updated_at", "run")


@CATALOG.query("bucketed_join", f"""{ctes("orders", "order_items")}
    select o.order_id, o.payment_status, count(*) as item_count,
           cast(sum(i.quantity * i.unit_price) as decimal(28,2)) as amount
    from orders o join order_items i on i.order_id = o.order_id group by 1, 2""")
def bucketed_join(spark, sf_dir):
    """Orders and items stored in equal buckets of the order: joined and summed without a shuffle."""
    base = run_dir(spark, "bucketed")
    names = {n: f"{n}_{base[-12:]}" for n in ("orders", "order_items")}
    for name, stored in names.items():
        tables.save_bucketed(entity(spark, sf_dir, name), stored, "order_id", 16, f"{base}/{name}")
    joined = tables.bucketed_join(spark, names["orders"], names["order_items"], "order_id")
    return joined.groupBy("order_id", "payment_status").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(28,2)").alias("amount"))


@CATALOG.query("sequence_continued", """
    select c_custkey, case when c_mktsegment in ('BUILDING', 'MACHINERY') then 0 else 1 end as run,
           concat('CUST_', lpad(cast(41 + row_number() over (order by case when c_mktsegment in
               ('BUILDING', 'MACHINERY') then 0 else 1 end, c_custkey) as varchar), 6, '0')) as customer_id
    from customer""")
def sequence_continued(spark, sf_dir):
    """Two batches of customers numbered in runs of their own; the first run is repeated after the second."""
    folder = run_dir(spark, "sequence")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 0).otherwise(1).alias("run"))
    def numbered(run):
        return continue_business_id(c.filter(F.col("run") == run), "customer_id", "CUST_", 6, ["c_custkey"], folder,
                                    f"run {run}", 42)
    _, second, first = numbered(0), numbered(1), numbered(0)
    return first.unionByName(second)


@CATALOG.query("high_watermark", "select max(l_shipdate) as high_watermark from lineitem")
def high_watermark(spark, sf_dir):
    return watermark_value(table(spark, sf_dir, "lineitem"), "l_shipdate")


SECRET, NEXT_SECRET = "first passphrase", "second passphrase"


def _contacts(spark, sf_dir):
    return entity(spark, sf_dir, "customers", typed=False).select(
        "customer_id", "email", "phone", "address")


@CATALOG.query("pii_round_trip", f"""{ctes("customers")}
    select customer_id, email, phone, true as hidden from customers""")
def pii_round_trip(spark, sf_dir):
    plain = _contacts(spark, sf_dir)
    locked = pii.encrypt(plain.withColumn("was", F.col("email")), ["email", "phone"], SECRET)
    hidden = locked.withColumn("hidden", F.col("email") != F.col("was").cast("binary"))
    return pii.decrypt(hidden, ["email", "phone"], SECRET).select("customer_id", "email", "phone",
                                                                  "hidden")


@CATALOG.query("pii_rotate", f"""{ctes("customers")}
    select customer_id, case when address <> 'Nation 3' then email end as email from customers""")
def pii_rotate(spark, sf_dir):
    """Rows under another key cannot be rotated and stay closed to the new one."""
    rows = _contacts(spark, sf_dir)
    good = pii.encrypt(rows.filter("address <> 'Nation 3'"), ["email"], SECRET)
    bad = pii.encrypt(rows.filter("address = 'Nation 3'"), ["email"], "something else")
    rotated, _ = pii.rotate_key(good.unionByName(bad), ["email"], SECRET, NEXT_SECRET)
    return pii.decrypt(rotated, ["email"], NEXT_SECRET).select("customer_id", "email")


@CATALOG.query("pii_rotate_failed", f"""{ctes("customers")}
    select customer_id from customers where address = 'Nation 3'""")
def pii_rotate_failed(spark, sf_dir):
    rows = _contacts(spark, sf_dir)
    good = pii.encrypt(rows.filter("address <> 'Nation 3'"), ["email"], SECRET)
    bad = pii.encrypt(rows.filter("address = 'Nation 3'"), ["email"], "something else")
    return pii.rotate_key(good.unionByName(bad), ["email"], SECRET, NEXT_SECRET)[1].select(
        "customer_id")


POLICY = {
    "email": pii.Mask("email", frozenset({"steward"})),
    "phone": pii.Mask("last4", frozenset({"steward", "support"})),
    "address": pii.Mask("hash", frozenset({"steward"})),
}


@CATALOG.query("mask", f"""{ctes("customers")}
    select customer_id, regexp_replace(email, '^(.)[^@]*(@.*)$', '\\1***\\2') as email,
           repeat('*', cast(length(phone) - 4 as int)) || right(phone, 4) as phone,
           sha256(address) as address from customers""")
def mask(spark, sf_dir):
    return pii.mask(_contacts(spark, sf_dir), POLICY, "analyst")


@CATALOG.query("mask_support", f"""{ctes("customers")}
    select customer_id, regexp_replace(email, '^(.)[^@]*(@.*)$', '\\1***\\2') as email, phone,
           sha256(address) as address from customers""")
def mask_support(spark, sf_dir):
    return pii.mask(_contacts(spark, sf_dir), POLICY, "support")


_GRANTS = """select concat('analyst_', cast(n_regionkey as string)) as user_name,
    concat('Nation ', cast(n_nationkey as string)) as address from {nation}"""


@CATALOG.query("row_scope", f"""{ctes("customers")}
    select customer_id, address from customers where address in (
        select address from ({_GRANTS.format(nation="nation")}) where user_name = 'analyst_2')""")
def row_scope(spark, sf_dir):
    grants = spark.sql(_GRANTS, nation=table(spark, sf_dir, "nation"))
    return pii.row_scope(_contacts(spark, sf_dir), grants, "analyst_2", "address").select(
        "customer_id", "address")


@CATALOG.query("tokenize", f"""{ctes("customers")}
    select customer_id, sha256(concat('pepper', email)) as email from customers""")
def tokenize(spark, sf_dir):
    return pii.tokenize(_contacts(spark, sf_dir), ["email"], "pepper").select("customer_id",
                                                                              "email")


@CATALOG.query("run_log", """
    select 'nightly' as job, 'orders' as task, 'success' as status, count(*) as rows_in,
           count(*) filter (where o_orderstatus = 'F') as rows_out from orders""")
def run_log(spark, sf_dir):
    base = run_dir(spark, "run-log")
    run_logged(spark, "nightly", "orders", table(spark, sf_dir, "orders"),
               lambda df: df.filter("o_orderstatus = 'F'"),
               lambda df: df.write.parquet(f"{base}/out"), f"{base}/log")
    return last_run(spark.read.parquet(f"{base}/log")).select("job", "task", "status", "rows_in",
                                                              "rows_out")
