"""Queries on the physical purge of expired rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity
from tillstream.catalog.registry import Catalog
from tillstream.operators import doomed, retention
from tillstream.session import run_dir
from tillstream.sources.current import purge_table
from tillstream.sources.tables import write_partitioned
from tillstream.specs import SPECS

CATALOG = Catalog()

AS_OF = "1998-06-15 00:00:00"
CUT = f"(timestamp '{AS_OF}' - interval 3 month)"

TABLES = ("order_items", "orders", "products_sku", "products", "categories",
          "delivery_tracking", "shipments", "purchase_order_items", "purchase_orders",
          "suppliers", "financial_transactions", "employees", "warehouses", "inventory")
DATED = {"order_items": "order_date", "orders": "order_date", "delivery_tracking": "shipment_date",
         "shipments": "shipment_date", "purchase_order_items": "order_date", "purchase_orders": "order_date",
         "financial_transactions": "transaction_date"}
KEYS = {n: SPECS[n].key[0] for n in TABLES[:12]}


def _split(purge: retention.Purge, *columns: str) -> DataFrame:
    """Both halves of a purge, told apart by ``fate``."""
    return (purge.keep.select(*columns, F.lit("kept").alias("fate"))
            .unionByName(purge.purged.select(*columns, F.lit("purged").alias("fate"))))


def _fate(cond: str) -> str:
    return f"case when coalesce({cond}, false) then 'purged' else 'kept' end as fate"


def _older(name: str, table: str, key: str, ts: str) -> None:
    def run(spark, sf_dir):
        return _split(retention.purge_older(entity(spark, sf_dir, table), ts, AS_OF), key, ts)
    CATALOG.add(name, run, f"{ctes(table)} select {key}, {ts}, {_fate(f'{ts} < {CUT}')} "
                           f"from {table}")


_older("purge_older_order_items", "order_items", "order_item_id", "order_date")
_older("purge_older_tracking", "delivery_tracking", "tracking_id", "shipment_date")
_older("purge_older_po_items", "purchase_order_items", "po_item_id", "order_date")
_older("purge_older_transactions", "financial_transactions", "transaction_id",
       "transaction_date")
_older("purge_expired_employees", "employees", "employee_id", "deleted_at")


def _childless(name: str, parent: str, child: str, on: str, ts: str, keep_children: str) -> None:
    """Old parents without a child; ``keep_children`` picks the child rows still there."""
    def run(spark, sf_dir):
        kids = entity(spark, sf_dir, child).filter(keep_children)
        return _split(retention.purge_childless(entity(spark, sf_dir, parent), kids, on, ts,
                                                AS_OF), on, ts)
    lonely = f"not exists (select 1 from {child} c where c.{on} = p.{on} and {keep_children})"
    CATALOG.add(name, run, f"{ctes(parent, child)} select p.{on}, p.{ts}, "
                           f"{_fate(f'p.{ts} < {CUT} and {lonely}')} from {parent} p")


_childless("purge_childless_orders", "orders", "order_items", "order_id", "order_date",
           "quantity > 25")
_childless("purge_childless_shipments", "shipments", "delivery_tracking", "shipment_id",
           "shipment_date", "status = 'delivered'")
_childless("purge_childless_pos", "purchase_orders", "purchase_order_items", "po_id",
           "order_date", "quantity > 25")
_childless("purge_expired_categories", "categories", "products", "category_id", "deleted_at",
           "category_id > 4")
_childless("purge_expired_suppliers", "suppliers", "purchase_orders", "supplier_id",
           "deleted_at", "total_amount > 0")
_childless("purge_expired_warehouses", "warehouses", "inventory", "warehouse_id", "deleted_at",
           "stock_quantity > 90")

_GONE_SKUS = f"select sku_id from products_sku where deleted_at < {CUT}"


@CATALOG.query("purge_cascade", f"""{ctes("products_sku", "order_items")}
    select 'sku' as kind, sku_id as id, {_fate(f"deleted_at < {CUT}")} from products_sku
    union all
    select 'item', order_item_id, {_fate(f"sku_id in ({_GONE_SKUS})")} from order_items""")
def purge_cascade(spark, sf_dir):
    skus, items = retention.purge_cascade(
        entity(spark, sf_dir, "products_sku"), entity(spark, sf_dir, "order_items"), "sku_id",
        AS_OF)
    return (_split(skus, "sku_id").select(F.lit("sku").alias("kind"), F.col("sku_id").alias("id"),
                                          "fate")
            .unionByName(_split(items, "order_item_id").select(
                F.lit("item").alias("kind"), F.col("order_item_id").alias("id"), "fate")))


_DOOMED = f"""select s.sku_id from products_sku s join products p on p.product_id = s.product_id
    where p.deleted_at < {CUT} and s.sku_id not in (
        select sku_id from order_items where quantity >= 49)"""


@CATALOG.query("purge_products", f"""{ctes("products", "products_sku", "order_items")},
    doomed as ({_DOOMED}),
    left_skus as (select * from products_sku where sku_id not in (select sku_id from doomed))
    select 'sku' as kind, cast(sku_id as varchar) as id,
           {_fate("sku_id in (select sku_id from doomed)")} from products_sku
    union all
    select 'product', product_id, {_fate(f'''deleted_at < {CUT} and product_id not in (
        select product_id from left_skus)''')} from products""")
def purge_products(spark, sf_dir):
    products, skus = retention.purge_products(
        entity(spark, sf_dir, "products"), entity(spark, sf_dir, "products_sku"),
        entity(spark, sf_dir, "order_items").filter("quantity >= 49"), AS_OF)
    return (_split(skus, "sku_id").select(
        F.lit("sku").alias("kind"), F.col("sku_id").cast("string").alias("id"), "fate")
        .unionByName(_split(products, "product_id").select(
            F.lit("product").alias("kind"), F.col("product_id").alias("id"), "fate")))


@CATALOG.query("purge_stock", f"""{ctes("inventory", "warehouses", "products")}
    select inventory_id, {_fate(f'''
        warehouse_id in (select warehouse_id from warehouses where deleted_at < {CUT})
        or product_id in (select product_id from products where deleted_at < {CUT})''')}
    from inventory""")
def purge_stock(spark, sf_dir):
    tables = {n: entity(spark, sf_dir, n) for n in ("inventory", "warehouses", "products")}
    return _split(retention.purge_stock(tables, AS_OF), "inventory_id")


# Each table as the steps leave it: i1 after step 1, and so on.
_RUN = f"""{ctes(*TABLES[:12])},
    i1 as (select * from order_items where order_date >= {CUT}),
    o2 as (select * from orders o where o.order_date >= {CUT}
           or exists (select 1 from i1 where i1.order_id = o.order_id)),
    s3 as (select * from products_sku where deleted_at is null or deleted_at >= {CUT}),
    i3 as (select * from i1 where sku_id not in ({_GONE_SKUS})),
    d4 as (select s3.sku_id from s3 join products p on p.product_id = s3.product_id
           where p.deleted_at < {CUT} and s3.sku_id not in (select sku_id from i3)),
    s4 as (select * from s3 where sku_id not in (select sku_id from d4)),
    p4 as (select * from products p where p.deleted_at is null or p.deleted_at >= {CUT}
           or exists (select 1 from s4 where s4.product_id = p.product_id)),
    c5 as (select * from categories c where c.deleted_at is null or c.deleted_at >= {CUT}
           or exists (select 1 from p4 where p4.category_id = c.category_id)),
    t6 as (select * from delivery_tracking where shipment_date >= {CUT}),
    h7 as (select * from shipments s where s.shipment_date >= {CUT}
           or exists (select 1 from t6 where t6.shipment_id = s.shipment_id)),
    q8 as (select * from purchase_order_items where order_date >= {CUT}),
    r9 as (select * from purchase_orders p where p.order_date >= {CUT}
           or exists (select 1 from q8 where q8.po_id = p.po_id)),
    u10 as (select * from suppliers s where s.deleted_at is null or s.deleted_at >= {CUT}
            or exists (select 1 from r9 where r9.supplier_id = s.supplier_id)),
    f11 as (select * from financial_transactions where transaction_date >= {CUT}),
    e12 as (select * from employees where deleted_at is null or deleted_at >= {CUT})"""
_STEPS = [(1, "order_items", "order_items", "order_items", "i1"),
          (2, "orders", "orders", "orders", "o2"),
          (3, "products_sku", "products_sku", "products_sku", "s3"),
          (3, "products_sku", "order_items", "i1", "i3"),
          (4, "products", "products", "products", "p4"),
          (4, "products", "products_sku", "s3", "s4"),
          (5, "categories", "categories", "categories", "c5"),
          (6, "delivery_tracking", "delivery_tracking", "delivery_tracking", "t6"),
          (7, "shipments", "shipments", "shipments", "h7"),
          (8, "purchase_order_items", "purchase_order_items", "purchase_order_items", "q8"),
          (9, "purchase_orders", "purchase_orders", "purchase_orders", "r9"),
          (10, "suppliers", "suppliers", "suppliers", "u10"),
          (11, "financial_transactions", "financial_transactions", "financial_transactions",
           "f11"),
          (12, "employees", "employees", "employees", "e12")]


@CATALOG.query("run_retention", _RUN + " union all ".join(
    f"""select {n} as step_no, '{step}' as step, '{table}' as table_name,
        (select count(*) from {before}) - (select count(*) from {after}) as rows_deleted"""
    for n, step, table, before, after in _STEPS))
def run_retention(spark, sf_dir):
    tables = {n: entity(spark, sf_dir, n) for n in TABLES}
    return retention.run_retention(tables, AS_OF).counts


_LEFT = (("order_items", "i3"), ("orders", "o2"), ("products_sku", "s4"), ("products", "p4"),
         ("categories", "c5"), ("delivery_tracking", "t6"), ("shipments", "h7"),
         ("purchase_order_items", "q8"), ("purchase_orders", "r9"), ("suppliers", "u10"),
         ("financial_transactions", "f11"), ("employees", "e12"))


@CATALOG.query("run_retention_remaining", _RUN + " union all ".join(
    f"select '{t}' as table_name, count(*) as rows_left from {v}" for t, v in _LEFT))
def run_retention_remaining(spark, sf_dir):
    """What is left, with every step's result written to a table."""
    tables = {n: entity(spark, sf_dir, n) for n in TABLES[:12]}
    left = retention.run_retention(tables, AS_OF, materialize=True).tables
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows_left"))
        for n, df in left.items()])


@CATALOG.query("run_retention_keys", CATALOG["run_retention"].sql)
def run_retention_keys(spark, sf_dir):
    """The same run with marks and keys, each table read once for its rows."""
    return doomed.run_retention_keys({n: entity(spark, sf_dir, n) for n in TABLES[:12]}, AS_OF).counts


@CATALOG.query("run_retention_stored", _RUN + " union all ".join(
    f"select '{t}' as table_name, count(*) as rows_left, cast(sum(hash_key) as bigint) as key_sum from (select "
    f"cast('0x' || md5(cast({k} as varchar))[1:7] as bigint) as hash_key from {v})"
    for (t, v), k in ((pair, KEYS[pair[0]]) for pair in _LEFT)))
def run_retention_stored(spark, sf_dir):
    """The run over stored tables, the dated ones by month: rows left, and a checksum of their keys."""
    base, paths = run_dir(spark, "retention"), {}
    for name in TABLES[:12]:
        df, ts = entity(spark, sf_dir, name), DATED.get(name)
        paths[name] = f"{base}/{name}"
        if ts:
            write_partitioned(df, paths[name], ts)
        else:
            df.write.parquet(paths[name])
    doomed.purge_stored(spark, paths, AS_OF)
    def left(name):
        key = F.substring(F.md5(F.col(KEYS[name]).cast("string").cast("binary")), 1, 7)
        return spark.read.parquet(paths[name]).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows_left"),
            F.sum(F.conv(key, 16, 10).cast("bigint")).alias("key_sum"))
    return reduce(DataFrame.unionByName, [left(n) for n in paths])


@CATALOG.query("archive_split", f"""{ctes("orders")}
    select strftime(order_date, '%Y%m') as month, count(*) as archived_rows,
           cast(sum(total_amount) as decimal(28,2)) as archived_amount
    from orders where order_date < {CUT} group by 1""")
def archive_split(spark, sf_dir):
    path = run_dir(spark, "archive")
    purge = retention.purge_older(entity(spark, sf_dir, "orders"), "order_date", AS_OF)
    retention.archive(purge.purged, path, "order_date")
    cold = spark.read.parquet(path)
    return cold.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("archived_rows"),
        F.sum("total_amount").cast("decimal(28,2)").alias("archived_amount"))


@CATALOG.query("purge_months", f"""{ctes("orders")}
    select order_id, order_date from orders where order_date >= {CUT}""")
def purge_months(spark, sf_dir):
    """The purge of a stored table: old months go as folders, one month is rewritten."""
    path = run_dir(spark, "purge-months")
    write_partitioned(entity(spark, sf_dir, "orders"), path, "order_date")
    purge_table(spark, path, "order_date", AS_OF)
    return spark.read.parquet(path).select("order_id", "order_date")
