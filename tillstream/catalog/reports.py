"""Queries on report views, joins and summary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity
from tillstream.catalog.registry import Catalog
from tillstream.operators import audit, joins, latest
from tillstream.plans import gold, incremental, reports
from tillstream.session import run_dir, settle
from tillstream.specs import SPECS

CATALOG = Catalog()

AS_OF = "2000-01-01 00:00:00"


def _load(spark, sf_dir, *names):
    return [entity(spark, sf_dir, n) for n in names]


_SALES = f"""{ctes("order_items", "orders", "customers", "products_sku", "products",
                   "payment_types")},
    sizes as (select order_id, count(*) as item_count from order_items group by order_id),
    items as (select order_id, quantity, unit_price as price, sku, order_items.product_id as sold
              from order_items join products_sku using (sku_id))
    select order_id, order_date, customer_id, customers.name as customer_name, total_amount,
           shipping_address, payment_status, payment_types.name as payment_types, items.sku,
           products.name as product_name, items.price, items.quantity, item_count
    from items join sizes using (order_id) join orders using (order_id)
    join products on products.product_id = items.sold
    join customers using (customer_id) join payment_types using (payment_type_id)
    where customers.created_at is not null"""
_SALES_INPUTS = ("orders", "customers", "order_items", "products_sku", "products",
                 "payment_types")


@CATALOG.query("sales_report_view", _SALES)
def sales_report_view(spark, sf_dir):
    return reports.sales_report_view(*_load(spark, sf_dir, *_SALES_INPUTS))


@CATALOG.query("sales_report_ordered", _SALES + " order by order_date desc, order_id, items.sku")
def sales_report_ordered(spark, sf_dir):
    return reports.sales_report_view(*_load(spark, sf_dir, *_SALES_INPUTS), ordered=True)


@CATALOG.query("sales_report_materialized", _SALES)
def sales_report_materialized(spark, sf_dir):
    view = reports.sales_report_view(*_load(spark, sf_dir, *_SALES_INPUTS))
    return gold.materialize(view, run_dir(spark, "sales-report"))


@CATALOG.query("product_view", f"""{ctes("products_sku", "products", "categories")},
    named as (select product_id, products.name as product_name, category_id,
                     categories.name as category_name
              from categories join products using (category_id)
              where categories.deleted_at is null and products.deleted_at is null)
    select sku_id, sku, product_id, product_name, category_id, category_name, color, size, price,
           created_at
    from named join products_sku using (product_id)""")
def product_view(spark, sf_dir):
    return reports.product_view(*_load(spark, sf_dir, "products_sku", "products", "categories"))


@CATALOG.query("shipping_report_view", f"""{ctes("delivery_tracking", "shipments", "warehouses")},
    open as (select warehouse_id, name as warehouse_name, location from warehouses
             where deleted_at is null)
    select shipment_id, order_id, warehouse_id, warehouse_name, open.location, shipments.shipment_date,
           checkpoint_time, delivery_tracking.location as checkpoint_location, shipments.status
    from open join shipments using (warehouse_id) left join delivery_tracking using (shipment_id)""")
def shipping_report_view(spark, sf_dir):
    return reports.shipping_report_view(
        *_load(spark, sf_dir, "shipments", "warehouses", "delivery_tracking"))


@CATALOG.query("inventory_report_view", f"""{ctes("inventory", "warehouses")}
    select i.sku_id, i.product_id, i.stock_quantity, i.last_updated, i.warehouse_id,
           w.name as warehouse_name, w.location
    from inventory i join warehouses w on i.warehouse_id = w.warehouse_id
    where w.deleted_at is null""")
def inventory_report_view(spark, sf_dir):
    return reports.inventory_report_view(*_load(spark, sf_dir, "inventory", "warehouses"))


@CATALOG.query("skus_by_price", f"""{ctes("products_sku")}
    select sku_id, sku, product_id, color, size, price, created_at from products_sku
    where deleted_at is null and price between 905 and 950.55 order by price, sku_id""")
def skus_by_price(spark, sf_dir):
    return reports.skus_by_price(entity(spark, sf_dir, "products_sku"), 905, 950.55)


@CATALOG.query("lookup_by_key", f"""{ctes("customers")}
    select customer_id, name, address from customers where customer_id = 'CUST_000042'""")
def lookup_by_key(spark, sf_dir):
    return joins.lookup(entity(spark, sf_dir, "customers"), "customer_id",
                        "CUST_000042").select("customer_id", "name", "address")


@CATALOG.query("active_rows", f"""{ctes("products")}
    select product_id, name from products where deleted_at is null""")
def active_rows(spark, sf_dir):
    return latest.active(entity(spark, sf_dir, "products")).select("product_id", "name")


@CATALOG.query("orders_without_items", f"""{ctes("orders", "order_items")}
    select order_id, customer_id, order_date from orders o where not exists (
        select 1 from order_items i where i.order_id = o.order_id)""")
def orders_without_items(spark, sf_dir):
    o, i = _load(spark, sf_dir, "orders", "order_items")
    return joins.without_children(o, i, "order_id").select("order_id", "customer_id",
                                                           "order_date")


@CATALOG.query("children_of_expired", f"""{ctes("order_items", "products_sku")}
    select order_item_id, order_id, sku_id, unit_price from order_items
    where sku_id in (select sku_id from products_sku where deleted_at is not null)""")
def children_of_expired(spark, sf_dir):
    i, s = _load(spark, sf_dir, "order_items", "products_sku")
    return joins.children_of(i, s.filter("deleted_at is not null"), "sku_id").select(
        "order_item_id", "order_id", "sku_id", "unit_price")


@CATALOG.query("children_of_expired_salted", f"""{ctes("order_items", "products_sku")}
    select order_item_id, order_id, sku_id, unit_price from order_items
    where sku_id in (select sku_id from products_sku where deleted_at is not null)""")
def children_of_expired_salted(spark, sf_dir):
    """The same by the salted join, the way taken where the parents are too large to send."""
    i, s = _load(spark, sf_dir, "order_items", "products_sku")
    gone = s.filter("deleted_at is not null").select("sku_id").distinct()
    return joins.salted_join(i, gone, ["sku_id"], "left_semi", ["order_item_id"]).select(
        "order_item_id", "order_id", "sku_id", "unit_price")


@CATALOG.query("hot_keys", f"""{ctes("orders")}
    select payment_type_id from orders group by payment_type_id
    having count(*) > 0.2 * (select count(*) from orders)""")
def hot_keys(spark, sf_dir):
    return joins.hot_keys(entity(spark, sf_dir, "orders"), ["payment_type_id"], 0.2).select(
        "payment_type_id")


@CATALOG.query("fill_from_parent", f"""{ctes("orders", "customers")}
    select o.order_id, o.customer_id,
           case when o.payment_status = 'failed' then c.address else o.shipping_address end
               as shipping_address
    from orders o left join customers c on o.customer_id = c.customer_id""")
def fill_from_parent(spark, sf_dir):
    """Orders without a shipping address (here: the failed ones) get the customer's."""
    o, c = _load(spark, sf_dir, "orders", "customers")
    o = o.withColumn("shipping_address",
                     F.when(F.col("payment_status") != "failed", F.col("shipping_address")))
    return joins.fill_from_parent(o, c, "customer_id", {"shipping_address": "address"},
                                  ["order_id"]).select("order_id", "customer_id",
                                                       "shipping_address")


@CATALOG.query("latest_child", f"""{ctes("shipments", "delivery_tracking")},
    d as (select *, row_number() over (partition by shipment_id
              order by checkpoint_time desc, tracking_id desc, status desc, location desc) as rn
          from delivery_tracking)
    select s.shipment_id, coalesce(d.status, s.status) as status
    from shipments s left join d on d.shipment_id = s.shipment_id and d.rn = 1""")
def latest_child(spark, sf_dir):
    s, t = _load(spark, sf_dir, "shipments", "delivery_tracking")
    return latest.latest_child(
        s, t, "shipment_id", ["checkpoint_time", "tracking_id", "status", "location"],
        {"status": "status"}).select("shipment_id", "status")


@CATALOG.query("fk_orphans", f"""{ctes("order_items", "products")}
    select order_item_id, product_id, order_id from order_items i where not exists (
        select 1 from products p where p.product_id = i.product_id and p.deleted_at is null)""")
def fk_orphans(spark, sf_dir):
    i, p = _load(spark, sf_dir, "order_items", "products")
    return joins.orphans(i, latest.active(p), "product_id").select(
        "order_item_id", "product_id", "order_id")


def _references():
    for spec in SPECS.values():
        for ref in spec.references:
            yield spec.name, ref


_CHILDREN = dict.fromkeys(n for c, r in _references() for n in (c, r.parent))


@CATALOG.query("reference_report", ctes(*_CHILDREN) + " union all ".join(
    f"""select '{c}' as child, '{r.parent}' as parent, '{",".join(r.cols)}' as columns,
               {str(r.external).lower()} as external, count(*) as orphan_rows
        from {c} c where {" and ".join(f"c.{x} is not null" for x in r.cols)} and not exists (
            select 1 from {r.parent} p
            where {" and ".join(f"p.{b} = c.{a}" for a, b in zip(r.cols, r.parent_cols))})"""
    for c, r in _references()))
def reference_report(spark, sf_dir):
    """Orphan rows of every declared reference, those across source systems included."""
    out = None
    for child, ref in _references():
        c, p = _load(spark, sf_dir, child, ref.parent)
        row = joins.orphans(c, p, ref.cols, ref.parent_cols).agg(
            F.lit(child).alias("child"), F.lit(ref.parent).alias("parent"),
            F.lit(",".join(ref.cols)).alias("columns"), F.lit(ref.external).alias("external"),
            F.count(F.lit(1)).alias("orphan_rows"))
        out = row if out is None else out.unionByName(row)
    return out


_LABELS = [(1, "at once"), (2, "soon"), (3, "normal"), (5, "any time")]


@CATALOG.query("join_values", f"""{ctes("orders")}
    select o.order_id, o.payment_type_id, v.label from orders o
    join (values {", ".join(f"({a}, '{b}')" for a, b in _LABELS)}) as v(payment_type_id, label)
    on o.payment_type_id = v.payment_type_id""")
def join_values(spark, sf_dir):
    o = entity(spark, sf_dir, "orders").select("order_id", "payment_type_id")
    return joins.join_values(o, _LABELS, "payment_type_id int, label string", "payment_type_id")


@CATALOG.query("order_totals", f"""{ctes("order_items")}
    select order_id, cast(sum(quantity * unit_price) as decimal(28,2)) as items_total
    from order_items group by order_id""")
def order_totals(spark, sf_dir):
    return gold.order_totals(entity(spark, sf_dir, "order_items"))


@CATALOG.query("po_totals", f"""{ctes("purchase_order_items")}
    select po_id, cast(sum(quantity * unit_price) as decimal(28,2)) as items_total
    from purchase_order_items group by po_id""")
def po_totals(spark, sf_dir):
    return gold.po_totals(entity(spark, sf_dir, "purchase_order_items"))


@CATALOG.query("item_counts", f"""{ctes("order_items")}
    select order_id, count(*) as item_count from order_items group by order_id""")
def item_counts(spark, sf_dir):
    return gold.item_counts(entity(spark, sf_dir, "order_items"))


@CATALOG.query("revenue_by_payment_type", f"""{ctes("orders", "payment_types")}
    select strftime(order_date, '%Y%m') as month, pt.name as payment_type,
           cast(sum(total_amount) as decimal(28,2)) as revenue, count(*) as order_count
    from orders o join payment_types pt on o.payment_type_id = pt.payment_type_id
    where payment_status = 'completed' group by 1, 2""")
def revenue_by_payment_type(spark, sf_dir):
    return gold.revenue_by_payment_type(*_load(spark, sf_dir, "orders", "payment_types"))


@CATALOG.query("revenue_by_category", f"""{ctes("order_items", "products", "categories")}
    select strftime(order_date, '%Y%m') as month, c.name as category,
           cast(sum(quantity * unit_price) as decimal(28,2)) as revenue,
           cast(sum(quantity) as bigint) as units
    from order_items i join products p on i.product_id = p.product_id
    join categories c on p.category_id = c.category_id group by 1, 2""")
def revenue_by_category(spark, sf_dir):
    return gold.revenue_by_category(
        *_load(spark, sf_dir, "order_items", "products", "categories"))


@CATALOG.query("customer_features", f"""{ctes("orders")}
    select customer_id, cast(date_diff('day', max(order_date), timestamp '{AS_OF}') as int)
               as recency_days, count(*) as frequency,
           cast(coalesce(sum(total_amount) filter (where payment_status = 'completed'), 0)
                as decimal(28,2)) as monetary,
           min(order_date) as first_order_date
    from orders where order_date <= timestamp '{AS_OF}' group by customer_id""")
def customer_features(spark, sf_dir):
    return gold.customer_features(entity(spark, sf_dir, "orders"), AS_OF)


@CATALOG.query("delivery_leadtime", f"""{ctes("orders", "shipments", "delivery_tracking")},
    d as (select shipment_id, min(checkpoint_time) as delivered_at from delivery_tracking
          where status = 'delivered' group by shipment_id)
    select s.shipment_id, s.order_id,
           cast(floor((epoch(s.shipment_date) - epoch(o.order_date)) / 3600) as bigint)
               as hours_to_ship,
           cast(floor((epoch(d.delivered_at) - epoch(s.shipment_date)) / 3600) as bigint)
               as hours_to_deliver
    from shipments s join orders o on o.order_id = s.order_id
    left join d on d.shipment_id = s.shipment_id""")
def delivery_leadtime(spark, sf_dir):
    return gold.delivery_leadtime(
        *_load(spark, sf_dir, "orders", "shipments", "delivery_tracking"))


@CATALOG.query("stock_position", f"""{ctes("inventory")}
    select product_id, cast(sum(stock_quantity) as bigint) as stock_quantity,
           count(*) as places, max(last_updated) as last_updated
    from inventory group by product_id""")
def stock_position(spark, sf_dir):
    return gold.stock_position(entity(spark, sf_dir, "inventory"))


@CATALOG.query("stock_by_warehouse", f"""{ctes("inventory")}
    select warehouse_id, cast(sum(stock_quantity) as bigint) as stock_quantity,
           count(*) as sku_count from inventory group by warehouse_id""")
def stock_by_warehouse(spark, sf_dir):
    return gold.stock_by_warehouse(entity(spark, sf_dir, "inventory"))


@CATALOG.query("account_balance", f"""{ctes("financial_transactions", "accounts")}
    select t.account_id, a.account_name,
           cast(sum(case when type = 'debit' then amount else -amount end) as decimal(28,2))
               as balance,
           count(*) as transaction_count
    from financial_transactions t join accounts a on a.account_id = t.account_id
    where status <> 'cancelled' group by t.account_id, a.account_name""")
def account_balance(spark, sf_dir):
    return gold.account_balance(*_load(spark, sf_dir, "financial_transactions", "accounts"))


def _versions(spark, sf_dir, name, key, old, new):
    """The feed between two states of an entity, each given as a filter and changed columns."""
    rows = entity(spark, sf_dir, name)

    def state(kept, changes):
        return rows.filter(kept).withColumns({c: F.expr(e).cast(rows.schema[c].dataType) for c, e in changes.items()})
    before, after = state(*old), state(*new)
    return before, after, audit.change_feed(audit.hashed(before, key), audit.hashed(after, key), key)


def _kept_current(summary, before, feed):
    return summary.update(settle(summary.full(before), "sums"), feed)


# Orders before: the first five sixths, none of the fifth payment type completed; after: the last five sixths.
_OLD_ORDERS = ("order_id % 6 <> 5", {"payment_status": "if(payment_type_id = 5, 'pending', payment_status)"})
_NEW_ORDERS = ("order_id % 6 <> 0", {"total_amount": "if(order_id % 4 = 0, total_amount + 1, total_amount)"})


@CATALOG.query("revenue_incremental", f"""{ctes("orders", "payment_types")},
    o as (select *, total_amount + case when order_id % 4 = 0 then 1 else 0 end as amount from orders
          where order_id % 6 <> 0)
    select strftime(order_date, '%Y%m') as month, pt.name as payment_type,
           cast(sum(amount) as decimal(28,2)) as revenue, count(*) as order_count
    from o join payment_types pt on o.payment_type_id = pt.payment_type_id
    where payment_status = 'completed' group by 1, 2""")
def revenue_incremental(spark, sf_dir):
    """Revenue of the newer state of the orders: sums of the older one, and the feed between them."""
    before, _, feed = _versions(spark, sf_dir, "orders", "order_id", _OLD_ORDERS, _NEW_ORDERS)
    stored = _kept_current(incremental.payment_revenue(), before, feed)
    return incremental.revenue_by_payment_type(stored, entity(spark, sf_dir, "payment_types"))


@CATALOG.query("revenue_category_incremental", f"""{ctes("inventory", "products", "categories")},
    i as (select inventory_id, product_id, last_updated, stock_quantity + inventory_id % 3 as quantity, 2.50 as unit_price
          from inventory where inventory_id % 7 <> 0)
    select strftime(last_updated, '%Y%m') as month, c.name as category,
           cast(sum(quantity * unit_price) as decimal(28,2)) as revenue, cast(sum(quantity) as bigint) as units
    from i join products p on i.product_id = p.product_id
    join categories c on p.category_id = c.category_id group by 1, 2""")
def revenue_category_incremental(spark, sf_dir):
    """Items whose quantity, month and presence change: stock rows, read as items of one price."""
    rows = settle(entity(spark, sf_dir, "inventory").select(
        "inventory_id", "product_id", F.col("last_updated").alias("order_date"), F.col("stock_quantity").alias("quantity"),
        F.lit("2.50").cast("decimal(10,2)").alias("unit_price")), "rows")
    before = rows.filter("inventory_id % 5 <> 0").withColumn("order_date", F.expr(
        "if(inventory_id % 2 = 0, order_date - interval 40 days, order_date)"))
    after = rows.filter("inventory_id % 7 <> 0").withColumn(
        "quantity", (F.col("quantity") + F.col("inventory_id") % 3).cast("int"))
    feed = audit.change_feed(*[audit.hashed(df, "inventory_id") for df in (before, after)], "inventory_id")
    stored = _kept_current(incremental.product_revenue(), before, feed)
    return incremental.revenue_by_category(stored, *_load(spark, sf_dir, "products", "categories"))


@CATALOG.query("balance_incremental", f"""{ctes("financial_transactions", "accounts")},
    t as (select *, case when transaction_id % 3 = 0 then 'cancelled' else status end as now_status
          from financial_transactions where transaction_id % 8 <> 1)
    select t.account_id, a.account_name,
           cast(sum(case when type = 'debit' then amount else -amount end) as decimal(28,2)) as balance,
           count(*) as transaction_count
    from t join accounts a on a.account_id = t.account_id
    where now_status <> 'cancelled' group by t.account_id, a.account_name""")
def balance_incremental(spark, sf_dir):
    """Balances after some transactions were cancelled, some deleted, and some moved to another account."""
    before, _, feed = _versions(
        spark, sf_dir, "financial_transactions", "transaction_id",
        ("transaction_id % 9 <> 2", {"account_id": "if(transaction_id % 5 = 0, 1, account_id)"}),
        ("transaction_id % 8 <> 1", {"status": "if(transaction_id % 3 = 0, 'cancelled', status)"}))
    stored = _kept_current(incremental.balances(), before, feed)
    return incremental.account_balance(stored, entity(spark, sf_dir, "accounts"))
