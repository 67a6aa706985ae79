"""Queries on batch mutations: patches, soft deletes, validated inserts, business ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity, table
from tillstream.catalog.registry import Catalog
from tillstream.functions.ids import assign_business_id, assign_sequence
from tillstream.functions.pii import decrypt, encrypt
from tillstream.operators import entity_ops, mutate, quality
from tillstream.specs import LEDGER_SIDES, ORDER_STATES, SHIPMENT_STATES, TRACKING_STATES

CATALOG = Catalog()

NOW = "2002-01-01 00:00:00"

_PATCH = """select po_id, case when total_amount > 200000 then 'cancelled' end as status,
                   case when status = 'draft' then cast(0 as decimal(12,2)) end as total_amount
            from {purchase_orders} where order_date >= timestamp '1998-01-01'
            union all
            select -po_id, 'draft', null from {purchase_orders}
            where order_date >= timestamp '2001-07-01'"""


def _patched(spark, sf_dir, mode):
    po = entity(spark, sf_dir, "purchase_orders")
    patch = spark.sql(_PATCH, purchase_orders=po)
    return mutate.apply_patch(po, patch, "po_id", ["status", "total_amount"], mode, NOW)


def _patch_sql(new: str) -> str:
    return f"""{ctes("purchase_orders")}, patch as ({
        _PATCH.format(purchase_orders="purchase_orders")})
        select t.po_id, t.supplier_id, {new.format(c="status")} as status,
               {new.format(c="total_amount")} as total_amount,
               case when p.po_id is not null then timestamp '{NOW}' else t.updated_at end
                   as updated_at
        from purchase_orders t left join patch p on p.po_id = t.po_id"""


_PATCHED = ("po_id", "supplier_id", "status", "total_amount", "updated_at")


@CATALOG.query("patch_coalesce", _patch_sql("coalesce(p.{c}, t.{c})"))
def patch_coalesce(spark, sf_dir):
    return _patched(spark, sf_dir, "coalesce").df.select(*_PATCHED)


@CATALOG.query("patch_overwrite", _patch_sql(
    "case when p.po_id is not null then p.{c} else t.{c} end"))
def patch_overwrite(spark, sf_dir):
    return _patched(spark, sf_dir, "overwrite").df.select(*_PATCHED)


@CATALOG.query("patch_not_found", f"""{ctes("purchase_orders")}, patch as ({
    _PATCH.format(purchase_orders="purchase_orders")})
    select po_id, status, 'not found' as reason from patch
    where po_id not in (select po_id from purchase_orders)""")
def patch_not_found(spark, sf_dir):
    return _patched(spark, sf_dir, "coalesce").rejected.select("po_id", "status", "reason")


@CATALOG.query("patch_live_only", f"""{ctes("suppliers")}
    select supplier_id, case when deleted_at is null then concat('New ', name) else name end
        as name from suppliers""")
def patch_live_only(spark, sf_dir):
    """Soft-deleted rows are not patched."""
    s = entity(spark, sf_dir, "suppliers")
    patch = s.select("supplier_id", F.concat(F.lit("New "), "name").alias("name"))
    return mutate.apply_patch(s, patch, "supplier_id", ["name"], "overwrite",
                              live="deleted_at").df.select("supplier_id", "name")


_STOCK = """select sku_id, cast(min(stock_quantity) - 10 as int) as stock_quantity
            from {inventory} where last_updated >= timestamp '2000-01-01' group by sku_id
            union all select -1, 5"""


def _stock(spark, sf_dir):
    inv = entity(spark, sf_dir, "inventory")
    return mutate.set_stock_by_sku(inv, spark.sql(_STOCK, inventory=inv), NOW)


_STOCK_CTE = f"""{ctes("inventory")}, req as ({_STOCK.format(inventory="inventory")})"""


@CATALOG.query("set_stock_by_sku", f"""{_STOCK_CTE}
    select i.inventory_id, i.sku_id, coalesce(r.stock_quantity, i.stock_quantity)
               as stock_quantity,
           case when r.sku_id is not null then timestamp '{NOW}' else i.last_updated end
               as last_updated
    from inventory i left join req r on r.sku_id = i.sku_id and r.stock_quantity >= 0""")
def set_stock_by_sku(spark, sf_dir):
    return _stock(spark, sf_dir).df.select("inventory_id", "sku_id", "stock_quantity",
                                           "last_updated")


@CATALOG.query("set_stock_rejected", f"""{_STOCK_CTE}
    select sku_id, stock_quantity, case when stock_quantity < 0 then 'stock cannot be negative'
        else 'not found' end as reason from req
    where stock_quantity < 0 or sku_id not in (select sku_id from inventory)""")
def set_stock_rejected(spark, sf_dir):
    return _stock(spark, sf_dir).rejected.select("sku_id", "stock_quantity", "reason")


@CATALOG.query("soft_delete", f"""{ctes("warehouses")}
    select warehouse_id, case when deleted_at is null and location < 'Nation 15'
               then timestamp '{NOW}' else deleted_at end as deleted_at,
           case when deleted_at is null and location < 'Nation 15'
               then timestamp '{NOW}' else updated_at end as updated_at
    from warehouses""")
def soft_delete(spark, sf_dir):
    w = entity(spark, sf_dir, "warehouses")
    keys = w.filter("location < 'Nation 15'").select("warehouse_id")
    return mutate.soft_delete(w, keys, "warehouse_id", NOW).df.select(
        "warehouse_id", "deleted_at", "updated_at")


def _guarded(spark, sf_dir):
    products = entity(spark, sf_dir, "products")
    return mutate.soft_delete(products, products.select("product_id"), "product_id", NOW,
                              guard=(entity(spark, sf_dir, "products_sku"), "product_id"))


_GUARD = f"""{ctes("products", "products_sku")},
    busy as (select distinct product_id from products_sku where deleted_at is null)"""


@CATALOG.query("soft_delete_guarded", f"""{_GUARD}
    select product_id, case when deleted_at is null and product_id not in (
        select product_id from busy) then timestamp '{NOW}' else deleted_at end as deleted_at
    from products""")
def soft_delete_guarded(spark, sf_dir):
    return _guarded(spark, sf_dir).df.select("product_id", "deleted_at")


@CATALOG.query("soft_delete_refused", f"""{_GUARD}
    select product_id, case when deleted_at is not null then 'not found or already deleted'
        else 'has active children' end as reason
    from products where deleted_at is not null or product_id in (select product_id from busy)""")
def soft_delete_refused(spark, sf_dir):
    return _guarded(spark, sf_dir).rejected


@CATALOG.query("touch", f"""{ctes("payment_types")}
    select payment_type_id, timestamp '{NOW}' as updated_at from payment_types""")
def touch(spark, sf_dir):
    return mutate.touch(entity(spark, sf_dir, "payment_types"), NOW).select(
        "payment_type_id", "updated_at")


# New SKUs: some with a blank or a taken code, some free of charge, some of a deleted product.
_SKU_REQUESTS = """
    select p_partkey as n,
           case when p_brand = 'Brand#2' then '  '
                when p_size < 10 then concat('SKU_', cast(p_partkey as string))
                else concat('NEW_', cast(p_partkey as string)) end as sku,
           concat('PROD_', lpad(cast(p_partkey + 1 as string),
                cast(greatest(5, length(cast(p_partkey + 1 as string))) as int), '0'))
               as product_id,
           split_part(p_name, ' ', 2) as color, cast(null as string) as size,
           case when p_brand = 'Brand#3' then cast(0 as decimal(10,2))
                else cast(p_retailprice as decimal(10,2)) end as price
    from {part}"""
_SKU_START = 10_000_001


def _sku_insert(spark, sf_dir):
    skus, products = entity(spark, sf_dir, "products_sku"), entity(spark, sf_dir, "products")
    requests = spark.sql(_SKU_REQUESTS, part=table(spark, sf_dir, "part"))
    live = "deleted_at is null"
    return mutate.validated_insert(
        skus, requests,
        [*quality.not_blank("sku"), *quality.positive("price")],
        mutate.KeyRule("sku_id", ["n"], _SKU_START),
        [mutate.Lookup("code is taken", "sku", skus.filter(live), "sku", present=False),
         mutate.Lookup("no such active product", "product_id", products.filter(live),
                       "product_id")],
        {"created_at": NOW, "updated_at": NOW})


_SKU_CHECK = f"""{ctes("products_sku", "products")},
    req as ({_SKU_REQUESTS.format(part="part")}),
    checked as (select *, case when trim(sku) = '' then 'chk_sku_not_blank'
        when price <= 0 then 'chk_price_positive'
        when sku in (select sku from products_sku where deleted_at is null)
            then 'code is taken'
        when product_id not in (select product_id from products where deleted_at is null)
            then 'no such active product' end as reason from req)"""


@CATALOG.query("validated_insert", f"""{_SKU_CHECK}
    select {_SKU_START} - 1 + row_number() over (order by n) as sku_id, sku, product_id, color,
           size, price, timestamp '{NOW}' as created_at, cast(null as timestamp) as deleted_at,
           timestamp '{NOW}' as updated_at
    from checked where reason is null""")
def validated_insert(spark, sf_dir):
    return _sku_insert(spark, sf_dir).inserted


@CATALOG.query("validated_insert_table", f"""{_SKU_CHECK}
    select sku_id, sku, price from products_sku union all
    select {_SKU_START} - 1 + row_number() over (order by n), sku, price
    from checked where reason is null""")
def validated_insert_table(spark, sf_dir):
    return _sku_insert(spark, sf_dir).df.select("sku_id", "sku", "price")


@CATALOG.query("validated_insert_rejected", f"""{_SKU_CHECK}
    select n, sku, reason from checked where reason is not null""")
def validated_insert_rejected(spark, sf_dir):
    return _sku_insert(spark, sf_dir).rejected.select("n", "sku", "reason")


@CATALOG.query("validated_insert_names", f"""{ctes("categories")},
    req as (select distinct lower(p_name) as name from part
            union all select distinct lower(p_type) from part)
    select 100 + row_number() over (order by name) as category_id, name from req
    where name not in (select lower(name) from categories where deleted_at is null)""")
def validated_insert_names(spark, sf_dir):
    """New categories; a name taken by an active one is refused whatever its case."""
    cats = entity(spark, sf_dir, "categories")
    part = table(spark, sf_dir, "part")
    names = part.select(F.lower("p_name").alias("name")).distinct().unionByName(
        part.select(F.lower("p_type").alias("name")).distinct())
    done = mutate.validated_insert(
        cats, names, quality.not_blank("name"), mutate.KeyRule("category_id", ["name"], 101),
        [mutate.Lookup("name exists", "name", cats.filter("deleted_at is null"), "name",
                       present=False, ignore_case=True)],
        {"created_at": NOW, "updated_at": NOW})
    return done.inserted.select("category_id", "name")


def _status_insert(name: str, table: str, key: str, order: str, rules, bad_sql: str,
                   shown: tuple[str, ...]) -> None:
    """Entities whose inserts are checked by row rules only: the table itself as requests."""
    def run(spark, sf_dir):
        rows = entity(spark, sf_dir, table)
        done = mutate.validated_insert(
            rows, rows.withColumnRenamed(key, "_request"), rules(),
            mutate.KeyRule(key, ["_request", *order.split(", ")] if order else ["_request"], 1))
        return done.inserted.select(key, *shown)
    by = f"{key}, {order}" if order else key
    CATALOG.add(name, run, f"""{ctes(table)}
        select row_number() over (order by {by}) as {key}, {", ".join(shown)} from {table}
        where not ({bad_sql})""")


_LIMIT = "1998-01-01"
_status_insert(
    "insert_shipments", "shipments", "shipment_id", "",
    lambda: [quality.one_of("status", SHIPMENT_STATES[:3]),
             *quality.not_future(_LIMIT, "shipment_date")],
    f"status = 'cancelled' or shipment_date > timestamp '{_LIMIT}'",
    ("order_id", "status", "shipment_date"))
_status_insert(
    "insert_transactions", "financial_transactions", "transaction_id", "",
    lambda: [*quality.positive("amount"), quality.one_of("type", LEDGER_SIDES[:1]),
             quality.one_of("status", ORDER_STATES)],
    "amount <= 0 or type = 'credit'", ("account_id", "amount", "type", "status"))
_status_insert(
    "insert_tracking", "delivery_tracking", "tracking_id",
    "checkpoint_time, location, status, shipment_date",
    lambda: [quality.one_of("status", TRACKING_STATES[:2]),
             *quality.not_future(_LIMIT, "checkpoint_time")],
    f"status = 'cancelled' or checkpoint_time > timestamp '{_LIMIT}'",
    ("shipment_id", "checkpoint_time", "status"))


@CATALOG.query("insert_employees", f"""{ctes("employees")}
    select concat('EMP_', lpad(cast(row_number() over (order by employee_id) + 500 as varchar),
        cast(greatest(4, length(cast(row_number() over (order by employee_id) + 500
                                     as varchar))) as int), '0')) as employee_id, name, salary
    from employees where salary > 1000""")
def insert_employees(spark, sf_dir):
    rows = entity(spark, sf_dir, "employees")
    requests = rows.withColumnRenamed("employee_id", "_request")
    done = mutate.validated_insert(
        rows, requests, [*quality.not_blank("name"),
                         quality.Rule("chk_salary_minimum", "salary > 1000")],
        mutate.KeyRule("employee_id", ["_request"], 501, "EMP_", 4))
    return done.inserted.select("employee_id", "name", "salary")


@CATALOG.query("business_ids", """
    select c_custkey, c_name, concat('CUST_', lpad(cast(row_number() over (
        order by c_acctbal desc, c_custkey) + 41 as varchar), 6, '0')) as customer_id
    from customer""")
def business_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", (-F.col("c_acctbal")).alias("_order"))
    return assign_business_id(c, "customer_id", "CUST_", 6, ["_order", "c_custkey"], 42).drop(
        "_order")


@CATALOG.query("sequence_ids", f"""{ctes("order_items")}
    select order_id, order_item_id, sku_id, unit_price, row_number() over (
        order by order_id, order_item_id, sku_id, unit_price) as seq from order_items""")
def sequence_ids(spark, sf_dir):
    i = entity(spark, sf_dir, "order_items").select("order_id", "order_item_id", "sku_id",
                                                    "unit_price")
    return assign_sequence(i, "seq", i.columns)


_SECRET = "a passphrase of the queries"
_PRODUCT_REQUESTS = """select p_partkey as n, p_name as name, cast(p_size as bigint) as category_id,
    concat('FIRST_', cast(p_partkey as string)) as sku,
    cast(p_retailprice as decimal(10,2)) as price,
    p_brand as color, p_type as size from {part}"""


@CATALOG.query("insert_product_with_sku", f"""
    with r as ({_PRODUCT_REQUESTS.format(part="part")}),
    k as (select *, row_number() over (order by n) as i from r)
    select concat('PROD_', lpad(cast(i + 7000 as varchar),
               cast(greatest(5, length(cast(i + 7000 as varchar))) as int), '0')) as product_id,
           name,
           category_id, i + 90000 as sku_id, sku, price, color, size
    from k""")
def insert_product_with_sku(spark, sf_dir):
    requests = spark.sql(_PRODUCT_REQUESTS, part=table(spark, sf_dir, "part"))
    products, skus, _ = mutate.insert_product_with_sku(
        entity(spark, sf_dir, "products"), entity(spark, sf_dir, "products_sku"), requests,
        ["n"], 7001, 90001, NOW)
    return products.select("product_id", "name", "category_id").join(
        skus.select("product_id", "sku_id", "sku", "price", "color", "size"), "product_id")


_MAIL_OK = f"regexp_matches(email, '(?i){quality.EMAIL_PATTERN}')"
_CUSTOMER_REQUESTS = """
    select c_custkey as n, c_name as name,
           case when c_nationkey = 3 then c_name
                else concat('New', cast(c_custkey as string), '@Example.COM') end as email,
           case when c_mktsegment = 'MACHINERY' then concat('+', cast(c_custkey as string))
                else concat('09', lpad(cast(c_custkey as string), 8, '0')) end as phone,
           concat('Nation ', cast(c_nationkey as string)) as address
    from {customer}"""


@CATALOG.query("insert_customers", f"""with r as ({_CUSTOMER_REQUESTS.format(customer="customer")}),
    k as (select *, row_number() over (order by n) + 99999 as i from r
          where {_MAIL_OK} and regexp_matches(phone, '^[0-9]{{8,15}}$'))
    select concat('CUST_', lpad(cast(i as varchar),
               cast(greatest(6, length(cast(i as varchar))) as int), '0')) as customer_id, name,
           email, phone, address, timestamp '{NOW}' as created_at
    from k""")
def insert_customers(spark, sf_dir):
    requests = spark.sql(_CUSTOMER_REQUESTS, customer=table(spark, sf_dir, "customer"))
    done = entity_ops.insert_rows("customers", {"customers": entity(spark, sf_dir, "customers")},
                                  requests, ["n"], 100_000, NOW, secret=_SECRET)
    return decrypt(done.inserted, ["email", "phone"], _SECRET).select(
        "customer_id", "name", "email", "phone", "address", "created_at")


@CATALOG.query("patch_customers_encrypted", f"""{ctes("customers")}
    select customer_id, concat(customer_id, '@mail.example') as email, true as hidden from customers""")
def patch_customers_encrypted(spark, sf_dir):
    """What a patch stores is not the e-mail, but opens to it."""
    rows = entity(spark, sf_dir, "customers")
    mail = F.concat("customer_id", F.lit("@mail.example"))
    requests = rows.select("customer_id", "name", mail.alias("email"), F.lit("0123456789").alias("phone"),
                           "address")
    done = entity_ops.patch_rows("customers", {"customers": rows}, requests, NOW, secret=_SECRET).df
    stored = done.select("customer_id", "email", F.col("email").alias("stored"))
    return decrypt(stored, ["email"], _SECRET).select(
        "customer_id", "email", (F.col("stored") != F.col("email").cast("binary")).alias("hidden"))


def _repeated_stock(spark, sf_dir):
    """For every SKU one request; a second one for the even ones, no quantity for some odd ones."""
    rows = entity(spark, sf_dir, "inventory")
    skus = rows.select("sku_id").distinct()
    requests = skus.select("sku_id", F.when(F.col("sku_id") % 3 != 0, 7).alias("stock_quantity"))
    again = skus.filter("sku_id % 2 = 0").select("sku_id", F.lit(9).alias("stock_quantity"))
    return mutate.set_stock_by_sku(rows, requests.unionByName(again), NOW)


@CATALOG.query("set_stock_repeated", f"""{ctes("inventory")}
    select inventory_id, sku_id, case when sku_id % 2 <> 0 and sku_id % 3 <> 0 then 7
           else stock_quantity end as stock_quantity from inventory""")
def set_stock_repeated(spark, sf_dir):
    return _repeated_stock(spark, sf_dir).df.select("inventory_id", "sku_id", "stock_quantity")


@CATALOG.query("set_stock_repeated_rejected", f"""{ctes("inventory")},
    s as (select distinct sku_id from inventory)
    select sku_id, case when sku_id % 2 = 0 then '{mutate.REPEATED}' else 'no quantity' end as reason
    from s where sku_id % 2 = 0 or sku_id % 3 = 0
    union all select sku_id, '{mutate.REPEATED}' from s where sku_id % 2 = 0""")
def set_stock_repeated_rejected(spark, sf_dir):
    return _repeated_stock(spark, sf_dir).rejected.select("sku_id", "reason")


def _doubled_skus(spark, sf_dir):
    """Every part twice as a new SKU, without a price for some, of unknown products for others."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").alias("n"), F.concat(F.lit("TWIN_"), "p_partkey").alias("sku"),
        F.when(F.col("p_size") < 5, "PROD_none").otherwise("PROD_00002").alias("product_id"),
        F.lit("red").alias("color"), F.lit("L").alias("size"),
        F.when(F.col("p_size") > 45, None).otherwise(F.col("p_retailprice")).cast("decimal(10,2)").alias("price"))
    tables = {n: entity(spark, sf_dir, n) for n in ("products_sku", "products")}
    tables["products"] = tables["products"].withColumn("deleted_at", F.lit(None).cast("timestamp"))
    twice = rows.unionByName(rows.withColumn("n", F.col("n") + 100_000_000))
    return entity_ops.insert_rows("products_sku", tables, twice, ["n"], _SKU_START, NOW)


@CATALOG.query("insert_skus_repeated", f"""
    select {_SKU_START} - 1 + row_number() over (order by p_partkey) as sku_id,
           concat('TWIN_', p_partkey) as sku, cast(p_retailprice as decimal(10,2)) as price
    from part where p_size between 5 and 45""")
def insert_skus_repeated(spark, sf_dir):
    return _doubled_skus(spark, sf_dir).inserted.select("sku_id", "sku", "price")


@CATALOG.query("insert_skus_repeated_rejected", f"""
    select p_partkey as n, case when p_size > 45 then 'price_not_null'
           else 'no such active product' end as reason from part where p_size not between 5 and 45
    union all
    select p_partkey + 100000000, case when p_size > 45 then 'price_not_null'
           when p_size < 5 then 'no such active product' else 'sku: {mutate.REPEATED}' end from part""")
def insert_skus_repeated_rejected(spark, sf_dir):
    return _doubled_skus(spark, sf_dir).rejected.select("n", "reason")


_SKU_PATCH = """
    select sku_id, case when size = '7' then 'SKU_1' else concat(sku, '_v2') end as sku,
           color, cast(null as string) as size,
           cast(case when color = 'red' then 0 else price + 1 end as decimal(10,2)) as price
    from {products_sku} where price > 920
    union all
    select -sku_id, concat('NONE_', sku), color, size, price from {products_sku}
    where price > 990"""


def _sku_patch(spark, sf_dir):
    skus = entity(spark, sf_dir, "products_sku")
    return entity_ops.patch_rows("products_sku", {"products_sku": skus},
                                 spark.sql(_SKU_PATCH, products_sku=skus), NOW)


_SKU_PATCH_CTE = f"""{ctes("products_sku")},
    req as ({_SKU_PATCH.format(products_sku="products_sku")}),
    checked as (select r.*, case when r.price <= 0 then 'chk_price_positive'
        when exists (select 1 from products_sku s where s.deleted_at is null and s.sku = r.sku
                     and s.sku_id <> r.sku_id) then 'sku already exists'
        when not exists (select 1 from products_sku s where s.deleted_at is null
                         and s.sku_id = r.sku_id) then 'not found' end as reason from req r)"""


@CATALOG.query("patch_skus_checked", f"""{_SKU_PATCH_CTE}
    select s.sku_id, case when c.sku_id is null then s.sku else c.sku end as sku,
           case when c.sku_id is null then s.size else c.size end as size,
           case when c.sku_id is null then s.price else c.price end as price,
           case when c.sku_id is null then s.updated_at else timestamp '{NOW}' end as updated_at
    from products_sku s left join checked c on c.sku_id = s.sku_id and c.reason is null""")
def patch_skus_checked(spark, sf_dir):
    return _sku_patch(spark, sf_dir).df.select("sku_id", "sku", "size", "price", "updated_at")


@CATALOG.query("patch_skus_refused", f"""{_SKU_PATCH_CTE}
    select sku_id, sku, reason from checked where reason is not null""")
def patch_skus_refused(spark, sf_dir):
    return _sku_patch(spark, sf_dir).rejected.select("sku_id", "sku", "reason")


@CATALOG.query("soft_delete_products", f"""{_GUARD}
    select product_id, case when deleted_at is null and product_id not in (
        select product_id from busy) then timestamp '{NOW}' else deleted_at end as deleted_at
    from products""")
def soft_delete_products(spark, sf_dir):
    t = {n: entity(spark, sf_dir, n) for n in ("products", "products_sku")}
    return entity_ops.soft_delete_rows("products", t, t["products"].select("product_id"),
                                       NOW).df.select("product_id", "deleted_at")


# Two requests per customer: the second takes the first one's e-mail (segment BUILDING) or phone (MACHINERY).
# Some first ones bear a stored e-mail or phone, or none that is well-formed, so that their second stands.
_CLAIMS = """
    select c_custkey * 2 + i as n, c_name as name,
           case when i = 0 and c_nationkey = 3 then concat('user', cast(c_custkey as string), '@example.com')
                when i = 0 and c_nationkey = 4 then 'no address'
                when i = 1 and c_mktsegment <> 'BUILDING' then concat('b', cast(c_custkey as string), '@new.example')
                else concat('a', cast(c_custkey as string), '@new.example') end as email,
           case when i = 0 and c_nationkey = 5 then concat('84', lpad(cast(c_custkey as string), 9, '0'))
                when i = 1 and c_mktsegment <> 'MACHINERY' then concat('77', lpad(cast(c_custkey as string), 9, '0'))
                else concat('76', lpad(cast(c_custkey as string), 9, '0')) end as phone,
           concat('Nation ', cast(c_nationkey as string)) as address
    from {customer} cross join (select 0 as i union all select 1 as i) as twice"""


@CATALOG.query("insert_customers_unique", f"""with r as ({_CLAIMS.format(customer="customer")}),
    t as (select *, case when not {_MAIL_OK} then 'chk_email_format'
                when email like 'user%' then 'email already exists'
                when phone like '84%' then 'phone already exists' end as first_reason from r),
    w as (select *, count(*) filter (where first_reason is null) over (
                        partition by email order by n rows between unbounded preceding and 1 preceding) as mails,
                    count(*) filter (where first_reason is null) over (
                        partition by phone order by n rows between unbounded preceding and 1 preceding) as phones
          from t)
    select n, email, coalesce(first_reason, case when mails > 0 then 'email: {mutate.REPEATED}'
        when phones > 0 then 'phone: {mutate.REPEATED}' end, 'inserted') as outcome from w""")
def insert_customers_unique(spark, sf_dir):
    """E-mail and phone are unique, though the table holds them encrypted."""
    stored = encrypt(entity(spark, sf_dir, "customers"), ["email", "phone"], _SECRET)
    requests = spark.sql(_CLAIMS, customer=table(spark, sf_dir, "customer"))
    done = entity_ops.insert_rows("customers", {"customers": stored}, requests, ["n"], 100_000, NOW, secret=_SECRET)
    refused = done.rejected.select("n", "email", F.col("reason").alias("outcome"))
    bad = F.when(F.col("outcome").startswith("chk_email"), "chk_email_format").otherwise(F.col("outcome"))
    kept = decrypt(done.inserted, ["email"], _SECRET).select("email").join(requests.select("n", "email"), "email")
    # An e-mail that was inserted once may stand in a refused request as well.
    kept = kept.join(refused, "n", "left_anti").select("n", "email", F.lit("inserted").alias("outcome"))
    return refused.withColumn("outcome", bad).unionByName(kept)


_PLACES = """
    select l_orderkey * 10 + l_linenumber as n, l_suppkey + case when l_quantity > 25 then 1 else 100001 end as warehouse_id,
           concat('PROD_', lpad(cast(l_partkey + 1 as string),
                cast(greatest(5, length(cast(l_partkey + 1 as string))) as int), '0')) as product_id,
           case when l_linenumber < 6 then l_partkey + 1 end as sku_id, cast(l_quantity as int) as stock_quantity,
           l_extendedprice as price
    from {lineitem}"""


@CATALOG.query("insert_inventory_unique", f"""{ctes("inventory")}, r as ({_PLACES.format(lineitem="lineitem")}),
    w as (select *, row_number() over (partition by warehouse_id, product_id, sku_id order by n, stock_quantity, price) as i
          from r)
    select n, stock_quantity, price, case when sku_id is null then null
        when exists (select 1 from inventory v where v.warehouse_id = w.warehouse_id and v.product_id = w.product_id
                     and v.sku_id = w.sku_id) then 'warehouse_id, product_id, sku_id already exists'
        when i > 1 then 'warehouse_id, product_id, sku_id: {mutate.REPEATED}' end as reason
    from w where sku_id is not null and (i > 1 or exists (
        select 1 from inventory v where v.warehouse_id = w.warehouse_id and v.product_id = w.product_id
        and v.sku_id = w.sku_id))""")
def insert_inventory_unique(spark, sf_dir):
    """Refused places of stock: stored ones, and those asked for twice. Without a SKU a place is like no other."""
    requests = spark.sql(_PLACES, lineitem=table(spark, sf_dir, "lineitem"))
    done = mutate.validated_insert(
        entity(spark, sf_dir, "inventory"), requests, quality.non_negative("stock_quantity"),
        mutate.KeyRule("inventory_id", ["n", "stock_quantity", "price"], 1),
        unique=[entity_ops.PLACE])
    return done.rejected.select("n", "stock_quantity", "price", "reason")


@CATALOG.query("insert_product_with_sku_rejected", f"""{ctes("categories")},
    r as ({_PRODUCT_REQUESTS.format(part="part")})
    select n, category_id, 'no such active category' as reason from r
    where category_id not in (select category_id from categories where deleted_at is null)""")
def insert_product_with_sku_rejected(spark, sf_dir):
    """New products of categories that are unknown or deleted."""
    requests = spark.sql(_PRODUCT_REQUESTS, part=table(spark, sf_dir, "part"))
    *_, refused = mutate.insert_product_with_sku(
        entity(spark, sf_dir, "products"), entity(spark, sf_dir, "products_sku"), requests,
        ["n"], 7001, 90001, NOW, entity(spark, sf_dir, "categories"))
    return refused.select("n", "category_id", "reason")
