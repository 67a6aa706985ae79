"""Queries on data-quality rules and layer reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.catalog.mapping import ctes, entity, hash_sql
from tillstream.catalog.messages import SNAPSHOT_AT, log_sql, messages
from tillstream.catalog.registry import Catalog
from tillstream.functions.scalars import row_hash
from tillstream.operators import quality, reconcile
from tillstream.operators.merge import empty_silver, merge_upsert
from tillstream.sources.tables import spread
from tillstream.specs import SPECS, TableSpec
from tillstream.streaming.flows import bronze_replay

CATALOG = Catalog()

NOW = "1994-01-15 00:00:00"      # early enough that some rows lie in the future


def _conditions(spec: TableSpec, now: str = NOW, layer: str = "silver",
                lineage: bool = False) -> list[tuple[str, str]]:
    """Every rule of an entity as (name, SQL condition that is true for a broken row)."""
    schema = spec.bronze_schema() if layer == "bronze" else spec.silver_schema()
    have = schema.names if lineage else spec.columns
    needed = [*spec.not_null, *(c for at, c in spec.layer_not_null if at == layer)]
    out = [(f"{c}_not_null", f"{c} is null") for c in needed if c in have]
    out += [(f"chk_{c}_length", f"length({c}) = 0") for c in spec.non_empty if c in have]
    out += [(f"chk_{c}_positive", f"{c} <= 0") for c in spec.positive if c in have]
    out += [(f"chk_{c}_non_negative", f"{c} < 0") for c in spec.non_negative if c in have]
    out += [(f"chk_{c}", f"{c} > timestamp '{now}'") for c in spec.not_future if c in have]
    out += [(f"chk_{a}_after_{b}", f"{a} <= {b}") for a, b in spec.after]
    out += [(f"chk_{c}_allowed", f"{c} not in ({', '.join(repr(v) for v in values)})")
            for c, values in spec.allowed]
    return [(n, c) for n, c in out if n not in spec.dropped_rules]


def _rules(name: str) -> list[quality.Rule]:
    spec = SPECS[name]
    return quality.table_rules(spec, NOW, spec.columns)


@CATALOG.query("quality_all_tables", ctes(*SPECS) + " union all ".join(
    f"select '{n}' as entity, '{rule}' as rule, count(*) filter (where {bad}) as violations "
    f"from {n}" for n, s in SPECS.items() for rule, bad in _conditions(s)))
def quality_all_tables(spark, sf_dir):
    """Broken rows per rule and entity, one pass over each table."""
    parts = [quality.rule_counts(entity(spark, sf_dir, n), _rules(n)).select(
        F.lit(n).alias("entity"), "rule", "violations") for n in SPECS]
    return reduce(DataFrame.unionByName, parts)


# Entities whose rules differ between the layers.
_LAYERED = ("customers", "products", "audit_log_pos")
_LATER = "2024-01-05 00:00:00"       # between the snapshot and the updates


def _layer_sql(layer: str) -> str:
    parts = []
    for n in _LAYERED:
        rules = _conditions(SPECS[n], _LATER, layer, lineage=True)
        cells = ", ".join(f"count(*) filter (where {bad})" for _, bad in rules)
        names = ", ".join(f"'{r}'" for r, _ in rules)
        rows = "log" if layer == "bronze" else "log where transaction_type = 'r'"
        parts.append(f"""select '{n}' as entity, unnest([{names}]) as rule, unnest(v) as violations
            from ({log_sql(n)} select [{cells}] as v from {rows})""")
    return " union all ".join(parts)


def _layer_counts(rows, name: str, layer: str):
    rules = quality.table_rules(SPECS[name], _LATER, rows.columns, layer=layer)
    return quality.rule_counts(rows, rules).select(F.lit(name).alias("entity"), "rule", "violations")


@CATALOG.query("quality_bronze", _layer_sql("bronze"))
def quality_bronze(spark, sf_dir):
    """The rules of the history layer over decoded rows, lineage columns and hash included."""
    return reduce(DataFrame.unionByName, [_layer_counts(
        bronze_replay(SPECS[n], messages(spark, sf_dir, n)), n, "bronze") for n in _LAYERED])


@CATALOG.query("quality_silver", _layer_sql("silver"))
def quality_silver(spark, sf_dir):
    """The rules of the current layer over merged rows (the snapshot)."""
    parts = []
    for n in _LAYERED:
        rows = bronze_replay(SPECS[n], messages(spark, sf_dir, n)).filter("transaction_type = 'r'")
        kept = [c for c in SPECS[n].silver_schema().names if c in rows.columns]
        merged = merge_upsert(empty_silver(spark, SPECS[n]), rows, SPECS[n], SNAPSHOT_AT).df
        parts.append(_layer_counts(merged.select(*kept), n, "silver"))
    return reduce(DataFrame.unionByName, parts)


def _flag_sql(name: str, key: str, now: str = NOW) -> str:
    cases = ", ".join(f"case when {bad} then '{rule}' end"
                      for rule, bad in _conditions(SPECS[name], now))
    return f"""{ctes(name)}, f as (
        select {key}, concat_ws(',', {cases}) as violations from {name})"""


@CATALOG.query("quality_flags", _flag_sql("employees", "employee_id")
               + " select * from f where violations <> ''")
def quality_flags(spark, sf_dir):
    checked = quality.apply_rules(entity(spark, sf_dir, "employees"), _rules("employees"))
    return checked.rejected.select("employee_id",
                                   F.concat_ws(",", "violations").alias("violations"))


@CATALOG.query("quality_valid", _flag_sql("inventory", "inventory_id", "1998-01-01")
               + " select inventory_id from f where violations = ''")
def quality_valid(spark, sf_dir):
    rules = quality.table_rules(SPECS["inventory"], "1998-01-01", SPECS["inventory"].columns)
    return quality.apply_rules(entity(spark, sf_dir, "inventory"), rules).valid.select(
        "inventory_id")


@CATALOG.query("quality_relaxed", f"""{ctes("products")}
    select count(*) filter (where updated_at > timestamp '{NOW}') as violations,
           'chk_updated_at' as rule from products
    union all select 0, r from (values ('chk_created_at'), ('chk_deleted_at_after_created_at'))
        as v(r)""")
def quality_relaxed(spark, sf_dir):
    """Rules taken out of a spec are not evaluated."""
    spec = SPECS["products"].without(
        "chk_deleted_at", "product_id_not_null", "name_not_null", "category_id_not_null",
        "created_at_not_null", "updated_at_not_null", "chk_product_id_length",
        "chk_name_length")
    return quality.rule_counts(entity(spark, sf_dir, "products"),
                               quality.table_rules(spec, NOW, spec.columns))


@CATALOG.query("quality_contacts", f"""{ctes("customers")}, c as (
    select customer_id, email, case when address < 'Nation 2' then '+' || phone else phone end
        as phone, case when address = 'Nation 3' then '  ' else address end as address
    from customers)
    select customer_id, concat_ws(',',
        case when not regexp_matches(email, '{quality.EMAIL_PATTERN}') then 'chk_email_format' end,
        case when not regexp_matches(phone, '{quality.PHONE_PATTERN}') then 'chk_phone_format' end,
        case when trim(address) = '' then 'chk_address_not_blank' end) as violations
    from c""")
def quality_contacts(spark, sf_dir):
    c = entity(spark, sf_dir, "customers", typed=False)
    c = c.withColumn("phone", F.expr("case when address < 'Nation 2' then '+' || phone "
                                     "else phone end"))
    c = c.withColumn("address", F.expr("case when address = 'Nation 3' then '  ' "
                                       "else address end"))
    rules = [quality.matches("email", "(?i)" + quality.EMAIL_PATTERN),
             quality.matches("phone", quality.PHONE_PATTERN), *quality.not_blank("address")]
    return quality.apply_rules(c, rules).flagged.select(
        "customer_id", F.concat_ws(",", "violations").alias("violations"))


@CATALOG.query("duplicate_keys", f"""{ctes("order_items")}
    select order_item_id, count(*) as row_count from order_items
    group by order_item_id having count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicates(entity(spark, sf_dir, "order_items"), "order_item_id")


@CATALOG.query("duplicate_keys_composite", f"""{ctes("delivery_tracking")}
    select shipment_id, checkpoint_time, count(*) as row_count from delivery_tracking
    group by shipment_id, checkpoint_time having count(*) > 1""")
def duplicate_keys_composite(spark, sf_dir):
    return quality.duplicates(entity(spark, sf_dir, "delivery_tracking"),
                              ["shipment_id", "checkpoint_time"])


_NAME_REQUESTS = "select product_id, upper(name) as name from products where category_id = 1"


@CATALOG.query("duplicate_names", f"""{ctes("products")}, n as ({_NAME_REQUESTS})
    select n.product_id, n.name from n where lower(n.name) in (
        select lower(name) from products where deleted_at is null and category_id <> 1)""")
def duplicate_names(spark, sf_dir):
    p = entity(spark, sf_dir, "products")
    new = p.filter("category_id = 1").select("product_id", F.upper("name").alias("name"))
    return quality.duplicate_names(p.filter("category_id <> 1"), new)


@CATALOG.query("conflicts", f"""{ctes("products")}, n as ({_NAME_REQUESTS})
    select name, count(*) as existing_rows from products
    where name in (select lower(name) from n) group by name""")
def conflicts(spark, sf_dir):
    p = entity(spark, sf_dir, "products")
    new = p.filter("category_id = 1").select("name")
    return quality.conflicts(new, p, "name")


ORDERS = SPECS["orders"]


def _layers(spark, sf_dir):
    """Orders as they should be, and a copy that lost, gained and changed rows."""
    o = spread(entity(spark, sf_dir, "orders"))
    expected = o.filter("payment_type_id <> 5").withColumn("hash", row_hash(o, o.columns))
    copy = o.filter("payment_type_id <> 1").withColumn(
        "payment_status", F.when(F.col("payment_type_id") == 2, "pending")
        .otherwise(F.col("payment_status")))
    return expected, copy.withColumn("hash", row_hash(copy, o.columns))


_CHANGED_HASH = hash_sql("orders").replace(
    "cast(payment_status as varchar)",
    "case when payment_type_id = 2 then 'pending' else payment_status end")
_LAYERS = f"""{ctes("orders")},
    a as (select order_id, {hash_sql("orders")} as hash from orders where payment_type_id <> 5),
    b as (select order_id, {_CHANGED_HASH} as hash from orders where payment_type_id <> 1)"""


_RECONCILE = f"""{_LAYERS}
    select coalesce(a.order_id, b.order_id) as order_id,
           case when b.order_id is null then 'missing' when a.order_id is null then 'extra'
                else 'different' end as status,
           a.hash as expected_hash, b.hash as actual_hash
    from a full outer join b on a.order_id = b.order_id
    where a.hash is distinct from b.hash"""


@CATALOG.query("reconcile", _RECONCILE)
def reconcile_layers(spark, sf_dir):
    return reconcile.reconcile(*_layers(spark, sf_dir), "order_id")


@CATALOG.query("reconcile_digests", _RECONCILE)
def reconcile_digests(spark, sf_dir):
    return reconcile.reconcile_digests(*_layers(spark, sf_dir), "order_id")


@CATALOG.query("reconcile_digests_few", f"""{ctes("orders")}
    select order_id, case when payment_type_id = 1 then 'missing' else 'different' end as status
    from orders where order_id % 500 = 7""")
def reconcile_digests_few(spark, sf_dir):
    """Layers that agree but for one order in 500."""
    o = spread(entity(spark, sf_dir, "orders"))
    hashed = o.withColumn("hash", row_hash(o, o.columns)).select("order_id", "payment_type_id", "hash")
    changed = F.when(F.col("order_id") % 500 == 7, F.lit("other")).otherwise(F.col("hash"))
    copy = hashed.filter("not (order_id % 500 = 7 and payment_type_id = 1)").withColumn("hash", changed)
    return reconcile.reconcile_digests(hashed, copy, "order_id").select("order_id", "status")


@CATALOG.query("integrity_report", f"""{_LAYERS}, bb as (
        select order_id from b union all
        select order_id + 1 from orders where payment_status = 'failed')
    select (select count(*) from a) as upstream_rows, (select count(*) from bb) as downstream_rows,
           (select count(distinct order_id) from a) as upstream_keys,
           (select count(*) from (select order_id from bb group by order_id
                                  having count(*) > 1)) as duplicate_keys,
           (select count(*) from (select order_id from a except select order_id from bb))
               as lost_keys,
           (select count(*) from (select order_id from bb except select order_id from a))
               as unexpected_keys""")
def integrity_report(spark, sf_dir):
    expected, copy = _layers(spark, sf_dir)
    failed = entity(spark, sf_dir, "orders").filter("payment_status = 'failed'")
    doubled = copy.select("order_id").unionByName(
        failed.select((F.col("order_id") + 1).alias("order_id")))
    return reconcile.integrity_report(expected, doubled, "order_id")


@CATALOG.query("repair", f"""{_LAYERS}
    select order_id, hash from a
    union all select order_id, hash from b where order_id not in (select order_id from a)""")
def repair(spark, sf_dir):
    """After repair every expected row is there; extra rows are left alone."""
    expected, copy = _layers(spark, sf_dir)
    at = F.lit("2024-01-01").cast("timestamp")
    copy, expected = (d.withColumn("ingestion_time", at) for d in (copy, expected))
    diff = reconcile.reconcile(expected, copy, "order_id")
    fixed = reconcile.repair(copy, expected, diff, ORDERS, "2024-01-02")
    return fixed.df.select("order_id", "hash")
