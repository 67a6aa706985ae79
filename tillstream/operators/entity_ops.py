"""The checked inserts, patches and soft deletes of each entity, as data for ``mutate``.

Tables are given by name, so that an operation can look into the related ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.pii import decrypt, encrypt
from tillstream.operators import quality as q
from tillstream.operators.joins import lookup_join
from tillstream.operators.latest import active
from tillstream.operators.mutate import (
    REPEATED, KeyRule, Lookup, Mutation, apply_patch, soft_delete, validated_insert)
from tillstream.operators.unique import UniqueKey, refuse_repeats
from tillstream.specs import LEDGER_SIDES, ORDER_STATES, SHIPMENT_STATES, TRACKING_STATES, spec

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Insert:
    rules: Callable[[object], list[q.Rule]]      # of the time of the insert
    prefix: str | None = None                    # business id; else a number
    width: int = 0
    dated: tuple[str, ...] = ("updated_at",)     # columns that default to that time
    defaults: tuple[tuple[str, str], ...] = ()
    unique: tuple[UniqueKey, ...] = ()


INSERTS: dict[str, Insert] = {
    "customers": Insert(
        lambda now: [q.matches("email", "(?i)" + q.EMAIL_PATTERN),
                     q.matches("phone", q.PHONE_PATTERN)],
        "CUST_", 6, ("created_at", "updated_at"),
        unique=(UniqueKey(("email",)), UniqueKey(("phone",)))),
    "products_sku": Insert(lambda now: [*q.not_blank("sku"), *q.positive("price")],
                           dated=("created_at", "updated_at")),
    "categories": Insert(lambda now: q.not_blank("name"), dated=("created_at", "updated_at")),
    "payment_types": Insert(lambda now: q.not_blank("name")),
    "accounts": Insert(lambda now: q.not_blank("account_name", "account_type")),
    "departments": Insert(lambda now: q.not_blank("name")),
    "employees": Insert(
        lambda now: [*q.not_blank("name"), *q.positive("salary"), *q.not_future(now, "hire_date")],
        "EMP_", 4, ("hire_date", "updated_at"), unique=(UniqueKey(("email",)),)),
    "suppliers": Insert(lambda now: q.not_blank("name", "contact_name"),
                        dated=("created_at", "updated_at")),
    "purchase_orders": Insert(
        lambda now: [*q.non_negative("total_amount"), q.one_of("status", ORDER_STATES)],
        dated=("order_date", "updated_at"), defaults=(("status", "draft"),)),
    "purchase_order_items": Insert(lambda now: q.positive("quantity", "unit_price"),
                                   dated=("order_date", "updated_at")),
    "financial_transactions": Insert(
        lambda now: [*q.positive("amount"), q.one_of("type", LEDGER_SIDES),
                     q.one_of("status", ORDER_STATES)],
        dated=("transaction_date", "updated_at")),
    "warehouses": Insert(lambda now: q.not_blank("name", "location"),
                         dated=("created_at", "updated_at")),
    "inventory": Insert(lambda now: q.non_negative("stock_quantity"), dated=("last_updated",)),
    "shipments": Insert(
        lambda now: [q.one_of("status", SHIPMENT_STATES), *q.not_future(now, "shipment_date")],
        dated=("shipment_date", "updated_at"), defaults=(("status", "pending"),)),
    "delivery_tracking": Insert(
        lambda now: [q.one_of("status", TRACKING_STATES),
                     *q.not_future(now, "shipment_date", "checkpoint_time")],
        defaults=(("status", "in_transit"),)),
}


# One row of stock per place and SKU. Asked for by name: stock may also be delivered as further rows of a place.
PLACE = UniqueKey(("warehouse_id", "product_id", "sku_id"))


def _insert_lookups(name: str, tables: Tables) -> list[Lookup]:
    if name == "products_sku":
        return [Lookup("code is taken", "sku", active(tables[name]), "sku", present=False),
                Lookup("no such active product", "product_id",
                       active(tables["products"]), "product_id")]
    if name == "categories":
        return [Lookup("category already exists", "name", active(tables[name]), "name",
                       present=False, ignore_case=True)]
    if name in ("departments", "payment_types", "accounts", "suppliers"):
        return []
    return [Lookup(f"no such {ref.cols[0]}", ref.cols[0], tables[ref.parent], ref.parent_cols[0])
            for ref in spec(name).references if len(ref.cols) == 1 and ref.parent in tables]


def _personal(name: str, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in ("email", "phone") and isinstance(spec(name).type_of(c), T.BinaryType)]


def insert_rows(name: str, tables: Tables, requests: DataFrame, order_by: Sequence[str],
                start: int, now, secret: str | None = None, unique: Sequence[UniqueKey] = ()) -> Mutation:
    """Insert requests into ``tables[name]``; keys count up from ``start`` along ``order_by``.

    Columns that may not be null are demanded unless they have a default, and references must
    be found in those of ``tables`` that are given. Personal columns are checked in the clear
    and stored encrypted by ``secret``, which entities that have them demand. ``unique`` names keys
    besides the entity's own (see ``PLACE``).
    """
    how, table = INSERTS[name], tables[name]
    hidden = _personal(name, table.columns)
    if hidden and not secret:
        raise ValueError(f"{name} holds personal data: a secret is needed")
    filled = {spec(name).key[0], "ingestion_time", *how.dated, *dict(how.defaults)}
    needed = q.not_null(*[c for c in spec(name).not_null if c not in filled and c in requests.columns])
    done = validated_insert(
        table, requests, [*how.rules(now), *needed],
        KeyRule(spec(name).key[0], order_by, start, how.prefix, how.width),
        _insert_lookups(name, tables), {**{c: now for c in how.dated}, **dict(how.defaults)},
        [*how.unique, *unique], secret, hidden)
    if not hidden:
        return done
    fresh = encrypt(done.inserted, hidden, secret)
    return Mutation(table.unionByName(fresh), done.rejected, fresh)


@dataclass(frozen=True)
class Patch:
    mode: str                          # what a null means: keep or overwrite
    columns: tuple[str, ...]
    key: tuple[str, ...]
    live: str | None = None            # deleted rows are not patched
    rules: tuple[q.Rule, ...] = ()
    unique: tuple[str, bool] | None = None     # (column, ignore case) among active rows
    parent: tuple[str, str] | None = None      # (column, table) that must exist if given
    stamp: str = "updated_at"


PATCHES: dict[str, Patch] = {
    "categories": Patch(
        "coalesce", ("name",), ("category_id",), "deleted_at",
        (q.Rule("chk_name_not_blank", "name is null or length(trim(name)) > 0"),),
        ("name", True)),
    "products": Patch("coalesce", ("name", "category_id"), ("product_id",), "deleted_at",
                      parent=("category_id", "categories")),
    "inventory": Patch("coalesce", ("stock_quantity", "sku_id", "product_id", "warehouse_id"),
                       ("inventory_id",), stamp="last_updated"),
    "purchase_orders": Patch("coalesce", ("status", "total_amount"), ("po_id", "order_date")),
    "purchase_order_items": Patch("coalesce", ("quantity", "unit_price"),
                                  ("po_item_id", "order_date")),
    "customers": Patch("overwrite", ("name", "email", "phone", "address"), ("customer_id",)),
    "products_sku": Patch("overwrite", ("sku", "color", "size", "price"), ("sku_id",),
                          "deleted_at", tuple(q.positive("price")), ("sku", False)),
    "payment_types": Patch("overwrite", ("name",), ("payment_type_id",),
                           rules=tuple(q.not_blank("name"))),
    "employees": Patch("overwrite", ("name", "email", "department_id", "salary"),
                       ("employee_id",), "deleted_at"),
    "suppliers": Patch("overwrite", ("name", "contact_name", "phone", "email"),
                       ("supplier_id",), "deleted_at"),
    "accounts": Patch("overwrite", ("account_name", "account_type"), ("account_id",)),
    "departments": Patch("overwrite", ("name",), ("department_id",)),
    "financial_transactions": Patch("overwrite", ("amount", "type", "status"),
                                    ("transaction_id",)),
    "warehouses": Patch("overwrite", ("name", "location"), ("warehouse_id",), "deleted_at"),
}


def _taken(table: DataFrame, requests: DataFrame, key: str, column: str,
           ignore_case: bool) -> DataFrame:
    """Requests with ``_taken``: another active row bears the new value.

    Lowest and highest key per value tell whether it belongs to a row other than one's own.
    """
    text = f"lower({column})" if ignore_case else column
    holders = active(table).groupBy(F.expr(text).alias("_value")).agg(
        F.min(key).alias("_low"), F.max(key).alias("_high"))
    probed = lookup_join(requests.withColumn("_value", F.expr(text)), holders, "_value", "left",
                         [key], basis=requests.withColumn("_value", F.expr(text)))
    return probed.withColumn("_taken", F.expr(
        f"coalesce(_low <> {key} or _high <> {key}, false)")).drop("_value", "_low", "_high")


def patch_rows(name: str, tables: Tables, requests: DataFrame, now,
               secret: str | None = None) -> Mutation:
    """Patch ``tables[name]`` by the rules of the entity; personal columns as in an insert."""
    how, table = PATCHES[name], tables[name]
    hidden = _personal(name, how.columns)
    if hidden and not secret:
        raise ValueError(f"{name} holds personal data: a secret is needed")
    columns = requests.columns
    checked = q.apply_rules(requests, how.rules).flagged
    reason = "case when size(violations) > 0 then violations[0] end"
    tested = checked.withColumn("reason", F.expr(reason)).drop("violations")
    if how.unique:
        tested = _taken(table, tested, how.key[0], *how.unique)
        tested = tested.withColumn("reason", F.expr(
            f"coalesce(reason, case when _taken then '{how.unique[0]} already exists' end)")).drop("_taken")
        # Two requests of one batch may not take one value either: the first along the key has it.
        own = UniqueKey((how.unique[0],), how.unique[1])
        tested = refuse_repeats(tested, table.limit(0), [own], how.key, repeated=REPEATED)
    if how.parent:
        column, parent = how.parent
        known = tables[parent].select(column).distinct().withColumn("_found", F.lit(True))
        tested = lookup_join(tested, known, column, "left", list(how.key), basis=requests)
        tested = tested.withColumn("reason", F.expr(
            f"coalesce(reason, case when {column} is not null and _found is null "
            f"then '{column} not found' end)"))
    good = tested.filter("reason is null").select(*columns)
    bad = tested.filter("reason is not null").select(*columns, "reason")
    if hidden:
        good = encrypt(good, hidden, secret)
    done = apply_patch(table, good, how.key, how.columns, how.mode, now, how.stamp, how.live)
    refused = done.rejected
    if hidden:
        clear = decrypt(refused, hidden, secret)
        refused = clear.select(*[F.col(f.name).cast(f.dataType) for f in requests.schema], "reason")
    return Mutation(done.df, bad.unionByName(refused))


# Entities that are soft-deleted, with the children that forbid it while active.
SOFT_DELETES: dict[str, tuple[str, str] | None] = {
    "categories": None, "products_sku": None, "employees": None, "suppliers": None,
    "warehouses": None, "products": ("products_sku", "product_id"),
}


def soft_delete_rows(name: str, tables: Tables, keys: DataFrame, now) -> Mutation:
    child = SOFT_DELETES[name]
    guard = (tables[child[0]], child[1]) if child else None
    return soft_delete(tables[name], keys, spec(name).key[0], now, guard=guard)
