"""Batch mutations: frames of requests applied to a table, with rejected rows and reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.ids import assign_business_id, assign_sequence, business_id
from tillstream.operators.joins import (
    gather, is_small, keyed_join, lookup_join, with_children, without_children)
from tillstream.operators.quality import Rule, apply_rules, not_blank, not_null, positive
from tillstream.operators.unique import UniqueKey, refuse_repeats


@dataclass(frozen=True)
class Mutation:
    df: DataFrame                        # the table afterwards
    rejected: DataFrame                  # requests not applied, with ``reason``
    inserted: DataFrame | None = None    # new rows with their generated keys


def touch(df: DataFrame, now, col: str = "updated_at", when=None) -> DataFrame:
    """Stamp the rows (all, or those where ``when`` holds) as written at ``now``."""
    stamp = F.lit(now).cast("timestamp")
    return df.withColumn(col, stamp if when is None else F.when(when, stamp).otherwise(F.col(col)))


def _reject(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn("reason", F.lit(reason))


REPEATED = "requested more than once"


def _split_repeats(requests: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Requests with a key of their own, and those that share it: which one counts is unknown. A null
    key is shared by none.

    Many requests are gathered by key once, for all that is asked about them.
    """
    columns = requests.columns
    if not is_small(requests):
        requests = gather(requests, key)
    given = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    shared = given & (F.count(F.lit(1)).over(Window.partitionBy(*key)) > 1)
    marked = requests.withColumn("_shared", shared)
    return (marked.filter("not _shared").select(*columns),
            _reject(marked.filter("_shared").select(*columns), REPEATED))


def _unknown(requests: DataFrame, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Requests without a row of ``table``. An outer join, as Spark would carry an anti join below the gathering
    and move the requests again."""
    known = table.select(*key, F.lit(True).alias("_known"))
    return keyed_join(requests, known, key, "left").filter("_known is null").select(*requests.columns)


def apply_patch(
    table: DataFrame,
    patch: DataFrame,
    key,
    columns: Sequence[str],
    mode: str = "coalesce",
    now=None,
    stamp: str = "updated_at",
    live: str | None = None,
) -> Mutation:
    """Update ``columns`` of the rows named by ``patch``; requests that share a key are rejected.

    ``mode="coalesce"``: a null in the patch keeps the old value; ``"overwrite"``: it clears
    it. ``live`` names a soft-delete column; deleted rows are not patched. Requests without a
    target row are rejected.
    """
    if mode not in ("coalesce", "overwrite"):
        raise ValueError(mode)
    key = [key] if isinstance(key, str) else list(key)
    patch, repeated = _split_repeats(patch, key)
    slim = patch.select(*key, F.lit(True).alias("_hit"),
                        *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = keyed_join(table, slim, key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if live:
        hit = hit & F.col(live).isNull()

    def value(c: str):
        if c in columns:
            new = F.col(f"_new_{c}")
            new = F.coalesce(new, F.col(c)) if mode == "coalesce" else new
            return F.when(hit, new).otherwise(F.col(c)).alias(c)
        if now is not None and c == stamp:
            return F.when(hit, F.lit(now).cast("timestamp")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    targets = table.filter(F.col(live).isNull()) if live else table
    missing = _unknown(patch, targets, key)
    return Mutation(joined.select(*[value(c) for c in table.columns]),
                    _reject(missing, "not found").unionByName(repeated))


def set_stock_by_sku(inventory: DataFrame, requests: DataFrame, now) -> Mutation:
    """Set the stock of every inventory row of a SKU. Requests: sku_id, stock_quantity.

    Requests without a quantity, with a negative one, or that share a SKU are rejected.
    """
    single, repeated = _split_repeats(requests, ["sku_id"])
    good = single.filter(F.col("stock_quantity") >= 0)
    reason = F.when(F.col("stock_quantity") < 0, "stock cannot be negative").otherwise("no quantity")
    bad = single.withColumn("reason", reason).filter(~F.coalesce(F.col("stock_quantity") >= 0, F.lit(False)))
    slim = good.select("sku_id", F.col("stock_quantity").alias("_stock"))
    joined = lookup_join(inventory, slim, "sku_id", "left", spread=["inventory_id"])
    hit = F.col("_stock").isNotNull()
    stamp = F.lit(now).cast("timestamp")
    out = joined.select(*[
        F.coalesce(F.col("_stock"), F.col(c)).alias(c) if c == "stock_quantity"
        else F.when(hit, stamp).otherwise(F.col(c)).alias(c) if c == "last_updated"
        else F.col(c) for c in inventory.columns])
    missing = without_children(good, inventory, "sku_id")
    return Mutation(out, bad.unionByName(_reject(missing, "not found")).unionByName(repeated))


def soft_delete(table: DataFrame, keys: DataFrame, key: str, now, deleted: str = "deleted_at",
                stamp: str | None = "updated_at",
                guard: tuple[DataFrame, str] | None = None) -> Mutation:
    """Mark active rows as deleted.

    ``guard=(children, column)`` refuses a row that still has active children. Unknown and
    already deleted rows are rejected.
    """
    wanted = keys.select(key).distinct()
    live = table.filter(F.col(deleted).isNull())
    found = with_children(wanted, live, key)
    rejected = _reject(without_children(wanted, live, key), "not found or already deleted")
    if guard is not None:
        children, column = guard
        busy = children.filter(F.col(deleted).isNull()).select(F.col(column).alias(key))
        rejected = rejected.unionByName(
            _reject(with_children(found, busy, key), "has active children"))
        found = without_children(found, busy, key)
    joined = keyed_join(table, found.withColumn("_hit", F.lit(True)), key, "left")
    at = F.lit(now).cast("timestamp")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = joined.select(*[
        F.when(hit, at).otherwise(F.col(c)).alias(c) if c in (deleted, stamp) else F.col(c)
        for c in table.columns])
    return Mutation(out, rejected)


@dataclass(frozen=True)
class KeyRule:
    """How new keys are made: ``prefix`` + zero-padded number, or the bare number."""
    column: str
    order_by: Sequence[str]
    start: int = 1
    prefix: str | None = None
    width: int = 0


@dataclass(frozen=True)
class Lookup:
    """A request column that must (or must not) be present in another table.

    A null is present nowhere and refers to nothing. What must not be present may not be there
    twice among the requests either: the first one along the order of the keys counts.
    """
    reason: str
    column: str
    table: DataFrame
    table_column: str
    present: bool = True
    ignore_case: bool = False


def validated_insert(
    table: DataFrame,
    requests: DataFrame,
    rules: Sequence[Rule],
    key: KeyRule,
    lookups: Sequence[Lookup] = (),
    defaults: dict[str, object] | None = None,
    unique: Sequence[UniqueKey] = (),
    secret: str | None = None,
    hidden: Sequence[str] = (),
) -> Mutation:
    """Check requests, give the good ones keys and append them.

    Requests are first tested by row rules, then against other tables, all in one plan, last by the
    ``unique`` keys of the table (whose ``hidden`` columns ``secret`` opens). The first reason found is
    the one reported.
    """
    first = F.when(F.size("violations") > 0, F.element_at("violations", 1))
    tested = apply_rules(requests, rules).flagged.withColumn("reason", first).drop("violations")
    def norm(test: Lookup, c):
        return F.lower(c) if test.ignore_case else c

    for test in lookups:
        keys = test.table.select(norm(test, F.col(test.table_column)).alias("_probe")).distinct()
        probed = tested.withColumn("_probe", norm(test, F.col(test.column)))
        found = lookup_join(probed, keys.withColumn("_found", F.lit(True)), "_probe", "left",
                            requests.columns, basis=requests.withColumn(
                                "_probe", norm(test, F.col(test.column))))
        given = F.col(test.column).isNotNull()
        bad = given & (F.col("_found").isNull() if test.present else F.col("_found").isNotNull())
        tested = found.withColumn("reason", F.coalesce(
            F.col("reason"), F.when(bad, F.lit(test.reason)))).drop("_probe", "_found")
    for test in (t for t in lookups if not t.present):
        # Requests that are refused already take no value.
        value = norm(test, F.col(test.column))
        order = Window.partitionBy(value, F.col("reason").isNull()).orderBy(*key.order_by)
        later = value.isNotNull() & (F.row_number().over(order) > 1)
        tested = tested.withColumn("reason", F.coalesce(
            F.col("reason"), F.when(later, F.lit(f"{test.column}: {REPEATED}"))))
    if unique:
        tested = refuse_repeats(tested, table, unique, key.order_by, secret, hidden, REPEATED)
    good = tested.filter(F.col("reason").isNull()).select(*requests.columns)
    rejected = tested.filter(F.col("reason").isNotNull()).select(*requests.columns, "reason")
    if key.prefix is None:
        keyed = assign_sequence(good, key.column, key.order_by, key.start)
    else:
        keyed = assign_business_id(good, key.column, key.prefix, key.width, key.order_by, key.start)
    for column, value in (defaults or {}).items():
        given = F.lit(value).cast(table.schema[column].dataType)
        keyed = keyed.withColumn(
            column, F.coalesce(F.col(column), given) if column in keyed.columns else given)
    fresh = keyed.select(*[
        (F.col(f.name) if f.name in keyed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields])
    return Mutation(table.unionByName(fresh), rejected, fresh)


def insert_product_with_sku(products: DataFrame, skus: DataFrame, requests: DataFrame,
                            order_by: Sequence[str], product_start: int, sku_start: int,
                            now, categories: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New products, each with its first SKU. Returns (new products, new SKUs, rejected requests).

    Requests: name, category_id, sku, price, color, size. Name, category, SKU code and a positive
    price are demanded, and a code that no active SKU and no earlier request bears. Where
    ``categories`` are given, the category must be one of the active ones.
    """
    rules = [*not_blank("name", "sku"), *not_null("category_id"), *not_null("price"), *positive("price")]
    taken = Lookup("code is taken", "sku", skus.filter("deleted_at is null"), "sku", present=False)
    given = requests.withColumn("_request", F.lit(None).cast("bigint"))
    lookups = [taken]
    if categories is not None:
        lookups.insert(0, Lookup("no such active category", "category_id",
                                 categories.filter("deleted_at is null"), "category_id"))
    done = validated_insert(given, requests, rules, KeyRule("_request", order_by, 0), lookups)
    numbered = done.inserted.withColumnRenamed("_request", "_n")
    at = F.lit(now).cast("timestamp")
    rows = numbered.select(
        "*", at.alias("created_at"), at.alias("updated_at"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        business_id("PROD_", 5, F.col("_n") + product_start).alias("product_id"),
        (F.col("_n") + sku_start).alias("sku_id"))
    return rows.select(*products.columns), rows.select(*skus.columns), done.rejected
