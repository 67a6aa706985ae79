"""Physical purge of expired rows: every rule splits a table into kept and purged rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import (
    child_flag, children_of, not_children_of, parent_flag, with_children, without_children)
from tillstream.session import settle
from tillstream.sources.tables import by_month

RETENTION_MONTHS = 3


def cutoff(as_of, months: int = RETENTION_MONTHS) -> Column:
    return F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(months)} MONTHS")


GONE = "_gone"


@dataclass(frozen=True)
class Purge:
    """``marked`` gives both halves in one frame, told apart by the boolean ``_gone``, from one pass over the
    table: for whoever stores both. Without it there are only the halves."""
    keep: DataFrame
    purged: DataFrame
    marked: Callable[[], DataFrame] | None = None


def _split(df: DataFrame, expired: Column) -> Purge:
    expired = F.coalesce(expired, F.lit(False))
    return Purge(df.filter(~expired), df.filter(expired), lambda: df.withColumn(GONE, expired))


def purge_older(df: DataFrame, ts: str, as_of, months: int = RETENTION_MONTHS) -> Purge:
    """Rows strictly older than the cut-off go. A row without a time stays."""
    return _split(df, F.col(ts) < cutoff(as_of, months))


def purge_expired(df: DataFrame, as_of, months: int = RETENTION_MONTHS,
                  deleted: str = "deleted_at") -> Purge:
    """Rows soft-deleted before the cut-off go."""
    return purge_older(df, deleted, as_of, months)


def purge_childless(parent: DataFrame, child: DataFrame, on: str, ts: str, as_of,
                    months: int = RETENTION_MONTHS) -> Purge:
    """Old parents without any child row go."""
    aged = purge_older(parent, ts, as_of, months)

    def marked() -> DataFrame:
        old = child_flag(aged.purged, child, on, GONE).withColumn(GONE, F.col(GONE).isNull())
        return aged.keep.withColumn(GONE, F.lit(False)).unionByName(old)
    return Purge(aged.keep.unionByName(with_children(aged.purged, child, on)),
                 without_children(aged.purged, child, on), marked)


def purge_expired_childless(parent: DataFrame, child: DataFrame, on: str, as_of,
                            months: int = RETENTION_MONTHS) -> Purge:
    return purge_childless(parent, child, on, "deleted_at", as_of, months)


def purge_cascade(parent: DataFrame, child: DataFrame, on: str, as_of,
                  months: int = RETENTION_MONTHS) -> tuple[Purge, Purge]:
    """Expired parents go, and all their child rows with them."""
    parents = purge_expired(parent, as_of, months)
    gone = parents.purged.select(on)
    return parents, Purge(not_children_of(child, gone, on), children_of(child, gone, on),
                          lambda: parent_flag(child, gone, on, GONE).withColumn(GONE, F.col(GONE).isNotNull()))


def purge_products(products: DataFrame, skus: DataFrame, items: DataFrame, as_of,
                   months: int = RETENTION_MONTHS) -> tuple[Purge, Purge]:
    """SKUs of expired products go unless ordered; then expired products left without SKU go.

    Returns the products split and the SKU split.
    """
    sku_purge = purge_skus(products, skus, items, as_of, months)
    return purge_expired_childless(products, sku_purge.keep, "product_id", as_of, months), sku_purge


def purge_skus(products: DataFrame, skus: DataFrame, items: DataFrame, as_of,
               months: int = RETENTION_MONTHS) -> Purge:
    """SKUs of expired products go unless ordered; ``sku_id`` is their key."""
    expired = purge_expired(products, as_of, months).purged.select("product_id")
    doomed = without_children(children_of(skus, expired, "product_id"), items, "sku_id")
    return Purge(without_children(skus, doomed, "sku_id"), doomed,
                 lambda: child_flag(skus, doomed, "sku_id", GONE).withColumn(GONE, F.col(GONE).isNotNull()))


Tables = dict[str, DataFrame]
# A step of several parts is a tuple of them; each part sees what the parts before it left.
Part = Callable[[Tables, object, int], dict[str, Purge]]
Step = Part | tuple[Part, ...]


def _cascade_skus(t: Tables, as_of, months: int) -> dict[str, Purge]:
    skus, items = purge_cascade(t["products_sku"], t["order_items"], "sku_id", as_of, months)
    return {"products_sku": skus, "order_items": items}


def _skus(t: Tables, as_of, months: int) -> dict[str, Purge]:
    return {"products_sku": purge_skus(t["products"], t["products_sku"], t["order_items"], as_of, months)}


def _older(table: str, ts: str) -> Part:
    return lambda t, as_of, months: {table: purge_older(t[table], ts, as_of, months)}


def _childless(table: str, child: str, on: str, ts: str) -> Part:
    return lambda t, as_of, months: {
        table: purge_childless(t[table], t[child], on, ts, as_of, months)}


# The daily run, in order. Each step reads what the steps before it left.
RETENTION_STEPS: tuple[tuple[str, Step], ...] = (
    ("order_items", _older("order_items", "order_date")),
    ("orders", _childless("orders", "order_items", "order_id", "order_date")),
    ("products_sku", _cascade_skus),
    ("products", (_skus, _childless("products", "products_sku", "product_id", "deleted_at"))),
    ("categories", _childless("categories", "products", "category_id", "deleted_at")),
    ("delivery_tracking", _older("delivery_tracking", "shipment_date")),
    ("shipments", _childless("shipments", "delivery_tracking", "shipment_id", "shipment_date")),
    ("purchase_order_items", _older("purchase_order_items", "order_date")),
    ("purchase_orders",
     _childless("purchase_orders", "purchase_order_items", "po_id", "order_date")),
    ("suppliers", _childless("suppliers", "purchase_orders", "supplier_id", "deleted_at")),
    ("financial_transactions", _older("financial_transactions", "transaction_date")),
    ("employees", lambda t, as_of, m: {"employees": purge_expired(t["employees"], as_of, m)}),
)

# Not part of the daily run.
WAREHOUSE_STEP: tuple[str, Step] = (
    "warehouses", _childless("warehouses", "inventory", "warehouse_id", "deleted_at"))


def purge_stock(t: Tables, as_of, months: int = RETENTION_MONTHS) -> Purge:
    """Inventory of expired warehouses or expired products goes."""
    gone_w = purge_expired(t["warehouses"], as_of, months).purged
    gone_p = purge_expired(t["products"], as_of, months).purged
    by_house = children_of(t["inventory"], gone_w, "warehouse_id")
    rest = not_children_of(t["inventory"], gone_w, "warehouse_id")
    return Purge(not_children_of(rest, gone_p, "product_id"),
                 by_house.unionByName(children_of(rest, gone_p, "product_id")))


@dataclass(frozen=True)
class RetentionRun:
    tables: Tables
    purged: dict[str, list[DataFrame]]
    counts: DataFrame              # step_no, step, table_name, rows_deleted
    failures: dict[str, str]


def _settled(purge: Purge, name: str) -> Purge:
    """Both halves as tables; marked rows are one table, written once."""
    if purge.marked is None:
        return Purge(settle(purge.keep, name), settle(purge.purged, f"{name}-purged"))
    marked = settle(purge.marked(), name)
    return Purge(marked.filter(~F.col(GONE)).drop(GONE), marked.filter(GONE).drop(GONE), lambda: marked)


def run_retention(tables: Tables, as_of, months: int = RETENTION_MONTHS,
                  steps: Sequence[tuple[str, Step]] = RETENTION_STEPS,
                  materialize: bool = False) -> RetentionRun:
    """All purges in order; a step that fails leaves its tables alone and the run goes on.

    ``materialize`` writes each step's result to a table, which cuts the lineage and lets a
    step's run-time failure be caught as well. Both halves of a table are written in one pass, as one
    table with a mark (column ``_gone``, which no table may have), where the step gives marks.
    """
    state, purged, failures, counts = dict(tables), {}, {}, []
    for number, (name, step) in enumerate(steps, 1):
        result, after = {}, dict(state)
        try:
            for part in step if isinstance(step, tuple) else (step,):
                done = part(after, as_of, months)
                if materialize:
                    done = {n: _settled(p, n) for n, p in done.items()}
                result |= done
                after |= {n: p.keep for n, p in done.items()}
        except Exception as exc:
            failures[name] = f"{type(exc).__name__}: {exc}"
            continue
        state = after
        for table, purge in result.items():
            purged.setdefault(table, []).append(purge.purged)
            counts.append(purge.purged.agg(
                F.lit(number).alias("step_no"), F.lit(name).alias("step"),
                F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows_deleted")))
    if not counts:
        raise ValueError(f"every retention step failed: {failures}")
    return RetentionRun(state, purged, reduce(DataFrame.unionByName, counts), failures)


def archive(purged: DataFrame, path: str, ts: str, run: str = "once") -> None:
    """Copy purged rows to the cold path, one folder per run and month of ``ts``.

    A run that is repeated after a failure overwrites the months that it still finds, and keeps
    those whose rows are gone from the table already.
    """
    (by_month(purged, ts).withColumn("run", F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run", "month").parquet(path))
