"""Summary tables over the current tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.scalars import line_amount, month_label
from tillstream.operators.joins import lookup_join


def materialize(view: DataFrame, path: str) -> DataFrame:
    """Write a view and read it back."""
    view.write.mode("overwrite").parquet(path)
    return view.sparkSession.read.parquet(path)


def _totals(items: DataFrame, key: str) -> DataFrame:
    return items.groupBy(key).agg(
        F.sum(line_amount()).cast("decimal(28,2)").alias("items_total"),
        F.count(F.lit(1)).alias("item_count"))


def order_totals(items: DataFrame) -> DataFrame:
    return _totals(items, "order_id").select("order_id", "items_total")


def po_totals(items: DataFrame) -> DataFrame:
    return _totals(items, "po_id").select("po_id", "items_total")


def item_counts(items: DataFrame, key: str = "order_id") -> DataFrame:
    return _totals(items, key).select(key, "item_count")


def revenue_by_payment_type(orders: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Completed revenue per month and payment type; aggregated before the name is joined."""
    sums = (orders.filter(F.col("payment_status") == "completed")
            .groupBy(month_label("order_date").alias("month"), "payment_type_id")
            .agg(F.sum("total_amount").cast("decimal(28,2)").alias("revenue"),
                 F.count(F.lit(1)).alias("order_count")))
    return lookup_join(sums, payment_types.select("payment_type_id", F.col("name").alias(
        "payment_type")), "payment_type_id").select("month", "payment_type", "revenue",
                                                    "order_count")


def revenue_by_category(items: DataFrame, products: DataFrame,
                        categories: DataFrame) -> DataFrame:
    """Item revenue per month and category; summed per product before any join."""
    per_product = (items.groupBy(month_label("order_date").alias("month"), "product_id")
                   .agg(F.sum(line_amount()).alias("amount"),
                        F.sum("quantity").alias("units")))
    with_cat = lookup_join(per_product, products.select("product_id", "category_id"),
                           "product_id", spread=["month"], basis=items)
    by_cat = with_cat.groupBy("month", "category_id").agg(
        F.sum("amount").cast("decimal(28,2)").alias("revenue"), F.sum("units").alias("units"))
    return lookup_join(by_cat, categories.select("category_id", F.col("name").alias("category")),
                       "category_id").select("month", "category", "revenue", "units")


def customer_features(orders: DataFrame, as_of) -> DataFrame:
    """Recency (days), frequency and monetary value of every customer with an order."""
    at = F.lit(as_of).cast("timestamp")
    past = orders.filter(F.col("order_date") <= at)
    paid = F.when(F.col("payment_status") == "completed", F.col("total_amount"))
    return past.groupBy("customer_id").agg(
        F.date_diff(at, F.max("order_date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.coalesce(F.sum(paid), F.lit(0)).cast("decimal(28,2)").alias("monetary"),
        F.min("order_date").alias("first_order_date"))


def delivery_leadtime(orders: DataFrame, shipments: DataFrame, tracking: DataFrame) -> DataFrame:
    """Hours from order to shipment and from shipment to first delivery, per shipment."""
    arrived = (tracking.filter(F.col("status") == "delivered").groupBy("shipment_id")
               .agg(F.min("checkpoint_time").alias("delivered_at")))
    sent = shipments.select("shipment_id", "order_id", "shipment_date")
    done = sent.join(arrived, "shipment_id", "left")
    joined = lookup_join(done, orders.select("order_id", "order_date"), "order_id",
                         spread=["shipment_id"], basis=shipments)

    def hours(a: str, b: str):
        return F.floor((F.unix_timestamp(b) - F.unix_timestamp(a)) / 3600).cast("bigint")
    return joined.select("shipment_id", "order_id",
                         hours("order_date", "shipment_date").alias("hours_to_ship"),
                         hours("shipment_date", "delivered_at").alias("hours_to_deliver"))


def stock_position(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("product_id").agg(
        F.sum("stock_quantity").alias("stock_quantity"),
        F.count(F.lit(1)).alias("places"), F.max("last_updated").alias("last_updated"))


def stock_by_warehouse(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("warehouse_id").agg(
        F.sum("stock_quantity").alias("stock_quantity"), F.count(F.lit(1)).alias("sku_count"))


def account_balance(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Debits minus credits per account, cancelled transactions left out."""
    signed = F.when(F.col("type") == "debit", F.col("amount")).otherwise(-F.col("amount"))
    sums = (transactions.filter(F.col("status") != "cancelled").groupBy("account_id")
            .agg(F.sum(signed).cast("decimal(28,2)").alias("balance"),
                 F.count(F.lit(1)).alias("transaction_count")))
    return lookup_join(sums, accounts.select("account_id", "account_name"), "account_id")
