"""Report views over the current tables. Each returns a lazy frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import lookup_join, without_children
from tillstream.operators.latest import active


def product_view(skus: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Catalogue of SKUs whose product and category are active."""
    cats = active(categories).select("category_id", F.col("name").alias("category_name"))
    prods = lookup_join(
        active(products).select("product_id", F.col("name").alias("product_name"), "category_id"),
        cats, "category_id", spread=["product_id"])
    return lookup_join(
        skus.select("sku_id", "sku", "product_id", "color", "size", "price", "created_at"),
        prods, "product_id", spread=["sku_id"],
    ).select("sku_id", "sku", "product_id", "product_name", "category_id", "category_name",
             "color", "size", "price", "created_at")


def sales_report_view(orders: DataFrame, customers: DataFrame, items: DataFrame,
                      skus: DataFrame, products: DataFrame, payment_types: DataFrame,
                      ordered: bool = False) -> DataFrame:
    """One row per sold item with its order, customer, product and payment type.

    ``item_count`` counts the report rows of the order. It is a grouped count joined back, not
    a window: a window would pull a very large order into one task.
    """
    lines = items.select("order_item_id", "order_id", "product_id", "sku_id",
                         F.col("unit_price").alias("price"), "quantity")
    lines = lookup_join(lines, skus.select("sku_id", "sku"), "sku_id",
                        spread=["order_item_id"])
    lines = lookup_join(lines, products.select("product_id", F.col("name").alias("product_name")),
                        "product_id", spread=["order_item_id"], basis=items)
    counts = lines.groupBy("order_id").agg(F.count("order_item_id").alias("item_count"))

    buyers = customers.filter(F.col("created_at").isNotNull()).select(
        "customer_id", F.col("name").alias("customer_name"))
    heads = lookup_join(
        orders.select("order_id", "order_date", "customer_id", "total_amount",
                      "shipping_address", "payment_status", "payment_type_id"),
        payment_types.select("payment_type_id", F.col("name").alias("payment_types")),
        "payment_type_id", spread=["order_id"])
    heads = lookup_join(heads, buyers, "customer_id", spread=["order_id"], basis=orders)
    heads = heads.join(counts, "order_id")
    report = lookup_join(lines, heads, "order_id", spread=["order_item_id"], basis=items).select(
        "order_id", "order_date", "customer_id", "customer_name", "total_amount",
        "shipping_address", "payment_status", "payment_types", "sku", "product_name", "price",
        "quantity", "item_count")
    return report.orderBy(F.desc("order_date"), "order_id", "sku") if ordered else report


def shipping_report_view(shipments: DataFrame, warehouses: DataFrame,
                         tracking: DataFrame) -> DataFrame:
    """Shipments from active warehouses, one row per checkpoint (or one without any)."""
    houses = active(warehouses).select("warehouse_id", F.col("name").alias("warehouse_name"),
                                       "location")
    sent = lookup_join(shipments, houses, "warehouse_id", spread=["shipment_id"])
    stops = tracking.select("shipment_id", "checkpoint_time",
                            F.col("location").alias("checkpoint_location"))
    # A left join could not split the checkpoints of a hot shipment, so the two cases of the
    # left join are built apart: checkpoints with their shipment, shipments without any.
    tracked = lookup_join(stops, sent, "shipment_id",
                          spread=["checkpoint_time", "checkpoint_location"], basis=tracking)
    bare = without_children(sent, stops, "shipment_id")
    return tracked.unionByName(bare, allowMissingColumns=True).select(
        "shipment_id", "order_id", "warehouse_id", "warehouse_name", "location",
        "shipment_date", "checkpoint_time", "checkpoint_location", "status")


def inventory_report_view(inventory: DataFrame, warehouses: DataFrame) -> DataFrame:
    houses = active(warehouses).select("warehouse_id", F.col("name").alias("warehouse_name"),
                                       "location")
    return lookup_join(inventory, houses, "warehouse_id", spread=["inventory_id"]).select(
        "sku_id", "product_id", "stock_quantity", "last_updated", "warehouse_id",
        "warehouse_name", "location")


def skus_by_price(skus: DataFrame, low, high, ordered: bool = True) -> DataFrame:
    """Active SKUs in a price range, cheapest first."""
    found = active(skus).filter(F.col("price").between(low, high)).select(
        "sku_id", "sku", "product_id", "color", "size", "price", "created_at")
    return found.orderBy("price", "sku_id") if ordered else found
