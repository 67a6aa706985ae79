"""Summary tables kept current by the change feed, without reading the whole table again.

A summary is stored as sums and counts per group. Each row of a feed counts as plus (insert,
postimage) or minus (delete, preimage); the rows are summed map-side per group and meet the stored sums in
one exchange, so the work grows with the changes, not with the table. The result equals a full recompute.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.scalars import line_amount, month_label
from tillstream.operators.joins import lookup_join

SIGNS = {"insert": 1, "update_postimage": 1, "delete": -1, "update_preimage": -1}
WIDE = "decimal(38,2)"


@dataclass(frozen=True)
class Summary:
    """Groups (name -> expression), additive measures (name -> expression) and the rows that count."""
    groups: dict[str, Column]
    measures: dict[str, Column]
    where: Column | None = None

    def full(self, table: DataFrame) -> DataFrame:
        """The stored form, from all rows."""
        return self._added(self._signed(table.withColumn("_sign", F.lit(1))))

    def delta(self, feed: DataFrame) -> DataFrame:
        """The stored form of what a feed (``_change_type`` + columns) adds and takes away."""
        return self._added(self._signed(self._feed(feed)))

    def _feed(self, feed: DataFrame) -> DataFrame:
        sign = F.create_map(*[F.lit(x) for pair in SIGNS.items() for x in pair])[F.col("_change_type")]
        return feed.withColumn("_sign", sign).filter("_sign is not null")

    def _values(self) -> list[str]:
        return [c for n in self.measures for c in (n, f"_n_{n}")] + ["_rows"]

    def _signed(self, rows: DataFrame) -> DataFrame:
        """Each row that counts, in the stored form."""
        rows = rows if self.where is None else rows.filter(self.where)
        sign = F.col("_sign").cast("bigint")
        parts = [e.alias(n) for n, e in self.groups.items()]
        for n, e in self.measures.items():
            # How many values a sum is made of: a sum of none is null, not zero.
            wide = e.cast(WIDE)
            parts += [F.when(sign > 0, wide).otherwise(-wide).alias(n),
                      F.when(e.isNotNull(), sign).otherwise(0).alias(f"_n_{n}")]
        return rows.select(*parts, sign.alias("_rows"))

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.groups).agg(
            *[F.sum(c).cast(WIDE if c in self.measures else "bigint").alias(c) for c in self._values()])

    def apply(self, stored: DataFrame, delta: DataFrame) -> DataFrame:
        """The stored form after the changes; groups without rows are gone. Both sides have one row per
        group, so no group is large; null groups are groups too."""
        columns = [*self.groups, *self._values()]
        return self._added(stored.select(*columns).unionByName(delta.select(*columns))).filter("_rows > 0")

    def update(self, stored: DataFrame, feed: DataFrame) -> DataFrame:
        """The stored form after a feed: :func:`apply` of its delta, but rows that change and stored sums
        pass one exchange together."""
        return self.apply(stored, self._signed(self._feed(feed)))

    def shown(self, stored: DataFrame) -> DataFrame:
        """Groups, sums and ``row_count``."""
        return stored.select(
            *self.groups, *[F.when(F.col(f"_n_{n}") > 0, F.col(n)).alias(n) for n in self.measures],
            F.col("_rows").alias("row_count"))


def payment_revenue() -> Summary:
    """Completed revenue per month and payment type."""
    return Summary({"month": month_label("order_date"), "payment_type_id": F.col("payment_type_id")},
                   {"revenue": F.col("total_amount")}, F.col("payment_status") == "completed")


def product_revenue() -> Summary:
    """Item revenue and units per month and product, from which those of categories are added up."""
    return Summary({"month": month_label("order_date"), "product_id": F.col("product_id")},
                   {"revenue": line_amount(), "units": F.col("quantity")})


def balances() -> Summary:
    """Debits minus credits per account, cancelled transactions left out."""
    signed = F.when(F.col("type") == "debit", F.col("amount")).otherwise(-F.col("amount"))
    return Summary({"account_id": F.col("account_id")}, {"balance": signed}, F.col("status") != "cancelled")


def revenue_by_payment_type(stored: DataFrame, payment_types: DataFrame) -> DataFrame:
    """:func:`gold.revenue_by_payment_type` from the stored sums."""
    names = payment_types.select("payment_type_id", F.col("name").alias("payment_type"))
    return lookup_join(payment_revenue().shown(stored), names, "payment_type_id").select(
        "month", "payment_type", F.col("revenue").cast("decimal(28,2)").alias("revenue"),
        F.col("row_count").alias("order_count"))


def revenue_by_category(stored: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """:func:`gold.revenue_by_category` from the stored sums per product, of which there are few."""
    per_product = lookup_join(product_revenue().shown(stored), products.select("product_id", "category_id"), "product_id")
    sums = per_product.groupBy("month", "category_id").agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"), F.sum("units").cast("bigint").alias("units"))
    names = categories.select("category_id", F.col("name").alias("category"))
    return lookup_join(sums, names, "category_id").select("month", "category", "revenue", "units")


def account_balance(stored: DataFrame, accounts: DataFrame) -> DataFrame:
    """:func:`gold.account_balance` from the stored sums."""
    shown = balances().shown(stored).select(
        "account_id", F.col("balance").cast("decimal(28,2)").alias("balance"), F.col("row_count").alias("transaction_count"))
    return lookup_join(shown, accounts.select("account_id", "account_name"), "account_id")
