"""Business ids and gap-free numbering without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.session import settle

_ROW_BITS = 33       # monotonically_increasing_id: partition above, row below


def business_id(prefix: str, width: int, number: Column) -> Column:
    """``prefix`` + number, zero-padded to ``width``; a longer number is never cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def assign_sequence(df: DataFrame, column: str, order_by: Sequence[str], start: int = 1,
                    partitions: int | None = None) -> DataFrame:
    """Number the rows ``start, start+1, …`` in the order of ``order_by``.

    The rows are range-partitioned on all order columns, so equal leading values still spread.
    The partitioned rows are written to a table, because range bounds come from a sample and
    may differ when computed again. Only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(
        df.repartitionByRange(partitions, *[F.col(c) for c in order_by])
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id()), "sequence")
    part = F.shiftright("_at", _ROW_BITS).cast("int")
    sizes = {r["p"]: r["n"] for r in
             ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], start
    for p in sorted(sizes):
        offsets.append((p, total))
        total += sizes[p]
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if not offsets:
        return ranged.withColumn(column, F.lit(start).cast("bigint")).drop("_at")
    base = spark.createDataFrame(offsets, "_part int, _base long")
    return (ranged.withColumn("_part", part).join(F.broadcast(base), "_part")
            .withColumn(column, F.col("_base") + row).drop("_at", "_part", "_base"))


def assign_business_id(df: DataFrame, column: str, prefix: str, width: int,
                       order_by: Sequence[str], start: int = 1) -> DataFrame:
    numbered = assign_sequence(df, "_number", order_by, start)
    return (numbered.withColumn(column, business_id(prefix, width, F.col("_number")))
            .drop("_number"))
