"""Deduplication and the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TIEBREAK = ("ingestion_time", "hash", "transaction_type", "connector", "source")


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def first_per_key(df: DataFrame, key, order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    Spark prunes each map task to one row per key before the shuffle (window group limit),
    so a hot key costs one row per task, not its whole group.
    """
    w = Window.partitionBy(*_names(key)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, key, order_col: str = "updated_at",
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key under a total order, so that reruns give the same row."""
    if tiebreak is None:
        tiebreak = [c for c in _TIEBREAK if c in df.columns and c != order_col]
        if "hash" not in tiebreak:
            tiebreak += [c for c in df.columns
                         if c not in (*tiebreak, *_names(key), order_col)]
    order = [F.col(c).desc_nulls_last() for c in (order_col, *tiebreak)]
    return first_per_key(df, key, order)


def dedup_batch(df: DataFrame, key) -> DataFrame:
    """One row per (key, hash), the first one ingested."""
    rest = [c for c in _TIEBREAK if c in df.columns and c != "hash"]
    order = [F.col(c).asc_nulls_last() for c in rest] or [F.col("hash").asc()]
    return first_per_key(df, [*_names(key), "hash"], order)


def dedup_hash(df: DataFrame) -> DataFrame:
    """One row per hash alone. Use only where the hash covers the key."""
    return dedup_batch(df, [])


def month_floor(bound) -> Column:
    """The label of the month that ``bound`` lies in; the label ``none`` sorts after all months."""
    return F.date_format(bound, "yyyyMM")


def recent(df: DataFrame, as_of, days: int = 14, col: str = "ingestion_time") -> DataFrame:
    """Rows since midnight ``days`` days before ``as_of``.

    The bound is a constant, so it reaches the scan. In a table laid out by month of ``col``
    (column ``month``) it also skips the older folders.
    """
    bound = F.date_sub(F.lit(as_of).cast("timestamp").cast("date"), days).cast("timestamp")
    if "month" in df.columns:
        df = df.filter(F.col("month").cast("string") >= F.date_format(bound, "yyyyMM"))
    return df.filter(F.col(col) >= bound)


def active(df: DataFrame, col: str = "deleted_at") -> DataFrame:
    return df.filter(F.col(col).isNull())


def latest_child(parent: DataFrame, child: DataFrame, on: str, order: Sequence[str],
                 columns: dict[str, str]) -> DataFrame:
    """Set parent columns from the newest child row: ``{parent column: child column}``."""
    newest = first_per_key(child.select(on, *dict.fromkeys([*order, *columns.values()])), on,
                           [F.col(c).desc_nulls_last() for c in order])
    newest = newest.select(on, F.lit(True).alias("_found"),
                           *[F.col(c).alias(f"_child_{p}") for p, c in columns.items()])
    joined = parent.join(newest, on, "left")
    return joined.select(*[
        F.when(F.col("_found"), F.col(f"_child_{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in parent.columns])


def watermark_value(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("high_watermark"))
