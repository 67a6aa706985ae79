"""Reading and writing tables: appends, month layout, extracts, schema evolution."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.scalars import month_label
from tillstream.operators.joins import is_small
from tillstream.specs import TableSpec


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder where ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


SPREAD_FLOOR = 256 * 1024     # below this one task is as good as many


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input with too few splits (a lone small file) dealt out to all cores, ahead
    of work that is heavy per row. An input with splits enough is left as it is, and so is one that
    is shuffled anyway: its partitions are known only by running it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if (is_small(df, SPREAD_FLOOR)
            or df._jdf.queryExecution().executedPlan().nodeName() == "AdaptiveSparkPlan"
            or df._jdf.rdd().getNumPartitions() * 2 > cores):
        return df
    return df.repartition(cores)


def batch_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def with_month_partition(df: DataFrame, ts: str, name: str = "month") -> DataFrame:
    """Adds the month label; rows without a time share the label ``none``."""
    return df.withColumn(name, F.coalesce(month_label(ts), F.lit("none")))


def next_month_bounds(as_of: date) -> tuple[str, date, date]:
    """Label and half-open bounds of the month after ``as_of``."""
    year, month = divmod(as_of.year * 12 + as_of.month, 12)
    start = date(year, month + 1, 1)
    year, month = divmod(start.year * 12 + start.month, 12)
    return f"{start:%Y%m}", start, date(year, month + 1, 1)


def by_month(df: DataFrame, ts: str) -> DataFrame:
    """Rows gathered by month for writing: few files per month, and a month too large for one
    task is split (rebalance), whatever its share of the table. Sorting by time within a file
    lets later reads skip row groups."""
    return (with_month_partition(df, ts).hint("rebalance", "month")
            .sortWithinPartitions("month", ts))


def write_partitioned(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> None:
    """Write one folder per month of ``ts``, replacing only the months present in ``df``."""
    (by_month(df, ts).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(path))


def hash_bucket(col: str, buckets: int = 4) -> Column:
    """From the md5 of the value's text, so that any engine computes the same bucket."""
    head = F.substring(F.md5(F.col(col).cast("string").cast("binary")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % buckets).cast("int")


def repartition_by_hash(df: DataFrame, col: str, buckets: int = 4) -> DataFrame:
    """Hash sub-partition column (``bucket``) for layouts below the month."""
    return df.withColumn("bucket", hash_bucket(col, buckets))


def write_month_buckets(df: DataFrame, path: str, ts: str, col: str, buckets: int = 4,
                        mode: str = "overwrite") -> None:
    """Write one folder per month of ``ts`` and, below it, one per bucket of ``col``."""
    rows = repartition_by_hash(with_month_partition(df, ts), col, buckets)
    (rows.hint("rebalance", "month", "bucket").sortWithinPartitions("month", "bucket", ts)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "bucket").parquet(path))


def save_bucketed(df: DataFrame, table: str, col: str, buckets: int, path: str | None = None) -> None:
    """Catalog table bucketed and sorted by ``col``: later joins on it need no shuffle.

    Each bucket is written by one task, to one file. ``path`` puts the files there, else in the warehouse.
    """
    writer = df.repartition(buckets, col).write.mode("overwrite").bucketBy(buckets, col).sortBy(col)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucketed_join(spark: SparkSession, left: str, right: str, on: str, how: str = "inner") -> DataFrame:
    """Join of two catalog tables that :func:`save_bucketed` wrote with equal buckets of ``on``: neither side
    is shuffled. Tables laid out in another way are refused, as they would be shuffled silently.

    A bucket is one task of the join, so the buckets must be as many as the larger table fills tasks. For a
    key that holds more rows than a task should, use ``joins.lookup_join``.
    """
    layouts = [_buckets(spark, t) for t in (left, right)]
    if layouts[0] != layouts[1] or layouts[0][1] != [on]:
        raise ValueError(f"not bucketed alike on {on}: {left} {layouts[0]}, {right} {layouts[1]}")
    return spark.read.table(left).join(spark.read.table(right), on, how)


def _buckets(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a catalog table; (0, []) for one without."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {table}").collect()}
    columns = said.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return int(said.get("Num Buckets", 0)), [c.strip() for c in columns.split(",") if c.strip()]


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` first, missing ones as null, then columns only ``df`` has."""
    known = set(schema.names)
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in schema.fields],
        *[c for c in df.columns if c not in known])


def read_evolving(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder whose older files lack newer columns."""
    return align_to(spark.read.option("mergeSchema", "true").parquet(path), schema)


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Delete all rows; the folder and its schema stay."""
    spark.createDataFrame([], schema).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(path)


def profile_table(df: DataFrame, order_col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.min(order_col).alias("min_value"), F.max(order_col).alias("max_value"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def to_drop(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows in the form of the daily file drop."""
    cols = []
    for field in spec.drop_schema().fields:
        col, kind = F.col(field.name), spec.type_of(field.name)
        text = F.base64(col) if isinstance(kind, T.BinaryType) else col.cast(field.dataType)
        cols.append(text.alias(field.name))
    return df.select(*cols)


def extract_full(df: DataFrame, folder: str, run_date: date | datetime) -> str | None:
    """Write the whole frame to the dated drop folder; nothing is written for no rows."""
    if df.isEmpty():
        return None
    path = f"{folder.rstrip('/')}/dt={run_date:%Y%m%d}"
    df.write.mode("overwrite").parquet(path)
    return path


def extract_incremental(df: DataFrame, ts_col: str, watermark) -> tuple[DataFrame, DataFrame]:
    """Rows newer than ``watermark``, and the one-row frame of the next watermark."""
    bound = F.lit(watermark).cast("timestamp")
    new = df.filter(F.col(ts_col) > bound) if watermark is not None else df
    newest = new.agg(F.coalesce(F.max(ts_col), bound).alias("high_watermark"))
    return new, newest


def jdbc_options(url: str, table: str, column: str, lower, upper, partitions: int,
                 **more: str) -> dict[str, str]:
    """Options of a parallel table read: one query per range of ``column``."""
    return {"url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
            "fetchsize": "10000", **more}


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def file_stream(spark: SparkSession, folder: str, schema: T.StructType,
                max_files: int | None = None) -> DataFrame:
    """New Parquet files below ``folder`` (and its dated sub-folders), each read once."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)
