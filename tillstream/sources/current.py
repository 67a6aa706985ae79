"""Current-state tables kept as Parquet folders.

Month-partitioned tables are merged month by month: only months that hold a changed key are
read and rewritten. Other tables are rewritten as numbered versions. Either way the result is
written completely before anything old is replaced, and a run that dies is finished or redone
by the next one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.scalars import month_label
from tillstream.operators.joins import is_small
from tillstream.operators.latest import latest_per_key
from tillstream.operators.merge import MergeResult, empty_silver, merge_upsert
from tillstream.operators.retention import RETENTION_MONTHS, archive, cutoff, purge_older
from tillstream.session import settle
from tillstream.sources.tables import by_month, with_month_partition
from tillstream.specs import TableSpec

class MergeCounts(NamedTuple):
    rows_inserted: int
    rows_updated: int
    rows_deleted: int


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted(n for n in numbers if exists(spark, f"{path}/version={n}/_SUCCESS"))


def read_current(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The table as it is now; empty if nothing was written yet."""
    columns = spec.silver_schema().names
    if spec.partition_col:
        if not exists(spark, path):
            return empty_silver(spark, spec)
        return spark.read.parquet(path).select(*columns)
    done = versions(spark, path)
    if not done:
        return empty_silver(spark, spec)
    return spark.read.parquet(f"{path}/version={done[-1]}").select(*columns)


def merge_into(spark: SparkSession, path: str, source: DataFrame, spec: TableSpec, now,
               feed: str | None = None, **options) -> MergeCounts:
    """Merge ``source`` into the table below ``path``; ``feed`` also keeps its change feed, one
    folder ``merge=n`` per merge.

    Repeating a call is harmless, whoever else merged in between: rows whose hash is stored are
    kept, and the feed of a merge that died is written anew. Old versions but the last two, which
    a reader may still hold, are removed.
    """
    if spec.partition_col:
        return _merge_months(spark, path, source, spec, now, feed, **options)
    done = versions(spark, path)
    target = (spark.read.parquet(f"{path}/version={done[-1]}") if done
              else empty_silver(spark, spec))
    result = merge_upsert(target, source, spec, now, **options)
    number = done[-1] + 1 if done else 0
    # The merge runs once: all that is needed is read back from its rows.
    staged = settle(result.plan, "merge")
    result = MergeResult(staged, spec, result.columns)
    if feed:
        result.changes().write.mode("overwrite").parquet(f"{feed}/merge={number}")
    result.df.write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in done[:-1]:
        _delete(spark, f"{path}/version={old}")
    return MergeCounts(*result.metrics().first())


def _next_merge(spark: SparkSession, feed: str) -> int:
    """Number of the next feed folder: that of a merge that was not published is used again."""
    fs, p = _fs(spark, feed)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return 1 + max((int(n.removeprefix("merge=")) for n in names if n.startswith("merge=")
                    and exists(spark, f"{feed}/{n}/_PUBLISHED")), default=-1)


def _merge_months(spark: SparkSession, path: str, source: DataFrame, spec: TableSpec, now,
                  feed: str | None, **options) -> MergeCounts:
    key, ts = list(spec.key), spec.partition_col
    _publish(spark, path, spec)          # finish a run that died while publishing
    newest = latest_per_key(source, key, spec.order_col)
    fresh = not exists(spark, path)
    months = with_month_partition(newest.select(ts), ts).select("month")
    if not fresh:
        # A key may have moved to another month: find the months that hold it now.
        keys = newest.select(*key)
        stored = spark.read.parquet(path).select(*key, F.col("month").cast("string"))
        held = stored.join(F.broadcast(keys) if is_small(keys) else keys, key, "left_semi")
        months = months.unionByName(held.select("month"))
    # One short text per month that the batch touches.
    touched = [r["month"] for r in months.distinct().collect()]
    if not touched:
        return MergeCounts(0, 0, 0)
    if fresh:
        target = empty_silver(spark, spec)
    else:
        target = (spark.read.parquet(path)
                  .filter(F.col("month").cast("string").isin(touched)))
    result = merge_upsert(target, newest, spec, now, **options)
    pending = _pending(path)
    place = ""
    if feed:
        result = MergeResult(settle(result.plan, "merge"), spec, result.columns)
        place = f"{feed}/merge={_next_merge(spark, feed)}"
        result.changes().write.mode("overwrite").parquet(place)
    rows = result.plan.select("new.*", "_action")
    by_month(rows, ts).write.mode("overwrite").partitionBy("month").parquet(pending)
    spark.createDataFrame([(m, place) for m in touched], "month string, feed string").coalesce(
        1).write.parquet(f"{pending}/_touched")
    staged = _staged(spark, pending, spec)
    counts = {r["_action"]: r["count"] for r in staged.groupBy("_action").count().collect()}
    _publish(spark, path, spec)
    return MergeCounts(*[counts.get(a, 0) for a in ("insert", "update", "delete")])


def _pending(path: str) -> str:
    return path.rstrip("/") + "_pending"


def _staged(spark: SparkSession, pending: str, spec: TableSpec) -> DataFrame:
    schema = T.StructType([*spec.silver_schema().fields, T.StructField("_action", T.StringType()),
                           T.StructField("month", T.StringType())])
    return spark.read.schema(schema).parquet(pending)


def _publish(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Move a completely staged merge into the table. Safe to repeat after a failure."""
    pending = _pending(path)
    if not exists(spark, f"{pending}/_touched/_SUCCESS"):
        return
    staged = _staged(spark, pending, spec).filter(F.col("_action") != "delete").drop("_action")
    (staged.hint("rebalance", "month").sortWithinPartitions("month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
    filled = {str(r["month"]) for r in staged.select("month").distinct().collect()}
    listed = spark.read.parquet(f"{pending}/_touched").collect()
    for month in {r["month"] for r in listed} - filled:       # every row moved away or was deleted
        _delete(spark, f"{path}/month={month}")
    feed = listed[0]["feed"] if "feed" in listed[0] else ""
    if feed:
        fs, p = _fs(spark, f"{feed}/_PUBLISHED")
        fs.create(p, True).close()
    _delete(spark, pending)


class PurgeCounts(NamedTuple):
    months_dropped: int
    rows_purged: int


def purge_table(spark: SparkSession, path: str, ts: str, as_of,
                months: int = RETENTION_MONTHS, archive_to: str | None = None) -> PurgeCounts:
    """Purge a table laid out by month of ``ts``, reading little of it.

    Months wholly before the cut-off are dropped as folders; only the month holding the
    cut-off is read and rewritten. ``archive_to`` first copies what goes to the cold path.
    """
    label = spark.range(1).select(month_label(cutoff(as_of, months))).first()[0]
    month = F.col("month").cast("string")
    dated = spark.read.parquet(path).filter(month <= label)
    split = purge_older(dated, ts, as_of, months)
    gone = {str(r["month"]): r["count"]
            for r in split.purged.groupBy("month").count().collect()}
    if archive_to and gone:
        archive(split.purged.drop("month"), archive_to, ts, f"{label}-{months}")
    whole = [m for m in gone if m < label]
    if label in gone:
        edge = settle(split.keep.filter(month == label), "purge-edge")
        if edge.isEmpty():
            whole.append(label)
        else:
            (edge.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("month").parquet(path))
    for m in whole:
        _delete(spark, f"{path}/month={m}")
    return PurgeCounts(len(whole), sum(gone.values()))
