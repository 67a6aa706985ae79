"""Streaming sinks and stateful deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.scalars import row_hash
from tillstream.operators.latest import month_floor

WATERMARK = "1 hour"
LONG_TEXT = 64       # a row with more text than this is remembered by its digest, which is half as long


def with_event_time(df: DataFrame, delay: str = WATERMARK, col: str = "ingestion_time") -> DataFrame:
    return df.withWatermark(col, delay)


def dedup_stream(df: DataFrame, key, bounded_state: bool = True) -> DataFrame:
    """One row per (key, hash).

    With bounded state a key is remembered for the watermark delay, then forgotten.
    ``bounded_state=False`` remembers every key for ever.

    Shuffle and state hold the bytes of the hash, half as many as its hexadecimal text, which does not
    compress. A hash that is no such text is kept as it is.
    """
    key = [key] if isinstance(key, str) else list(key)
    plain = F.col("hash").rlike(r"^(?:[0-9a-f]{2})+\z")
    packed = df.select(*[c for c in df.columns if c != "hash"], F.when(plain, F.unhex("hash")).alias("_digest"),
                       F.when(~plain, F.col("hash")).alias("_text"))
    once = (packed.dropDuplicatesWithinWatermark if bounded_state else packed.dropDuplicates)([*key, "_digest", "_text"])
    shown = F.coalesce(F.lower(F.hex("_digest")), F.col("_text")).alias("hash")
    return once.select(*[shown if c == "hash" else F.col(c) for c in df.columns])


def dedup_rows(df: DataFrame, key, columns: Sequence[str], bounded_state: bool = True) -> DataFrame:
    """:func:`dedup_stream` of rows whose ``hash`` is the ``row_hash`` of ``columns``, which is made at the end.

    Rows of a key with equal hashes are those with equal columns, a null and an empty text being alike. So
    shuffle and state hold the columns, and neither holds the hash, which does not compress. Rows with the
    hash's separator in a text, or with much text, are told apart by their digest instead. Which of the two it
    is follows from what is hashed, so repeats go the same way.
    """
    key = [key] if isinstance(key, str) else list(key)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in columns if c not in key]
    texts = [c for c in rest if isinstance(kinds[c], (T.StringType, T.BinaryType))]
    size = {c: F.coalesce(F.length(c), F.lit(0)) for c in texts}

    def some(found: list[Column]) -> Column:
        return reduce(Column.__or__, found, F.lit(False))

    split = [F.coalesce(F.contains(F.col(c), F.lit("|")), F.lit(False))
             for c in texts if isinstance(kinds[c], T.StringType)]
    judged = df.drop("hash").withColumn(
        "_apart", some(split) | (reduce(Column.__add__, size.values(), F.lit(0)) > LONG_TEXT))
    alike = {c: F.when(F.length(c) > 0, F.col(c)) if c in texts else F.col(c) for c in rest}
    empty = some([F.coalesce(F.length(c) == 0, F.lit(False)) for c in texts])
    packed = judged.select(
        *[c for c in judged.columns if c not in (*columns, "_apart")], *key,
        *[F.when(~F.col("_apart"), alike[c]).alias(c) for c in rest],
        F.when(F.col("_apart"), F.unhex(row_hash(judged, columns))).alias("_digest"),
        F.when(F.col("_apart") | empty, F.struct(*rest)).alias("_whole"))
    once = (packed.dropDuplicatesWithinWatermark if bounded_state else packed.dropDuplicates)([*key, *rest, "_digest"])
    back = once.select(*[F.when(F.col("_whole").isNotNull(), F.col(f"_whole.`{c}`")).otherwise(F.col(c)).alias(c)
                         if c in rest else F.col(c) for c in df.columns if c != "hash"])
    return back.withColumn("hash", row_hash(back, columns)).select(*df.columns)


def stream_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                  partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append to a Parquet folder, exactly once per row across restarts."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available_now(df: DataFrame, path: str, checkpoint: str,
                      partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Process everything there is, then stop. Returns the finished query."""
    query = stream_append(df, path, checkpoint, True, partition_by)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped for being behind the watermark."""
    return sum(int(op["numRowsDroppedByWatermark"])
               for progress in query.recentProgress for op in progress["stateOperators"])


def split_late(spark: SparkSession, rows: DataFrame, sink: str, times: str, batch_id: int, key: Sequence[str],
               delay: str = WATERMARK) -> tuple[DataFrame, DataFrame]:
    """Rows of a micro-batch that are new, and those behind the watermark; repeats are in neither.

    The watermark is the newest event time of the earlier batches, less ``delay``; it is read from
    ``times``, where each batch leaves its newest time, so a batch that is run again sees the same one.
    A repeat bears the key of a row in ``sink`` (months and batches as folders) that an earlier batch
    wrote and that is not older than the watermark by more than ``delay``: the span for which a stateful
    stream remembers a key. Rows without an event time are never late.
    """
    at = F.col("ingestion_time")
    if batch_id == 0:
        return rows, rows.filter(F.lit(False))
    newest = (spark.read.schema("newest timestamp, batch long").parquet(times)
              .filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0])
    if newest is None:
        return rows, rows.filter(F.lit(False))
    mark = F.lit(newest) - F.expr(f"interval {delay}")
    behind = F.coalesce(at <= mark, F.lit(False))
    since = mark - F.expr(f"interval {delay}")
    stored = spark.read.schema(f"{rows.schema.toDDL()}, month string, batch long").parquet(sink)
    known = (stored.filter((F.col("batch") < batch_id) & (F.col("month") >= month_floor(since))
                           & ((at >= since) | at.isNull())).select(*key).distinct())
    return rows.filter(~behind).join(known, list(key), "left_anti").select(*rows.columns), rows.filter(behind)
