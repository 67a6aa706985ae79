"""Whole flows: messages or file drops to bronze, bronze to silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.scalars import row_hash
from tillstream.operators.decode import KEPT_OPS, decode_cdc, decode_drop, judge_cdc, judge_drop
from tillstream.operators.joins import gather
from tillstream.operators.latest import dedup_batch, recent
from tillstream.operators.merge import MergeResult, merge_upsert
from tillstream.sources.cdc import cdc_batch, cdc_stream
from tillstream.sources.current import merge_into
from tillstream.sources.tables import by_month, file_stream, with_month_partition
from tillstream.specs import TableSpec
from tillstream.streaming.runs import (
    WATERMARK, dedup_rows, dedup_stream, run_available_now, split_late, with_event_time)


def bronze_stream(spark: SparkSession, spec: TableSpec, source: str | dict, sink: str,
                  checkpoint: str, delay: str = WATERMARK, max_files: int | None = None,
                  bounded_state: bool = True):
    """Change messages to the bronze folder, laid out by month of ingestion."""
    rows = decode_cdc(cdc_stream(spark, source, max_files), spec)
    unique = dedup_rows(with_event_time(rows, delay), spec.key, spec.columns, bounded_state)
    return run_available_now(with_month_partition(unique, "ingestion_time"), sink, checkpoint,
                             ("month",))


def bronze_replay(spec: TableSpec, messages: DataFrame, **options) -> DataFrame:
    """The same flow over a bounded set of messages."""
    rows = decode_cdc(messages, spec, **options)
    return dedup_batch(rows if options.get("hash_mode") == "raw" else gather_keys(rows, spec), spec.key)


def gather_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with all versions of a key on one task, hashed there.

    The hash is half of a packed row and follows from the other columns, so it is not moved. Nothing is sorted
    ahead of the shuffle, and what goes on by key (newest row, merge) needs no other one. A key with more
    versions than a task should hold makes one long, spilling task.
    """
    moved = gather(rows.drop("hash"), spec.key)
    return moved.withColumn("hash", row_hash(moved, spec.columns)).select(*rows.columns)


def bronze_replay_from(spark: SparkSession, spec: TableSpec, source: str | dict) -> DataFrame:
    return bronze_replay(spec, cdc_batch(spark, source))


def bronze_files(spark: SparkSession, spec: TableSpec, folder: str, sink: str, checkpoint: str,
                 now: Column | None = None, hash_mode: str = "typed", delay: str = WATERMARK):
    """New files of a drop folder to the bronze folder."""
    drops = file_stream(spark, folder, spec.drop_schema())
    rows = decode_drop(drops, spec, F.current_timestamp() if now is None else now, hash_mode,
                       source=F.col("_metadata.file_path"))
    unique = dedup_stream(with_event_time(rows, delay), spec.key)
    return run_available_now(unique, sink, checkpoint)


def bronze_stream_aside(spark: SparkSession, spec: TableSpec, source: str | dict, sink: str, checkpoint: str,
                        aside: str, delay: str = WATERMARK, max_files: int | None = None):
    """:func:`bronze_stream` that loses nothing: messages that cannot be read go to ``aside``/rejects
    (value, reason), rows behind the watermark to ``aside``/late (bronze columns)."""
    judged = judge_cdc(cdc_stream(spark, source, max_files), spec, KEPT_OPS)
    return _run_aside(judged, spec, sink, checkpoint, aside, delay)


def bronze_files_aside(spark: SparkSession, spec: TableSpec, folder: str, sink: str, checkpoint: str, aside: str,
                       now: Column | None = None, hash_mode: str = "typed", delay: str = WATERMARK,
                       max_files: int | None = None):
    """:func:`bronze_files`, laid out by month, with unreadable rows (as JSON) and late ones kept."""
    drops = file_stream(spark, folder, spec.drop_schema(), max_files)
    judged = judge_drop(drops, spec, F.current_timestamp() if now is None else now, hash_mode,
                        F.col("_metadata.file_path"))
    return _run_aside(judged, spec, sink, checkpoint, aside, delay)


def _run_aside(judged: DataFrame, spec: TableSpec, sink: str, checkpoint: str, aside: str, delay: str):
    """One parse, three sinks in one micro-batch.

    Each batch writes folders of its own (``batch=id``) and replaces them when it is run again after a
    failure, so that each row is in one of them once. What it needs to know of earlier batches it reads
    from tables they wrote: the newest event time of each, and the bronze rows young enough to repeat.
    """
    names = spec.bronze_schema().names

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()          # parsed once, read by each sink
        try:
            good = batch.filter("reason is null").select(*names)
            fresh, late = split_late(spark, good, sink, f"{checkpoint}/times", batch_id, [*spec.key, "hash"], delay)
            _put_batch(batch.filter("reason is not null").select("value", "reason"), f"{aside}/rejects", batch_id)
            _put_batch(late, f"{aside}/late", batch_id)
            rows = dedup_batch(fresh, spec.key).withColumn("batch", F.lit(batch_id))
            (by_month(rows, "ingestion_time").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("month", "batch").parquet(sink))
            _put_batch(good.agg(F.max("ingestion_time").alias("newest")), f"{checkpoint}/times", batch_id)
        finally:
            batch.unpersist()

    query = (judged.writeStream.foreachBatch(split).option("checkpointLocation", f"{checkpoint}/query")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def _put_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def silver_load(spec: TableSpec, bronze: DataFrame, silver: DataFrame, as_of, now=None,
                days: int = 14, **options) -> MergeResult:
    """Scheduled load: look-back window, newest row per key, merge."""
    return merge_upsert(silver, recent(bronze, as_of, days), spec, as_of if now is None else now,
                        **options)


def silver_stream(spark: SparkSession, spec: TableSpec, bronze: str, silver: str,
                  checkpoint: str, now=None, max_files: int | None = None):
    """Keep silver current from the bronze folder, one merge per micro-batch.

    A batch replayed after a failure, or by a query started anew, gives the same table: rows that
    are merged already have an equal hash and are kept.
    """
    reader = spark.readStream.schema(spec.bronze_schema())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        stamp = now if now is not None else batch.sparkSession.sql(
            "select current_timestamp()").first()[0]
        batch.persist()          # read several times by one merge
        try:
            merge_into(batch.sparkSession, silver, batch, spec, stamp)
        finally:
            batch.unpersist()

    query = (reader.parquet(bronze).writeStream.foreachBatch(merge_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
