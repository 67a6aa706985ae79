"""Change feed, audit rows and the run log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.scalars import row_hash
from tillstream.operators.joins import gather
from tillstream.operators.merge import feed_rows

ACTIONS = {"insert": "INSERT", "update_postimage": "UPDATE", "delete": "DELETE"}


def hashed(state: DataFrame, key) -> DataFrame:
    """A state with the ``hash`` of its columns, gathered by ``key`` first: of two such states
    :func:`change_feed` moves each row once, and the hash, which does not compress, not at all."""
    moved = gather(state, key)
    return moved.withColumn("hash", row_hash(moved, state.columns))


def change_feed(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """Difference of two states, both unique on ``key``: inserts, deletes, update images."""
    key = [key] if isinstance(key, str) else list(key)
    columns = new.columns
    o = old.select(*key, F.struct(*columns).alias("old"))
    n = new.select(*key, F.struct(*columns).alias("new"))
    action = (F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete")
              .when(~F.col("old.hash").eqNullSafe(F.col("new.hash")), "update"))
    changed = (o.join(n, key, "full_outer").select("old", "new", action.alias("_action"))
               .filter(F.col("_action").isNotNull()))
    return feed_rows(changed, columns)


def audit_rows(feed: DataFrame, user: str | Column, object_name: str, at: str | Column,
               query: str | Column | None = None) -> DataFrame:
    """One audit row per inserted, updated or deleted row of a change feed."""
    def column(value, kind: str = "string") -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast(kind)
    label = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    kept = feed.filter(F.col("_change_type").isin(*ACTIONS))
    rest = [c for c in feed.columns if c != "_change_type"]
    return kept.select(
        column(at, "timestamp").alias("log_time"),
        column(user).alias("user_name"),
        label[F.col("_change_type")].alias("action_type"),
        F.lit("TABLE").alias("object_type"),
        F.lit(object_name).alias("object_name"),
        column(query).alias("query"),
        *rest)


def consolidate_audit(logs: dict[str, DataFrame]) -> DataFrame:
    """Audit logs of several systems as one frame, tagged by ``origin``."""
    tagged = [df.withColumn("origin", F.lit(tag)) for tag, df in logs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


RUN_LOG = ("run_id string, job string, task string, user string, status string, "
           "started_at timestamp, ended_at timestamp, duration_ms long, "
           "rows_in long, rows_out long, error string")


def run_logged(
    spark: SparkSession,
    job: str,
    task: str,
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame], None],
    log_path: str,
) -> dict:
    """Run ``sink(transform(source))`` and append one row about it to the run log.

    Row counts come from observations of the running query, not from extra passes. A failure is
    logged, then raised.
    """
    seen, made = Observation(), Observation()
    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    status, failure = "success", None
    try:
        watched = source.observe(seen, F.count(F.lit(1)).alias("n"))
        sink(transform(watched).observe(made, F.count(F.lit(1)).alias("n")))
    except Exception as exc:
        status, failure = "failed", exc
    ok = status == "success"
    row = {
        "run_id": uuid.uuid4().hex, "job": job, "task": task,
        "user": spark.sparkContext.sparkUser(), "status": status, "started_at": started,
        "ended_at": datetime.now(timezone.utc).replace(tzinfo=None),
        "duration_ms": int((time.monotonic() - clock) * 1000),
        "rows_in": seen.get["n"] if ok else None, "rows_out": made.get["n"] if ok else None,
        "error": f"{type(failure).__name__}: {failure}" if failure else None,
    }
    spark.createDataFrame([tuple(row.values())], RUN_LOG).write.mode("append").parquet(log_path)
    if failure:
        raise failure
    return row


def last_run(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("ended_at"), F.desc("run_id")).limit(1)
