"""What runs keep between them: number ranges, extracts, bucketed tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.functions.sequences import continue_sequence, reservations, reserve
from tillstream.session import run_dir
from tillstream.sources import tables
from tillstream.sources.extracts import extract_overlap
from tillstream.streaming.log import STREAM_LOG, counted, logged_streams
from tillstream.streaming.runs import run_available_now

DAY = datetime(2025, 1, 10)


def test_ranges_of_runs_at_once_do_not_meet(spark):
    folder = run_dir(spark, "ranges")
    with ThreadPoolExecutor(4) as pool:
        firsts = list(pool.map(lambda n: reserve(spark, folder, f"r{n}", 10 * (n + 1), 5), range(6)))
    spans = sorted((f, f + 10 * (n + 1)) for n, f in enumerate(firsts))
    assert spans[0][0] == 5 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert reserve(spark, folder, "r2", 30) == firsts[2] and reservations(spark, folder).count() == 6
    with pytest.raises(ValueError):
        reserve(spark, folder, "r2", 31)


def test_a_range_being_written_is_waited_for(spark):
    folder = run_dir(spark, "ranges")
    reserve(spark, folder, "a", 3)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{4:020d}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False).close()
    with pytest.raises(RuntimeError, match="unfinished"):
        reserve(spark, folder, "b", 3, patience=0.5)


def test_sequence_goes_on(spark):
    folder = run_dir(spark, "sequence")
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "k string")
    one = continue_sequence(df, "n", ["k"], folder, "one", 7)
    none = continue_sequence(df.limit(0), "n", ["k"], folder, "none", 7)
    two = continue_sequence(df.filter("k = 'a'"), "n", ["k"], folder, "two", 7)
    again = continue_sequence(df, "n", ["k"], folder, "one", 7)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert [tuple(r) for r in one.orderBy("n").collect()] == [(None, 7), ("a", 8), ("a", 9), ("b", 10)]
    assert none.count() == 0
    assert len({r.n for r in two.collect()}) == 2 and min(r.n for r in two.collect()) > 10


def _shown(spark, *rows):
    return spark.createDataFrame([(k, DAY + timedelta(hours=h) if h is not None else None, v) for k, h, v in rows],
                                 "id int, at timestamp, v string")


def _got(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_late_commits_are_extracted(spark):
    folder = run_dir(spark, "extract")
    first = _shown(spark, (1, 0, "a"), (2, 10, ""), (3, None, "n"), (3, None, "n"))
    assert _got(extract_overlap(first, "at", folder, 0, "6 hours")) == [(1, "a"), (2, ""), (3, "n")]
    # 4 is late within the overlap, 5 later than that; 2 has changed without a new time; 6 is new
    more = first.unionByName(_shown(spark, (4, 5, "late"), (5, 3, "lost"), (2, 10, None), (6, 11, "new")))
    for _ in range(2):
        got = extract_overlap(more, "at", folder, 1, "6 hours")
        assert sorted((r.id, r.v or "-") for r in got.collect()) == [(2, "-"), (4, "late"), (6, "new")]
    assert extract_overlap(more, "at", folder, 2, "6 hours").count() == 0
    assert _got(extract_overlap(more.limit(0), "at", folder, 3)) == []
    assert _got(extract_overlap(_shown(spark, (7, 12, "x")), "at", folder, 4)) == [(7, "x")]


def test_nothing_at_first(spark):
    folder, rows = run_dir(spark, "extract"), _shown(spark, (1, 0, "a"))
    assert extract_overlap(rows.limit(0), "at", folder, 0).count() == 0
    assert _got(extract_overlap(rows, "at", folder, 1)) == [(1, "a")]


def test_bucketed_join_shuffles_nothing(spark):
    base = run_dir(spark, "bucketed")
    a = spark.range(1000).withColumn("x", F.col("id") % 7)
    b = spark.range(500, 2000).selectExpr("id", "id * 2 as y")
    left, right, other = (f"{n}_{base[-12:]}" for n in "abc")
    tables.save_bucketed(a, left, "id", 4, f"{base}/a")
    tables.save_bucketed(b, right, "id", 4, f"{base}/b")
    tables.save_bucketed(b, other, "id", 8, f"{base}/c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.bucketed_join(spark, left, right, "id").groupBy("id").agg(F.sum("y").alias("y"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in (other, left):
        with pytest.raises(ValueError):
            tables.bucketed_join(spark, left, bad, "id" if bad == other else "x")
    for name in (left, right, other):
        spark.sql(f"drop table {name}")


def _numbers(spark, base, n):
    spark.range(n).write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 3).parquet(f"{base}/in")


def test_streams_are_logged_by_batch(spark):
    base = run_dir(spark, "stream-log")
    source = _numbers(spark, base, 1000)
    with logged_streams(spark, f"{base}/log"):
        run_available_now(counted(source.filter("id % 4 = 0")), f"{base}/out", f"{base}/state")
    log = spark.read.schema(STREAM_LOG).parquet(f"{base}/log").orderBy("batch_id").collect()
    assert [r.batch_id for r in log] == list(range(len(log))) and len(log) > 1
    assert sum(r.rows_in for r in log) == 1000 and sum(r.rows_out for r in log) == 250
    assert {r.status for r in log} == {"success"} and all(r.duration_ms > 0 and r.started_at for r in log)


def test_a_failed_stream_is_logged(spark):
    base = run_dir(spark, "stream-log")
    source = _numbers(spark, base, 100)
    with logged_streams(spark, f"{base}/log"):
        with pytest.raises(Exception):
            run_available_now(source.filter(F.raise_error(F.lit("broken")).isNull()), f"{base}/out", f"{base}/state")
    log = spark.read.schema(STREAM_LOG).parquet(f"{base}/log").collect()
    assert [(r.status, r.batch_id) for r in log] == [("failed", 0)] and "broken" in log[0].error
