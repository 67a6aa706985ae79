"""Sums kept current by feeds equal sums of all rows; checksums by range find every difference."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tillstream import session
from tillstream.functions.scalars import row_hash
from tillstream.operators import audit, reconcile
from tillstream.plans.incremental import Summary

ROWS = "id int, g string, amount decimal(12,2), live boolean"


def state(spark, rng, n):
    rows = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, "1.25", "-2.00", "7.50"]), rng.random() < 0.8)
            for i in rng.sample(range(60), n)]
    df = spark.createDataFrame(rows, "id int, g string, amount string, live boolean").withColumn(
        "amount", F.col("amount").cast("decimal(12,2)"))
    return df.withColumn("hash", row_hash(df, df.columns))


def test_a_chain_of_feeds_equals_a_recompute(spark):
    rng = random.Random(1)
    summary = Summary({"g": F.col("g")}, {"total": F.col("amount")}, F.col("live"))
    now = state(spark, rng, 40)
    stored = summary.full(now)
    for n in (50, 5, 30, 0):
        after = state(spark, rng, n)
        stored = summary.apply(stored, summary.delta(audit.change_feed(now, after, "id")))
        now = after
        got, want = summary.shown(stored), summary.shown(summary.full(now))
        key = lambda r: (str(r[0]), r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_a_feed_of_states_hashed_where_they_are_joined(spark):
    """Rows pass one exchange without their hash, and another one with the stored sums."""
    rng = random.Random(2)
    summary = Summary({"g": F.col("g")}, {"total": F.col("amount")}, F.col("live"))
    before, after = (state(spark, rng, n).drop("hash") for n in (40, 45))
    feed = audit.change_feed(audit.hashed(before, "id"), audit.hashed(after, "id"), "id")
    stored = summary.update(session.settle(summary.full(before), "sums"), feed)
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 3 and text.count("Exchange hashpartitioning(id") == 2
    assert "sha2(" in text and "sha2(" not in text[text.rindex("Exchange hashpartitioning(id"):]
    key = lambda r: (str(r[0]), r)
    got, want = (sorted(map(tuple, summary.shown(s).collect()), key=key) for s in (stored, summary.full(after)))
    assert got == want
    old = summary.apply(summary.full(before), summary.delta(feed))
    assert sorted(map(tuple, summary.shown(old).collect()), key=key) == want


def test_only_ranges_that_differ_are_joined(spark):
    a = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("hash"))
    b = a.filter("id <> 17").withColumn("hash", F.when(F.col("id") == 99, None).otherwise(F.col("hash"))).unionByName(
        spark.range(50_000, 50_001).select("id", F.lit("new").alias("hash")))
    ranges = reconcile.differing_ranges(reconcile.digests(a, "id"), reconcile.digests(b, "id"))
    assert ranges.count() == 3
    want = {(r["id"], r["status"]) for r in reconcile.reconcile(a, b, "id").collect()}
    got = {(r["id"], r["status"]) for r in reconcile.reconcile_digests(a, b, "id").collect()}
    assert got == want == {(17, "missing"), (99, "different"), (50_000, "extra")}
    assert reconcile.differing_ranges(reconcile.digests(a, "id"), reconcile.digests(a, "id")).count() == 0
    assert reconcile.reconcile_digests(a, a.filter("id < 0"), "id").count() == 20_000
    assert reconcile.reconcile_digests(a.filter("id < 0"), a.filter("id < 0"), "id").count() == 0


def test_sums_of_one_range_do_not_cancel_out(spark):
    """Two rows that swap their hashes change the checksum of their ranges."""
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, hash string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "id int, hash string")
    assert reconcile.reconcile_digests(a, b, "id").count() == 2
