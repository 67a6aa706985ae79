"""Comparison and repair of two layers that should agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import children_of
from tillstream.operators.merge import MergeResult, merge_upsert
from tillstream.session import settle
from tillstream.specs import TableSpec


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def reconcile(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Keys on which ``a`` (expected) and ``b`` (actual) disagree, by hash.

    ``status``: missing (only in ``a``), extra (only in ``b``) or different. Reads key and
    hash only; both sides are unique on the key.
    """
    key = _keys(key)
    left = a.select(*key, F.col("hash").alias("expected_hash"), F.lit(True).alias("_a"))
    right = b.select(*key, F.col("hash").alias("actual_hash"), F.lit(True).alias("_b"))
    same = F.col("expected_hash").eqNullSafe(F.col("actual_hash"))
    status = (F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra")
              .when(~same, "different"))
    return (left.join(right, key, "full_outer").withColumn("status", status)
            .filter(F.col("status").isNotNull())
            .select(*key, "status", "expected_hash", "actual_hash"))


LEAF_BITS, STEP_BITS = 16, 8


def digests(df: DataFrame, key) -> DataFrame:
    """Order-free checksums of ``df`` (key, hash) over 2**LEAF_BITS ranges of the key's hash: ``_range``,
    rows, and sum and exclusive-or of row digests. Summed map-side: at most that many rows are shuffled
    per task. A layer may store them and send them elsewhere in place of its rows."""
    key = _keys(key)
    row = F.xxhash64(F.lit(1), *key, "hash")
    return df.select(_leaf(key).alias("_range"), row.alias("_r"), F.xxhash64(F.lit(2), *key, "hash").alias("_x")).groupBy(
        "_range").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("_r").cast("decimal(38,0)")).alias("total"),
                      F.bit_xor("_x").alias("mixed"))


def _leaf(key: list[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - LEAF_BITS).cast("int")


def roll_up(leaves: DataFrame, bits: int) -> DataFrame:
    """The checksums of the 2**bits ranges that the ranges of ``leaves`` make up."""
    return leaves.groupBy(F.shiftright("_range", LEAF_BITS - bits).alias("_range")).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed"))


def _unequal(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.select("_range", F.struct("rows", "total", "mixed").alias("_a")).join(
        b.select("_range", F.struct("rows", "total", "mixed").alias("_b")), "_range", "full_outer")
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("_range")


def differing_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Leaf ranges on which two tables of checksums disagree, found from the root down: below a range
    that agrees nothing is compared."""
    suspects = _unequal(roll_up(a, 0), roll_up(b, 0))
    for bits in range(STEP_BITS, LEAF_BITS + 1, STEP_BITS):
        above = F.shiftright("_range", LEAF_BITS - (bits - STEP_BITS)) == F.col("_above")
        few = F.broadcast(suspects.select(F.col("_range").alias("_above")))      # at most 2**LEAF_BITS numbers
        suspects = _unequal(*[roll_up(x.join(few, above, "left_semi"), bits) for x in (a, b)])
    return suspects


def reconcile_digests(a: DataFrame, b: DataFrame, key, a_digests: DataFrame | None = None,
                      b_digests: DataFrame | None = None) -> DataFrame:
    """:func:`reconcile` for layers that agree for the most part: only rows of ranges whose checksums
    differ are joined row by row. Stored checksums save the pass that makes them."""
    key = _keys(key)
    a_digests = settle(digests(a, key), "digests") if a_digests is None else a_digests
    b_digests = settle(digests(b, key), "digests") if b_digests is None else b_digests
    ranges = F.broadcast(settle(differing_ranges(a_digests, b_digests), "ranges").withColumnRenamed("_range", "_wanted"))

    def suspect(rows: DataFrame) -> DataFrame:
        return rows.join(ranges, _leaf(key) == F.col("_wanted"), "left_semi")
    return reconcile(suspect(a.select(*key, "hash")), suspect(b.select(*key, "hash")), key)


def integrity_report(upstream: DataFrame, downstream: DataFrame, key) -> DataFrame:
    """One row: rows and distinct keys per layer, duplicate, lost and unexpected keys."""
    key = _keys(key)
    counted = (upstream.select(*key, F.lit(1).alias("u"), F.lit(0).alias("d"))
               .unionByName(downstream.select(*key, F.lit(0).alias("u"), F.lit(1).alias("d")))
               .groupBy(*key).agg(F.sum("u").alias("u"), F.sum("d").alias("d")))

    def hits(cond):
        return F.count(F.when(cond, 1))
    u, d = F.col("u"), F.col("d")
    return counted.agg(
        F.coalesce(F.sum("u"), F.lit(0)).alias("upstream_rows"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("downstream_rows"),
        hits(u > 0).alias("upstream_keys"),
        hits(d > 1).alias("duplicate_keys"),
        hits((u > 0) & (d == 0)).alias("lost_keys"),
        hits((u == 0) & (d > 0)).alias("unexpected_keys"))


def repair(target: DataFrame, source: DataFrame, diff: DataFrame, spec: TableSpec,
           now) -> MergeResult:
    """Re-apply the source rows of the keys ``reconcile`` found missing or different."""
    key = list(spec.key)
    wanted = diff.filter(F.col("status").isin("missing", "different")).select(*key)
    return merge_upsert(target, children_of(source, wanted, key), spec, now, guard=False)
