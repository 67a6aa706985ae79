"""Near-duplicate documents by min-max hashing.

A document is its set of word shingles. Under each hash function both the smallest and the largest
value of the set are kept: two values from one evaluation, each equal in two sets with the
probability of their similarity. Bands of them put alike documents into common buckets; every link
is confirmed on the full sets.

Documents with equal sets are one class and take part once. No bucket yields all its pairs. In a few
rounds, one member of each bucket is compared with all members of other components, and links join
components; groups of copies come together at the cost of their members. What is left are members of
buckets that still hold several components: mostly texts that are alike, but not enough. They are
compared by an exact join that finds every link: two sets of the wanted similarity share one of
their rarest shingles, at places early enough that the rest can still agree.

Null and empty texts have the empty set and are linked with nothing. Rows that share an id are one
document; rows with a null id are linked with nothing. Which pairs meet is settled by fixed hash
functions, so that results can be repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.batches import LOWER, list_column, map_pieces, mix, row_bytes, row_ends, words
from tillstream.llm.components import components
from tillstream.llm.lines import apart, back, quoted
from tillstream.session import settle

# 75 hash functions give 150 values. A pair of similarity 0.85 (0.8) misses all bands with a
# probability of 2e-8 (7e-6).
BANDS, ROWS = 30, 5
STAR_ROUNDS, SEEDS = 2, 4

_random = np.random.default_rng(11)
_FACTORS = _random.integers(1, 2**63, BANDS * ROWS // 2, dtype=np.uint64) * 2 + 1
_SHIFTS = _random.integers(1, 2**63, BANDS * ROWS // 2, dtype=np.uint64)
_BAND = _random.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * 2 + 1
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * 2 + 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, by row and hash. Fewer words are one shingle."""
    code, _, _, row = words(LOWER[data], offsets)
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    n = len(code)
    total = code * _PLACE[0]
    inside = np.ones(n, bool)
    for k in range(1, size):
        m = max(n - k, 0)
        total[:m] += code[k:] * _PLACE[k]
        inside[m:] = False
        inside[:m] &= row[k:] == row[:m]
    short = np.flatnonzero((count > 0) & (count < size))
    first = row_ends(row, rows)
    extra = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = count[short] > k
        extra[has] += code[first[short[has]] + k] * _PLACE[k]
    # The number of words keeps short texts apart from the shingles of longer ones.
    extra += count[short].astype(np.uint64) * _PLACE[63]
    row = np.concatenate([row[inside], short])
    value = mix(np.concatenate([total[inside], extra]))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band hashes (sets by bands) of sets that start at ``first``."""
    sums = np.zeros((len(first), BANDS), np.uint64)
    for k in range(BANDS * ROWS // 2):
        seen = value * _FACTORS[k] + _SHIFTS[k]
        seen ^= seen >> np.uint64(32)
        for j, own in enumerate((np.minimum.reduceat(seen, first), np.maximum.reduceat(seen, first))):
            band, place = divmod(2 * k + j, ROWS)
            sums[:, band] += mix(own) * _BAND[band, place]
    return mix(sums + np.arange(BANDS, dtype=np.uint64))


def _described(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, number of shingles, digest of the set, and bands (none of an empty set)."""
    def work(piece):
        row, value = shingles(*row_bytes(piece.column("text")), size)
        rows = piece.num_rows
        ends = row_ends(row, rows)
        count = np.diff(ends)
        full = np.flatnonzero(count)
        bands = signatures(value, ends[full]) if len(full) else np.zeros((0, BANDS), np.uint64)
        digest = np.zeros((2, rows), np.uint64)
        for k in range(2):
            if len(full):
                digest[k, full] = np.add.reduceat(mix(value * _PLACE[40 + k]), ends[full])
        band_ends = np.concatenate([[0], np.cumsum((count > 0) * BANDS)])
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(count.astype(np.int64)),
             *(pa.array(d.view(np.int64)) for d in digest),
             list_column(bands.ravel().view(np.int64), band_ends, pa.int64())],
            ["doc_id", "n", "d1", "d2", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_pieces(docs.select("doc_id", "text"), work,
                      f"doc_id {kind}, n long, d1 long, d2 long, bands array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """Per row: node (the id) and the full set."""
    def work(piece):
        row, value = shingles(*row_bytes(piece.column("text")), size)
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), list_column(value.view(np.int64), row_ends(row, piece.num_rows),
                                                 pa.int64())], ["node", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_pieces(docs.select("doc_id", "text"), work, f"node {kind}, items array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike. A set that many pairs need is a skewed join,
    which adaptive execution splits."""
    both = (pairs.join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.filter(100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)).select("a", "b")


def _early_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different labels that may be alike, at least one of them ``minor``.

    The shingles of a set are put in order of how many sets hold them. If two sets are alike, their
    first common shingle stands where enough shingles are left in both.
    """
    items = sets.join(nodes.select("node"), "node", "left_semi").select("node", F.explode("items").alias("item"))
    count = items.groupBy("item").agg(F.count("*").alias("df"))
    # Of the other set at least ``percent`` per cent of this one must be found in it.
    early = (F.size("list") - F.ceil(F.size("list") * percent / 100) + 1).cast("int")
    ordered = (items.join(count, "item").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("df", "item"))).alias("list"))
        .select("node", F.size("list").alias("n"),
                F.posexplode(F.slice("list", F.lit(1), early)).alias("place", "x")))
    # What no other set holds has its place, but meets nothing.
    rows = ordered.filter("x.df > 1").select("node", "n", "place", F.col("x.item").alias("item")).join(
        nodes, "node")
    rows = settle(rows, "early")
    left = rows.filter("minor").select("item", *[F.col(c).alias(c + "_a") for c in ("node", "n", "place", "label")])
    right = rows.select("item", *[F.col(c).alias(c + "_b") for c in ("node", "n", "place", "label", "minor")])
    needed = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    enough = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= needed
    once = ~F.col("minor_b") | (F.col("node_a") < F.col("node_b"))
    return left.join(right, "item").filter((F.col("label_a") != F.col("label_b")) & once & enough).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """The labels after the links (a, b) have joined components."""
    def of(side):
        return labels.select(F.col("node").alias(side), F.col("label").alias("l" + side))
    pairs = settle(found.join(of("a"), "a").join(of("b"), "b")
                   .select(F.col("la").alias("a"), F.col("lb").alias("b")), "links")
    if pairs.isEmpty():
        return labels
    moved = components(pairs).select(F.col("node").alias("label"), F.col("label").alias("new"))
    return settle(labels.join(moved, "label", "left").select(
        "node", F.coalesce("new", "label").alias("label")), "labels")


def links(described: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """node and label: the components of the classes that are linked with another one."""
    classes = settle(described.filter("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes")
    member = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    member = settle(member.join(shared.select("bucket"), "bucket").distinct(), "buckets")
    wanted = member.select(F.col("node").alias("doc_id")).distinct()
    sets = settle(_sets(docs.join(wanted, "doc_id", "left_semi"), size).distinct(), "sets")
    labels = settle(member.select("node", F.col("node").alias("label")).distinct(), "labels")
    for turn in range(STAR_ROUNDS):
        seen = member.join(labels, "node")
        # Buckets of one group mostly choose one of few leaders, so that pairs are the same ones.
        choice = F.xxhash64("node", F.pmod("bucket", F.lit(SEEDS)), F.lit(turn))
        leader = (seen.groupBy("bucket").agg(
            F.min(F.struct(choice, F.col("node").alias("a"), F.col("label").alias("la"),
                           F.col("n").alias("na"))).alias("l"),
            F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low <> high").select("bucket", "l.a", "l.la", "l.na"))
        open_ = settle(seen.join(leader, "bucket"), "open")
        near = (F.col("label") != F.col("la")) & (
            100 * F.least("na", "n") >= percent * F.greatest("na", "n"))
        pairs = open_.filter(near).select(
            F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        labels = _joined(labels, _confirmed(settle(pairs, "candidates"), sets, percent))
        # The leader has been compared with all others.
        member = open_.filter("node <> a").select("bucket", "node", "n")
    seen = member.join(labels, "node")
    parts = seen.groupBy("bucket", "label").agg(F.count("*").alias("k"))
    main = (parts.groupBy("bucket").agg(F.max_by("label", F.struct("k", "label")).alias("main"),
                                        F.count("*").alias("parts")).filter("parts > 1"))
    nodes = settle(seen.join(main.select("bucket", "main"), "bucket").groupBy("node", "label").agg(
        F.max(F.col("label") != F.col("main")).alias("minor")), "open")
    if not nodes.isEmpty():
        pairs = settle(_early_pairs(nodes, sets, percent), "candidates")
        labels = _joined(labels, _confirmed(pairs, sets, percent))
    return labels.filter("node <> label")


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id it is linked with, over any number
    of links) and kept (whether that is the row's own id).

    ``size`` words make a shingle; rows are linked from ``percent`` per cent of common shingles on.
    """
    described = settle(_described(docs, size), "described")
    linked = links(described, docs, size, percent)
    classes = described.filter("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("node"))
    # Rows of a repeated id are one document, so their classes are linked as well.
    repeated = (described.filter("n > 0 and doc_id is not null").groupBy("doc_id")
                .agg(F.min("d1").alias("x"), F.max("d1").alias("y")).filter("x <> y").select("doc_id"))
    told = described.select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2").join(
        classes, ["d1", "d2"], "left").join(
        linked, "node", "left").withColumn("found", F.coalesce("label", "node", "doc_id"))
    told = settle(told.withColumn("found", F.when(F.col("n_shingles") > 0, F.col("found"))
                                  .otherwise(F.col("doc_id"))).select("doc_id", "n_shingles", "found"),
                  "groups")
    if not repeated.isEmpty():
        tied = told.join(repeated, "doc_id", "left_semi")
        tied = tied.select(F.col("doc_id").alias("a"), F.col("found").alias("b"))
        more = components(tied).select(F.col("node").alias("found"), "label")
        told = told.join(more, "found", "left").withColumn("found", F.coalesce("label", "found"))
    return told.select("doc_id", "n_shingles", F.col("found").alias("component_id"),
                       F.coalesce(F.col("doc_id") == F.col("found"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with all columns; rows with a null id stay."""
    kept = groups(docs, size, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.filter("doc_id is not null").select(*apart(docs), "doc_id").join(
        kept, "doc_id", "left_semi")
    # Rows of a repeated id: the one whose text sorts first.
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(
        "own_text", F.xxhash64(*[quoted("own_" + c) for c in docs.columns])))
    rows = rows.withColumn("place", place).filter("place = 1").select(*back(docs))
    return rows.unionByName(docs.filter("doc_id is null"))
