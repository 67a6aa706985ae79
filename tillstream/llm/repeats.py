"""Repeated byte strings across documents, by minimizer buckets and window hashes.

This stands in for bucket-pointer refinement, which sorts all suffixes into buckets and refines them
by the bucket identifiers of later offsets: that needs a row for every byte and a shuffle for every
doubling of the length. Here nothing is refined by later offsets. Buckets are those of one seed of
``SEED`` bytes per window, and what shares a bucket is told apart by hashes taken straight from the
text; hashes of content, so that all tasks agree on them without numbering.

Only some suffixes need a bucket: each window of ``LENGTH`` bytes chooses the seed of smallest hash
within it. Equal windows choose the same seed, so whatever repeats meets in a bucket. Neighbouring
windows mostly choose the same one; they are one suffix with a run of windows.

1. Buckets by seed, told apart by the whole run: if a document with a smaller id has the same run, all
   its windows are repeats. Most repeats end here, at one row for some fifteen windows.
2. Runs that share their seed with another document, but not the run, are compared window by window.
3. Repeated windows are laid over the documents' bytes.

A document that is there a third of a million times costs one row per piece of input and run, as
repeats within a piece are found before anything is shuffled.

A seed in very many documents is hot: its rows are dealt out to several tasks by document. Within one
task a run that repeats an earlier one is a repeat; each task's first ones are all compared window by
window, and the first holder of such a window is found by a grouped minimum, joined back. Which seeds
are hot is estimated from a sample of the documents; that decides where rows go, never what is found.

Null and empty texts have no bytes. Rows with a null id are neither searched nor compared with; rows
of an equal id do not repeat each other. Other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm import batches
from tillstream.llm.batches import RangeHasher, list_column, map_pieces, mix, row_bytes, row_ends, sampled
from tillstream.session import settle

LENGTH, SEED = 50, 20
# Documents in which hot seeds are looked for, and rows of a hot seed that go to one task.
SAMPLED = 1 / 64
TASK_ROWS = 1 << 16
# A seed is hot from this many sampled rows on, and from this share of all of them: at most 65,536 are.
HOT_FLOOR, HOT_SHARE = 64, 1 / (1 << 16)
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)


def runs_of_windows(data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """For each run of windows that choose the same seed: the seed's and the run's identifiers, row,
    and first and last window start."""
    n, width = len(data), length - seed + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    hasher = RangeHasher(data)
    key = (hasher.sums[seed:] - hasher.sums[:-seed]) * batches._inverse_powers(n)[:n - seed + 1]
    code = (key ^ (key >> np.uint64(29))) * _ODD
    # The smallest hash of a window, and, in the low half, where it is.
    least = (code & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(code), dtype=np.uint64)
    reach = 1
    while reach < width:
        more = min(reach, width - reach)
        least = np.minimum(least[:-more], least[more:])
        reach += more
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(n + 1, bool)
    past = offsets[1:, None] - np.arange(1, length)
    inside[past[past >= offsets[:-1, None]]] = False
    inside = inside[:len(at)]
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
    low, high = np.flatnonzero(new), np.flatnonzero(last)
    at = at[low]
    run = hasher(low, high + length) ^ mix((at - low).astype(np.uint64))
    return mix(key[at]), run, np.searchsorted(offsets, low, "right") - 1, low, high


def _candidates(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """Rows of runs; those that repeat one of a smaller id in the same piece are joined to spans
    (``seed`` of no meaning, ``run`` null)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(piece):
        data, offsets = row_bytes(piece.column("text"))
        code, run, row, low, high = runs_of_windows(data, offsets, length, seed)
        rank = piece.column("rank").to_numpy()
        # By run, then by the order of the ids.
        order = np.lexsort((rank[row], run, code))
        head = np.ones(len(order), bool)
        head[1:] = (code[order][1:] != code[order][:-1]) | (run[order][1:] != run[order][:-1])
        first = np.empty(len(order), np.int64)
        first[order] = rank[row][order][np.flatnonzero(head)][np.cumsum(head) - 1] if len(order) else 0
        repeat = rank[row] > first
        start, end = low - offsets[row], high + length - offsets[row]
        # Repeats that touch are one span.
        row2, start2, end2 = row[repeat], start[repeat], end[repeat]
        split = np.ones(len(row2), bool)
        split[1:] = (row2[1:] != row2[:-1]) | (start2[1:] > end2[:-1])
        at = np.flatnonzero(split)
        stop = np.append(at[1:], len(row2)) - 1 if len(at) else at
        yield batch(piece, row2[at], mix((start2[at] + row2[at] * 7919).astype(np.uint64)), None,
                    start2[at], end2[stop])
        keep = ~repeat
        yield batch(piece, row[keep], code[keep], run[keep], start[keep], end[keep])

    def batch(piece, row, code, run, start, end):
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(code.view(np.int64)),
             pa.nulls(len(row), pa.int64()) if run is None else pa.array(run.view(np.int64)),
             piece.column("doc_id").take(take), piece.column("tag").take(take),
             pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            ["seed", "run", "doc_id", "tag", "start", "end"])

    return map_pieces(docs, work, f"seed long, run long, doc_id {kind}, tag int, start int, end int")


def _windows(docs: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """Identifiers of every window of the open runs."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = open_.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    joined = docs.join(runs, ["doc_id", "tag"]).select(
        "doc_id", "tag", "text", F.col("runs.start").alias("starts"), F.col("runs.end").alias("ends"))

    def work(piece):
        data, offsets = row_bytes(piece.column("text"))
        starts, ends = piece.column("starts"), piece.column("ends")
        count = starts.value_lengths().to_numpy()
        row = np.repeat(np.arange(piece.num_rows), count)
        low = starts.flatten().to_numpy() + offsets[row]
        size = ends.flatten().to_numpy() + offsets[row] - low - length + 1
        window = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        row = np.repeat(row, size)
        code = RangeHasher(data)(window, window + length)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(code.view(np.int64)), piece.column("doc_id").take(take),
             piece.column("tag").take(take), pa.array((window - offsets[row]).astype(np.int32))],
            ["window", "doc_id", "tag", "start"])

    return map_pieces(joined, work, f"window long, doc_id {kind}, tag int, start int")


def _ranked(docs: DataFrame) -> DataFrame:
    """doc_id, tag, rank (a number in the order of the ids) and text of the rows that are searched.

    The tag tells rows of a repeated id apart; it is 0 if no id is repeated.
    """
    rows = docs.filter("doc_id is not null and text is not null")
    repeated = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    tag = F.lit(0) if repeated.isEmpty() else F.hash("text")
    return rows.select("doc_id", tag.alias("tag"), F.col("doc_id").cast("long").alias("rank"), "text")


def _hot_seeds(ranked: DataFrame, length: int, seed: int) -> DataFrame | None:
    """Seeds with more rows than a task should hold, by a sample of the documents, and the ``tasks`` their
    rows fill. None if there are none. Sampled counts are summed map-side."""
    part = ranked.filter(sampled(SAMPLED, "doc_id"))
    counts = settle(_candidates(part, length, seed).filter("run is not null").groupBy("seed").agg(
        F.count("*").alias("n")).filter(F.col("n") > 1), "seed-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") >= max(HOT_FLOOR, total * HOT_SHARE)).select(
        "seed", F.ceil(F.col("n") / (SAMPLED * TASK_ROWS)).alias("tasks"))
    return None if hot.isEmpty() else hot


def find(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The searched rows (doc_id, tag, text), and the repeated spans: doc_id, tag, start and end in
    bytes; spans may overlap. Ids must be whole numbers."""
    ranked = _ranked(docs)
    texts = ranked.select("doc_id", "tag", "text")
    hot = _hot_seeds(ranked, length, seed)
    found = _candidates(ranked, length, seed)
    if hot is None:
        found = found.withColumn("part", F.lit(0))
    else:
        found = found.join(F.broadcast(hot), "seed", "left").withColumn(
            "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), "tasks") + 1, F.lit(0)).cast("int"))
    found = found.repartition("seed", "part")
    run = Window.partitionBy("seed", "part", "run").orderBy("doc_id").rowsBetween(
        Window.unboundedPreceding, 0)
    bucket = Window.partitionBy("seed", "part")
    told = found.withColumn("first", F.min("doc_id").over(run)).withColumns({
        "least": F.min("doc_id").over(bucket), "most": F.max("doc_id").over(bucket),
        "run1": F.min("run").over(bucket), "run2": F.max("run").over(bucket)})
    whole = F.col("run").isNull() | (F.col("doc_id") > F.col("first"))
    dealt = F.col("part") > 0
    split = dealt | (F.col("least") < F.col("most")) & (F.col("run1") < F.col("run2"))
    told = settle(told.filter(whole | split).select(
        "doc_id", "tag", "start", "end", whole.alias("whole"), dealt.alias("dealt")), "runs")
    window = Window.partitionBy("window").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    single = settle(_windows(texts, told.filter("not whole and not dealt"), length)
                    .withColumn("first", F.min("doc_id").over(window))
                    .filter("doc_id > first").select("doc_id", "tag", "start"), "windows")
    if hot is not None:
        # Equal windows have equal seeds, so that those of hot seeds meet no others.
        of_hot = settle(_windows(texts, told.filter("not whole and dealt"), length), "hot-windows")
        first = of_hot.groupBy("window").agg(F.min("doc_id").alias("first"))
        single = single.unionByName(of_hot.join(first, "window").filter("doc_id > first")
                                    .select("doc_id", "tag", "start"))
    spans = told.filter("whole").select("doc_id", "tag", "start", "end").unionByName(
        single.select("doc_id", "tag", "start", (F.col("start") + length).cast("int").alias("end")))
    return texts, spans


def remove(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, ``n_bytes``, ``kept`` (the bytes that are left) and ``removed`` (maximal
    removed runs: arrays of start and end). Rows without id or text are whole."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts, spans = find(docs, length, seed)
    lists = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = texts.join(lists, ["doc_id", "tag"], "left").select(
        "doc_id", "text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    alone = docs.filter("doc_id is null or text is null").select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("starts"),
        F.lit(None).cast("array<int>").alias("ends"))

    def work(piece):
        data, offsets = row_bytes(piece.column("text"))
        starts, ends = (piece.column(c) for c in ("starts", "ends"))
        count = starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(piece.num_rows), count)
        depth = np.zeros(len(data) + 1, np.int64)
        depth += np.bincount(starts.flatten().to_numpy() + offsets[row], minlength=len(depth))
        depth -= np.bincount(ends.flatten().to_numpy() + offsets[row], minlength=len(depth))
        gone = np.cumsum(depth)[:-1] > 0
        low, high, at = batches.runs(gone, offsets)
        kept = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        removed = [list_column(x - offsets[at], row_ends(at, piece.num_rows), pa.int64())
                   for x in (low, high)]
        left = pa.LargeBinaryArray.from_buffers(pa.large_binary(), piece.num_rows, [
            None, pa.py_buffer(kept), pa.py_buffer(data[~gone])]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(np.diff(offsets)), left, *removed],
            ["doc_id", "n_bytes", "kept", "starts", "ends"])

    return map_pieces(rows.unionByName(alone), work, f"doc_id {kind}, n_bytes long, kept binary, "
                                                     "starts array<long>, ends array<long>")


def report(docs: DataFrame) -> DataFrame:
    return remove(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))
