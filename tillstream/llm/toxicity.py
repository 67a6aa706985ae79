"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic if any of its sentences is: with sentence probabilities p, its probability is
the noisy-or 1 - prod(1 - p). Sentence weights are fitted through that expression to document
labels alone; sentences with a high p are the offending ones.

Features are words and their beginnings, hashed into a fixed number of cells. How many toxic and
clean documents hold each cell is counted over all labelled training rows; cells that toxic ones do
not hold clearly more often take no part. The weights of the rest are fitted on a sample of labelled rows of
about ``SAMPLE`` documents, chosen by a hash of the id.

Null and empty texts have the score of a text without sentences: the share of toxic documents that
the bias alone explains is 0, so 0. Without labels of both kinds all scores are 0. A document with
several label rows is toxic if one of them says so; null labels teach nothing. Repeated rows are
answered each; other columns are kept, and the new columns replace any of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import LOWER, RangeHasher, map_pieces, pieces, row_bytes, runs, sampled
from tillstream.llm.langid import held_out
from tillstream.session import settle

CELL_BITS = 18
CELLS = 1 << CELL_BITS
# Lengths in bytes of the beginnings that count besides the whole word.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
# Cells count if toxic documents hold them more often, by as many standard errors and as many times.
LEAST_Z, LEAST_RATIO = 5.0, 1.5
# Labelled documents, about, that the weights are fitted on.
SAMPLE = 20_000
STEPS, RATE, SHRINK = 400, 0.1, 1e-4
OFFENDING = 0.5

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, sentence and cell of each feature; sentences number on through the whole piece.

    Also the start of each sentence that holds a word, and its row.
    """
    data = LOWER[data]
    start, end, row = runs(_IN_WORD[data], offsets)
    border = np.zeros(len(data) + 1, np.int64)
    border[1:] = _ENDS[data]
    border[offsets[1:-1]] += 1
    sentence = np.cumsum(border)[start]
    _, at, sentence = np.unique(sentence, return_index=True, return_inverse=True)
    hasher = RangeHasher(data)
    rows, sentences, cells = [], [], []
    for size in (None, *BEGINNINGS):
        fits = slice(None) if size is None else end - start >= size
        stop = end if size is None else start[fits] + size
        code = hasher(start[fits], stop) ^ np.uint64(0 if size is None else 0x5851F42D4C957F2D)
        rows.append(row[fits])
        sentences.append(sentence[fits])
        cells.append((code >> np.uint64(64 - CELL_BITS)).astype(np.int64))
    return (np.concatenate(rows), np.concatenate(sentences), np.concatenate(cells),
            start[at], row[at])


def _count(batches):
    """Per partition: the cells' toxic and clean documents (summed up), and the sampled rows."""
    seen = np.zeros((2, CELLS), np.int64)
    size = np.zeros(2, np.int64)
    for batch in batches:
        for piece in pieces(batch, "text"):
            row, _, cell, _, _ = features(*row_bytes(piece.column("text")))
            toxic = piece.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            key = np.unique(row * CELLS + cell)
            for k in (0, 1):
                seen[k] += np.bincount(key[toxic[key // CELLS] == k] % CELLS, minlength=CELLS)
                size[k] += int((toxic == k).sum())
            chosen = piece.filter(piece.column("sampled"))
            n = chosen.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                 chosen.column("toxic"), chosen.column("text")],
                ["cell", "clean_docs", "toxic_docs", "toxic", "text"])
    cell = np.flatnonzero(seen.any(axis=0))
    counts = [np.append(seen[k, cell], size[k]) for k in (0, 1)]
    n = len(cell) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(cell, CELLS).astype(np.int32)), pa.array(counts[0]),
         pa.array(counts[1]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())],
        ["cell", "clean_docs", "toxic_docs", "toxic", "text"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """``docs`` with (doc_id, text) and ``labels`` with (doc_id, toxic): training rows only."""
    spark = docs.sparkSession
    told = (labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id")
            .agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    n = told.count()
    share = min(1.0, sample / max(n, 1))
    told = told.withColumn("sampled", sampled(share, "doc_id"))
    # One way at every size: a broadcast of few labels would say nothing about many.
    joined = docs.select("doc_id", "text").filter("text is not null").join(told.hint("merge"), "doc_id")
    found = settle(joined.select("text", "toxic", "sampled").mapInArrow(
        _count, "cell int, clean_docs long, toxic_docs long, toxic int, text string"), "toxicity")
    counts = (found.filter("cell is not null").groupBy("cell")
              .agg(F.sum("clean_docs").alias("clean"), F.sum("toxic_docs").alias("toxic")).toPandas())
    totals = counts[counts["cell"] == CELLS]
    clean, toxic = (int(totals[k].sum()) for k in ("clean", "toxic"))
    none = Model(np.zeros(CELLS, np.float32), -np.inf)
    if not clean or not toxic:
        return none
    counts = counts[counts["cell"] < CELLS]
    both = (counts["clean"] + counts["toxic"]) / (clean + toxic)
    error = np.sqrt(both * (1 - both) * (1 / clean + 1 / toxic)) + 1e-12
    share, other = counts["toxic"] / toxic, counts["clean"] / clean
    # The ratio keeps out what is merely longer texts' words, however many documents there are.
    telling = ((share - other) / error >= LEAST_Z) & (share >= LEAST_RATIO * other)
    chosen = np.sort(counts["cell"][telling].to_numpy())
    number = np.full(CELLS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    shared = spark.sparkContext.broadcast(number)

    def reduce(piece):
        data, offsets = row_bytes(piece.column("text"))
        row, sentence, cell, _, sentence_row = features(data, offsets)
        known = shared.value[cell]
        key = np.unique((sentence * CELLS + known)[known >= 0])
        at = sentence_row[key // CELLS]
        ends = np.searchsorted(at, np.arange(piece.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32)))
                 for v in (key // CELLS, key % CELLS)]
        sentences = np.bincount(sentence_row, minlength=piece.num_rows).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [piece.column("toxic"), pa.array(sentences), *lists],
            ["toxic", "sentences", "sentence", "feature"])

    rows = map_pieces(found.filter("text is not null").select("text", "toxic"), reduce,
                      "toxic int, sentences int, sentence array<int>, feature array<int>").toPandas()
    return _fit(rows, chosen, toxic / (clean + toxic)) if len(rows) else none


def _fit(rows, chosen: np.ndarray, rate: float) -> Model:
    """Weights and bias by gradient steps (Adam) on the noisy-or likelihood."""
    y = rows["toxic"].to_numpy(float)
    doc, instance, feature, total = [], [], [], 0
    for k, (own, cells) in enumerate(zip(rows["sentence"], rows["feature"], strict=True)):
        if len(own):
            names, at = np.unique(own, return_inverse=True)
            instance.append(at + total)
            feature.append(np.asarray(cells))
            doc.append(np.full(len(names), k))
            total += len(names)
    plain = rows["sentences"].to_numpy(float)
    if not total:
        return Model(np.zeros(CELLS, np.float32), -np.inf)
    doc, instance, feature = map(np.concatenate, (doc, instance, feature))
    plain -= np.bincount(doc, minlength=len(y))
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = -5.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(instance, theta[feature], total) + theta[-1]
        base = np.logaddexp(0, theta[-1])
        mass = np.bincount(doc, np.logaddexp(0, z), len(y)) + plain * base + 1e-9
        slope = np.where(y == 1, -1 / np.expm1(np.minimum(mass, 50)), 1.0) / len(y)
        inner = slope[doc] / (1 + np.exp(-z))
        grad = np.append(np.bincount(feature, inner[instance], len(chosen)),
                         inner.sum() + (slope * plain).sum() / (1 + np.exp(-theta[-1])))
        grad[:-1] += SHRINK * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
    weights = np.zeros(CELLS, np.float32)
    weights[chosen] = theta[:-1]
    return Model(weights, float(theta[-1]))


def score(df: DataFrame, model: Model, text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Add ``score``, ``predicted`` (1 from 0.5 on) and ``offending``: the sentences of probability
    0.5 or more, as code-point start (of its first word), end and probability."""
    new = ["score", "predicted", "offending"]
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    shared = df.sparkSession.sparkContext.broadcast(model)
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def work(piece):
        weights, bias = shared.value.weights, shared.value.bias
        data, offsets = row_bytes(piece.column(text))
        row, sentence, cell, start, sentence_row = features(data, offsets)
        # A feature counts once per sentence, as in the fit.
        weight = weights[cell]
        key, at = np.unique((sentence * CELLS + cell)[weight != 0], return_index=True)
        z = np.bincount(key // CELLS, weight[weight != 0][at], len(start)) + bias
        mass = np.bincount(sentence_row, np.logaddexp(0, z), piece.num_rows)
        p = 1 - np.exp(-mass)
        bad = np.flatnonzero(z >= np.log(OFFENDING / (1 - OFFENDING)))
        # A sentence ends before the next one's first word, or with the row.
        stop = np.minimum(np.append(start[1:], len(data)), offsets[sentence_row + 1])
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        origin = points[offsets[sentence_row[bad]]]
        places = pa.StructArray.from_arrays(
            [pa.array(points[start[bad]] - origin), pa.array(points[stop[bad]] - origin),
             pa.array(1 / (1 + np.exp(-z[bad])))], fields=list(place))
        ends = np.searchsorted(sentence_row[bad], np.arange(piece.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [piece.column(c) for c in keep]
            + [pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
               pa.ListArray.from_arrays(pa.array(ends), places)], keep + new)

    own = "".join(f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return map_pieces(df.select(*dict.fromkeys([*keep, text])), work,
                      own + "score double, predicted int, "
                            "offending array<struct<start:bigint,end:bigint,score:double>>", text)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = held_out("doc_id", 5, 0)
    model = learn(docs.filter(~out), labels.filter(~out))
    return score(docs, model, keep=["doc_id"]).withColumn("held_out", out)
