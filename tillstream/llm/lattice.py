"""Likelihood of texts under a word model whose smoothing sums over all subword segmentations.

The pieces of an existing subword vocabulary form a lattice over each word. A word is a first piece
(one that begins a word), then further pieces, each followed by a stop or not. Its probability
P(word) is the sum over all segmentations, by forward recursion in log space. The vocabulary's own
scores give the first weights of the pieces; expectation-maximisation then fits them to the
training words. All training documents are counted once, by a shuffle that leaves each word with its
count; every round is over all of these words.

A text is its words and one end. A token counted c times among N training tokens has the probability
(c + a P(word)) / (N + a); ``a``, the weight of the lattice, is the number of words seen once in
training (the mass that new words take), counted exactly. Words of high count take a broadcast table
of fixed size; all others meet their count in a join, which splits a word with very many rows.

Null texts count as empty and have one token, the end. With nothing to learn from, the words have
the lattice probability of the vocabulary's scores. Repeated rows are answered each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import (LOWER, PIECE_BYTES, ROWS_PER_BATCH, map_pieces, pieces, row_bytes,
                                    words)
from tillstream.llm.langid import held_out
from tillstream.session import settle

# Rounds of expectation-maximisation, each over all words, and words of the broadcast table.
ROUNDS, FREQUENT = 6, 20_000
# Distinct words sent to Python at once.
WORD_ROWS = 4_096
# Words worked on at once, and words one Python process remembers the probability of.
BLOCK, REMEMBERED = 1 << 15, 1 << 21
# Bytes from which on a word is worked on by itself.
LONG = 256
SMOOTHING = 0.1

_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)


@dataclass(frozen=True)
class Pieces:
    """Pieces as bytes (a leading blank begins a word), log-weights, and the log-odds of stopping."""
    names: list[bytes]
    weight: np.ndarray
    stop: float


def vocabulary(path: str) -> Pieces:
    """Pieces of a sentencepiece model, weighted by the rank that its scores give them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(path).read_bytes())
    found: dict[bytes, float] = {}
    for i in range(model.vocab_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        name = model.id_to_piece(i)
        if model.is_byte(i):
            raw, score = bytes([int(name[3:-1], 16)]), -float(model.vocab_size())
        else:
            raw, score = name.replace("▁", " ").encode(), model.get_score(i)
        if b" " not in raw[1:]:
            found[raw] = max(score, found.get(raw, -np.inf))
    for raw in [b" ", *(bytes([b]) for b in range(256))]:
        found.setdefault(raw, -float(model.vocab_size()))
    names = sorted(found)
    rank = np.argsort(np.argsort([-found[n] for n in names], kind="stable"))
    return normalized(names, 1 / (rank + 10.0), 0.4)


def normalized(names: list[bytes], mass: np.ndarray, stop: float) -> Pieces:
    first = np.array([n[:1] == b" " for n in names])
    total = np.where(first, mass[first].sum(), mass[~first].sum())
    return Pieces(names, np.log(mass / total) + np.log1p(-stop), float(np.log(stop) - np.log1p(-stop)))


class Lattice:
    """Sums over all segmentations of many words at once."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.weight = np.append(pieces.weight, -np.inf)
        by_size: dict[int, list[int]] = {}
        for i, name in enumerate(pieces.names):
            by_size.setdefault(len(name), []).append(i)
        self.tables = {size: self._table(size, ids) for size, ids in sorted(by_size.items())}

    def _table(self, size: int, ids: list[int]):
        """Two hash tables: the second holds what found its place in the first one taken."""
        codes = np.array([list(self.pieces.names[i]) for i in ids], np.uint8)
        step = np.array([pow(_STEP, k, 1 << 64) for k in range(size)], np.uint64)
        keys = (_CODES[codes] * step).sum(axis=1, dtype=np.uint64)
        ids, odd, tables = np.array(ids, np.int32), 0x9E3779B97F4A7C15, []
        while len(ids) or not tables:
            bits = max(8, int(len(ids)).bit_length() + 4)
            slot = (keys * np.uint64(odd)) >> np.uint64(64 - bits)
            _, first = np.unique(slot, return_index=True)
            key, value = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            key[slot[first]], value[slot[first]] = keys[first], ids[first]
            tables.append((np.uint64(odd), np.uint64(64 - bits), key, value))
            rest = np.delete(np.arange(len(ids)), first)
            keys, ids, odd = keys[rest], ids[rest], odd * 0x2545F4914F6CDD1D % (1 << 64) | 1
        return tables

    def _find(self, size: int, key: np.ndarray) -> np.ndarray:
        found = None
        for odd, shift, keys, values in self.tables[size]:
            slot = (key * odd) >> shift
            value = np.where(keys[slot] == key, values[slot], -1)
            found = value if found is None else np.maximum(found, value)
        return found

    def run(self, data: np.ndarray, start: np.ndarray, size: np.ndarray,
            times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log-probability of each word; with ``times`` also the expected use of each piece, and
        last the number of words. Words may not be empty."""
        out = np.empty(len(start))
        used = None if times is None else np.zeros(len(self.weight) + 1)
        order = np.argsort(-size, kind="stable")
        # Words that are very long are rare: place by place they would be many steps for few words.
        long = int((size > LONG).sum())
        for k in order[:long]:
            out[k] = self._long(data[start[k]:start[k] + size[k]],
                                0.0 if times is None else float(times[k]), used)
        order = order[long:]
        for k in range(0, len(order), BLOCK):
            part = order[k:k + BLOCK]
            out[part] = self._block(data, start[part], size[part], None if times is None
                                    else times[part], used)
        return out, used

    def _long(self, word: np.ndarray, times: float, used) -> float:
        """One long word: its pieces are found at all places at once, then summed up edge by edge."""
        n = len(word) + 1
        step, back = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, f, np.uint64))])
                      for f in (_STEP, _BACK))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[np.concatenate([[32], word])] * step[:n], out=sums[1:])
        begins, ends, names = [], [], []
        for length in self.tables:
            if length > n:
                break
            piece = self._find(length, (sums[length:] - sums[:-length]) * back[:n - length + 1])
            at = np.flatnonzero(piece >= 0)
            begins.append(at)
            ends.append(at + length)
            names.append(piece[at])
        begins, ends, names = map(np.concatenate, (begins, ends, names))
        order = np.lexsort((begins, ends))
        begins, ends, names = begins[order], ends[order], names[order]
        weight = self.weight[names]
        alpha = _add_up(n, begins.tolist(), ends.tolist(), weight.tolist())
        if used is not None:
            # The same from the other end: edges by their start, the last first.
            turn = np.lexsort((-ends, -begins))
            beta = _add_up(n, (n - ends[turn]).tolist(), (n - begins[turn]).tolist(), weight[turn].tolist())
            share = np.exp(np.array(alpha)[begins] + weight + np.array(beta)[n - ends] - alpha[n])
            used[:-1] += np.bincount(names, share * times, len(self.weight))
            used[-1] += times
        return alpha[n] + self.pieces.stop

    def _block(self, data, start, size, times, used) -> np.ndarray:
        """One block of words, longest first, so that those that reach a place come first."""
        n = len(start)
        longest = int(size[0]) + 1
        reach = [n, *(int(np.searchsorted(-size, -t, "right")) for t in range(longest))]
        sums = [np.zeros(n, np.uint64), np.full(n, _CODES[32])]
        step = 1
        for t in range(1, longest):
            step = step * _STEP % (1 << 64)
            m = reach[t + 1]
            sums.append(sums[t][:m] + _CODES[data[start[:m] + t - 1]] * np.uint64(step))
        back = [1]
        for _ in range(longest):
            back.append(back[-1] * _BACK % (1 << 64))
        alpha = [np.zeros(n)]
        edges = []
        for end in range(1, longest + 1):
            m = len(sums[end])
            terms, here = [], []
            for length in self.tables:
                if length > end:
                    break
                begin = end - length
                key = (sums[end] - sums[begin][:m]) * np.uint64(back[begin])
                piece = self._find(length, key)
                here.append((begin, piece))
                terms.append(alpha[begin][:m] + self.weight[piece])
            edges.append(here if times is not None else None)
            alpha.append(_log_sum(terms))
        total = np.empty(n)
        for end in range(longest, 0, -1):
            done = np.flatnonzero(size + 1 == end) if end < longest else np.flatnonzero(size + 1 >= end)
            total[done] = alpha[end][done]
        if times is not None:
            beta = [np.full(len(a), -np.inf) for a in alpha]
            for end in range(longest, 0, -1):
                m = len(alpha[end])
                beta[end][size[:m] + 1 == end] = 0
                for begin, piece in edges[end - 1]:
                    through = beta[end] + self.weight[piece]
                    share = np.exp(alpha[begin][:m] + through - total[:m]) * times[:m]
                    used[:-1] += np.bincount(piece % len(self.weight), share, len(self.weight))
                    beta[begin][:m] = np.logaddexp(beta[begin][:m], through)
            used[-1] += times.sum()
        return total + self.pieces.stop


def _add_up(n: int, begins: list, ends: list, weights: list) -> list:
    """Log of the summed weight of all ways to each place; edges in the order of their ends."""
    total = [-math.inf] * (n + 1)
    total[0] = 0.0
    for s, e, w in zip(begins, ends, weights, strict=True):
        way, old = total[s] + w, total[e]
        if way > old:
            way, old = old, way
        # ``old`` is the larger one.
        total[e] = old + math.log1p(math.exp(way - old)) if way > -math.inf else old
    return total


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    stack = np.array(terms)
    top = stack.max(axis=0)
    return top + np.log(np.exp(stack - top).sum(axis=0))


def refit(pieces: Pieces, used: np.ndarray) -> Pieces:
    """Weights by expected use; every piece keeps a little mass, so that any word stays possible."""
    mass, count = used[:-2] + SMOOTHING, used[-1]
    if not count:
        return pieces
    return normalized(pieces.names, mass, float((count + 1) / (used[:-2].sum() + 2)))


@dataclass(frozen=True)
class Model:
    """What the scoring of a document needs besides the counts of infrequent words."""
    pieces: Pieces
    frequent: np.ndarray  # hashes, sorted
    counts: np.ndarray  # of the frequent words
    tokens: int  # of the training documents, ends included
    ends: int
    weight: float  # of the lattice
    words: DataFrame | None = None  # w (hash), word, n: all words of the training documents


def _distinct(piece: pa.RecordBatch, row_times: np.ndarray | None = None):
    """Distinct words of a piece: hash, one place and the size of each, and how often they occur."""
    data, offsets = row_bytes(piece.column("text"))
    data = LOWER[data]
    code, start, end, row = words(data, offsets)
    keys, first, at = np.unique(code, return_index=True, return_inverse=True)
    times = np.bincount(at, None if row_times is None else row_times[row], len(keys))
    return data, keys, start[first], (end - start)[first], times


def learn(docs: DataFrame, path: str) -> Model:
    """One reading of the training documents for the words' counts, then rounds over all words."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    counts = settle(_counted(docs), "word-counts")
    tokens, once = counts.agg(F.sum("n"), F.count(F.when(F.col("n") == 1, 1))).first()
    model = vocabulary(path)
    if tokens:
        for _ in range(ROUNDS):
            model = refit(model, _uses(counts, model))
    frequent = _frequent(_by_hash(counts))
    known = frequent["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    ends = docs.count()
    return Model(model, known[order], frequent["n"].to_numpy(float)[order], (tokens or 0) + ends, ends,
                 max(1.0, float(once)), counts)


def _by_hash(counts: DataFrame) -> DataFrame:
    return counts.groupBy("w").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame):
    """The words of the highest counts, at most FREQUENT: those above a bound taken from a histogram of
    the counts (16 bins to a doubling), so that no task sends more than is kept."""
    bin_ = F.floor(F.log2("n") * 16).cast("int")
    seen, least = 0, None
    for row in sorted(counts.groupBy(bin_.alias("bin")).count().collect(), reverse=True):
        seen += row["count"]
        if seen > FREQUENT:
            break
        least = row["bin"]
    return counts.filter(bin_ >= least if least is not None else F.lit(False)).toPandas()


def _counted(docs: DataFrame) -> DataFrame:
    """Each word once: its hash, its bytes and how often it occurs."""
    def count(batches):
        held = []

        def flush():
            # Words of several pieces are summed up before they are sent.
            sizes = np.concatenate([h[3] for h in held])
            keys = np.concatenate([h[1] for h in held])
            base = np.cumsum([0, *(len(h[0]) for h in held)])
            start = np.concatenate([h[2] + b for h, b in zip(held, base, strict=False)])
            data = np.concatenate([h[0] for h in held])
            keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
            times = np.bincount(at, np.concatenate([h[4] for h in held]), len(keys))
            start, size = start[first], sizes[first]
            ends = np.concatenate([[0], np.cumsum(size)])
            flat = data[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
            names = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [
                None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), names, pa.array(times.astype(np.int64))], ["w", "word", "n"])

        for batch in batches:
            for piece in pieces(batch, "text"):
                held.append(_distinct(piece))
                if len(held) == 16:
                    yield flush()
        if held:
            yield flush()

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return (docs.mapInArrow(count, "w long, word binary, n long")
            .groupBy("w", "word").agg(F.sum("n").alias("n")))


def _uses(counts: DataFrame, model: Pieces) -> np.ndarray:
    """Expected use of each piece over all words, and last the number of words."""
    shared = counts.sparkSession.sparkContext.broadcast(model)

    def use(batches):
        lattice = Lattice(shared.value)
        used = np.zeros(len(lattice.weight) + 1)
        held, n, bytes_held = [], 0, 0

        def flush():
            data = np.concatenate([h[0] for h in held])
            size = np.concatenate([h[1] for h in held])
            used[:] += lattice.run(data, np.cumsum(size) - size, size,
                                   np.concatenate([h[2] for h in held]))[1]
            held.clear()

        for batch in batches:
            data, offsets = row_bytes(batch.column("word"))
            held.append((data, np.diff(offsets), batch.column("n").to_numpy().astype(float)))
            n, bytes_held = n + batch.num_rows, bytes_held + len(data)
            if n >= 4 * BLOCK or bytes_held >= 4 * PIECE_BYTES:
                flush()
                n, bytes_held = 0, 0
        if held:
            flush()
        key = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(used[key])], ["key", "n"])

    spark = counts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", WORD_ROWS)
    # At most one row per piece comes to the driver.
    found = counts.select("word", "n").mapInArrow(use, "key int, n double").groupBy("key").agg(
        F.sum("n").alias("n")).toPandas()
    used = np.zeros(len(model.names) + 2)
    used[found["key"].to_numpy(int)] = found["n"]
    return used


_remembered: dict = {}


def _probabilities(lattice: Lattice, token, data, keys, start, size) -> np.ndarray:
    """Lattice log-probabilities of distinct words (sorted hashes), remembered between pieces."""
    if _remembered.get("token") != token:
        _remembered.update(token=token, keys=np.zeros(0, np.uint64), values=np.zeros(0))
    known, values = _remembered["keys"], _remembered["values"]
    out = np.empty(len(keys))
    place = np.searchsorted(known, keys)
    hit = np.zeros(len(keys), bool)
    if len(known):
        hit = known[np.minimum(place, len(known) - 1)] == keys
        out[hit] = values[place[hit]]
    new = np.flatnonzero(~hit)
    out[new], _ = lattice.run(data, start[new], size[new])
    if len(known) + len(new) > REMEMBERED:
        known, values, place = keys[:0], values[:0], np.zeros(len(keys), int)
    _remembered["keys"] = np.insert(known, place[new], keys[new])
    _remembered["values"] = np.insert(values, place[new], out[new])
    return out


def score(docs: DataFrame, training: str, model: Model) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``training`` is an SQL condition on the rows whose words ``model`` was learned from; they are counted
    here only if the model does not bring their counts.
    """
    spark = docs.sparkSession
    model_id = id(model)
    counts = model.words if model.words is not None else settle(_counted(docs.filter(training).select(
        F.coalesce("text", F.lit("")).alias("text"))), "word-counts")
    # The table of counts stays where it is; tasks get the rest of the model.
    shared = spark.sparkContext.broadcast(replace(model, words=None))
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.hash("text").alias("tag"),
                       F.xxhash64("doc_id", "text").alias("spread"))
    names = ["w", "doc_id", "tag", "times", "log_p", "base", "model", "known", "tokens"]

    def work(piece):
        own = shared.value
        key = (model_id, spark_id)
        if _remembered.get("model") != key:
            _remembered.clear()
            _remembered.update(model=key, lattice=Lattice(own.pieces))
        data, offsets = row_bytes(piece.column("text"))
        data = LOWER[data]
        code, start, end, row = words(data, offsets)
        distinct, first, at = np.unique(code, return_index=True, return_inverse=True)
        log_p = _probabilities(_remembered["lattice"], key, data, distinct, start[first],
                               (end - start)[first])
        pair, times = np.unique(row * len(distinct) + at, return_counts=True)
        row, at = (pair // len(distinct), pair % len(distinct)) if len(pair) else (pair, pair)
        # Frequent words count at once, the others go to where all their counts meet.
        place = np.minimum(np.searchsorted(own.frequent, distinct), max(len(own.frequent) - 1, 0))
        hit = own.frequent[place] == distinct if len(own.frequent) else np.zeros(len(distinct), bool)
        count = np.where(hit, own.counts[place] if len(own.frequent) else 0, 0)
        # In log space where only the lattice counts: a long word's probability may be below 1e-308.
        mass = np.where(count > 0, np.log10(np.maximum(count + own.weight * np.exp(log_p), 1)),
                        np.log10(own.weight) + log_p / np.log(10))
        done = hit[at]
        rows = piece.num_rows

        def summed(value):
            return np.bincount(row[done], (value[at] * times)[done], rows).astype(float)

        total = np.bincount(row, times, rows)
        yield batch(piece, np.arange(rows), None, np.zeros(rows), np.zeros(rows),
                    summed(np.log10(count + SMOOTHING)), summed(mass),
                    summed((count > 0).astype(float)), total)
        left = ~done
        none = np.zeros(int(left.sum()))
        yield batch(piece, row[left], distinct[at[left]], times[left], log_p[at[left]],
                    none, none, none, none)

    def batch(piece, row, code, times, log_p, base, value, known, tokens):
        take = pa.array(row)
        # The documents' own rows are spread evenly.
        code = piece.column("spread") if code is None else pa.array(code.view(np.int64))
        return pa.RecordBatch.from_arrays(
            [code, piece.column("doc_id").take(take),
             piece.column("tag").take(take), pa.array(times.astype(np.int64)),
             pa.array(log_p), pa.array(base),
             pa.array(value), pa.array(known.astype(np.int64)), pa.array(tokens.astype(np.int64))],
            names)

    spark_id = spark.sparkContext.applicationId
    pairs = map_pieces(read, work, f"w long, doc_id {kind}, tag int, times long, log_p double, "
                                   "base double, model double, known long, tokens long")
    counted = pairs.join(_by_hash(counts), "w", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    here = F.col("times") > 0
    log_p = F.col("log_p")
    mass = F.when(F.col("c") > 0, F.log10(F.col("c") + model.weight * F.exp(log_p))).otherwise(
        float(np.log10(model.weight)) + log_p / float(np.log(10)))
    by_doc = settle(counted.groupBy("doc_id", "tag").agg(
        F.sum(F.col("base") + F.when(here, F.col("times") * F.log10(F.col("c") + SMOOTHING)).otherwise(0.0))
        .alias("base"),
        F.sum(F.col("model") + F.when(here, F.col("times") * mass).otherwise(0.0)).alias("model"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.when(here, 0).otherwise(1)).alias("copies")), "word-sums")
    types = counts.count() + (model.ends > 0)
    tokens = model.tokens
    end_base = float(np.log10(model.ends + SMOOTHING))
    base_total = float(np.log10(tokens + SMOOTHING * (types + 1)))
    total = float(np.log10(tokens + model.weight + 1))
    copies = F.col("copies")
    n = F.col("tokens") / copies + 1
    rows = by_doc.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return rows.select(
        "doc_id", n.cast("long").alias("n_tokens"),
        (F.col("known") / copies + int(model.ends > 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") / copies + end_base - n * base_total).alias("base_score"),
        (F.col("model") / copies + float(np.log10(model.ends + 1)) - n * total).alias("score"))


def scores(docs: DataFrame, path: str) -> DataFrame:
    out = held_out("doc_id", 10, 0)
    model = learn(docs.filter(~out), path)
    train = "not coalesce(crc32(cast(doc_id as string)) % 10 = 0, false)"
    return score(docs, train, model).withColumn("held_out", out)
