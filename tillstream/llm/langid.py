"""Language proportions of documents by expectation-maximisation over n-gram likelihoods.

A language is a distribution over byte trigrams (hashed into a fixed number of cells), counted over
all training rows. A document is a mixture: expectation-maximisation finds the proportions under
which its trigrams are likeliest. Of the nested sets "the k languages of largest proportion", the
one with the largest penalised likelihood is kept.

Texts that are null or hold no letter are ``und`` with score 0 and no languages; so is everything
if nothing can be learned. Rows with a null language or text teach nothing. Equal proportions go to
the name that sorts first. Repeated rows are answered each; other columns are kept, and the new
columns replace any of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import LOWER, map_pieces, pieces, row_bytes

CELL_BITS = 15
CELLS = 1 << CELL_BITS
# Weight of one unseen trigram, and cost of one more language per log(trigrams): trigrams overlap,
# so they carry less evidence than as many independent draws.
SMOOTHING, PENALTY = 0.1, 4.0
ROUNDS = 12

_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


@dataclass(frozen=True)
class Model:
    """Names in order, and the log-probability of each cell (rows) in each language (columns)."""
    names: list[str]
    log_p: np.ndarray


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of each trigram. Each row is framed by blanks; anything but a letter is one."""
    rows = len(offsets) - 1
    framed = np.full(len(data) + rows + 1, 32, np.uint32)
    size = np.diff(offsets)
    row = np.repeat(np.arange(rows), size)
    framed[np.arange(len(data)) + row + 1] = _LETTERS[data]
    middle = np.arange(len(data)) + row + 1
    left, here, right = framed[middle - 1], framed[middle], framed[middle + 1]
    # A trigram with two blanks in a row tells nothing.
    told = (here != 32) | ((left != 32) & (right != 32))
    code = (left | here << np.uint32(8) | right << np.uint32(16))[told]
    cell = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)
    return row[told], cell.astype(np.int64)


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count the trigrams of every row; collects one number per language and cell."""
    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                row, cell = trigrams(*row_bytes(piece.column("text")))
                names = piece.column("lang").dictionary_encode()
                code = names.indices.to_numpy(zero_copy_only=False)[row]
                for k, name in enumerate(names.dictionary.to_pylist()):
                    own = found.setdefault(name, np.zeros(CELLS, np.int64))
                    own += np.bincount(cell[code == k], minlength=CELLS)
        for name, own in found.items():
            cell = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cell), pa.string()), pa.array(cell.astype(np.int32)),
                 pa.array(own[cell])], ["lang", "cell", "n"])

    taught = df.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    taught = taught.filter("text is not null and lang is not null")
    rows = (taught.mapInArrow(count, "lang string, cell int, n long")
            .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(rows["lang"].unique())
    counts = np.zeros((CELLS, len(names)))
    at = {n: k for k, n in enumerate(names)}
    counts[rows["cell"].to_numpy(int), rows["lang"].map(at).to_numpy(int)] = rows["n"]
    counts += SMOOTHING
    return Model(names, np.log(counts / counts.sum(axis=0)) if names else counts)


def _mixtures(row: np.ndarray, cell: np.ndarray, rows: int, log_p: np.ndarray) -> np.ndarray:
    """Proportions (rows by languages) of the chosen sets; zeros where there is no trigram."""
    languages = log_p.shape[1]
    key, times = np.unique(row * CELLS + cell, return_counts=True)
    doc, cells = key // CELLS, key % CELLS
    has, first = np.unique(doc, return_index=True)
    result = np.zeros((rows, languages))
    if not len(has):
        return result
    doc = np.repeat(np.arange(len(has)), np.diff(np.append(first, len(doc))))
    # Only ratios between languages matter, so each trigram's best language counts as 1.
    like = log_p[cells]
    like = np.exp(like - like.max(axis=1, keepdims=True))
    total = np.add.reduceat(times, first).astype(float)
    times = times.astype(float)

    def fit(share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(rounds):
            part = like * share[doc]
            part *= (times / part.sum(axis=1))[:, None]
            share = np.add.reduceat(part, first, axis=0) / total[:, None]
        return share, np.add.reduceat(times * np.log((like * share[doc]).sum(axis=1)), first)

    full, _ = fit(np.full((len(has), languages), 1 / languages), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.full(len(has), -np.inf)
    chosen = np.zeros_like(full)
    for size in range(1, languages + 1):
        share = np.zeros_like(full)
        top = order[:, :size]
        np.put_along_axis(share, top, np.take_along_axis(full, top, 1) + 1e-9, 1)
        share /= share.sum(axis=1, keepdims=True)
        share, value = fit(share, 0 if size == 1 else ROUNDS // 2)
        value = value - PENALTY * size * np.log(total + 1)
        better = value > best
        chosen[better], best[better] = share[better], value[better]
        if not better.any():
            break
    result[has] = chosen
    return result


def identify(df: DataFrame, model: Model, text: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score`` (its proportion) and ``languages`` (name to proportion)."""
    new = ["lang_pred", "score", "languages"]
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    shared = df.sparkSession.sparkContext.broadcast(model)
    # A name that no column has.
    letter = "_".join(["letter", *df.columns])

    def work(piece):
        names, log_p = shared.value.names, shared.value.log_p
        told = piece.column(letter).to_numpy(zero_copy_only=False)
        share = np.zeros((piece.num_rows, len(names)))
        if names:
            share = _mixtures(*trigrams(*row_bytes(piece.column(text))), piece.num_rows, log_p)
            share[~told] = 0
        known = share.sum(axis=1) > 0
        top = share.argmax(axis=1) if names else np.zeros(piece.num_rows, int)
        label = np.where(known, np.array([*names, ""], object)[top], "und")
        at, which = np.nonzero(share > 0)
        ends = np.searchsorted(at, np.arange(piece.num_rows + 1)).astype(np.int32)
        mixed = pa.MapArray.from_arrays(pa.array(ends), pa.array([names[k] for k in which], pa.string()),
                                        pa.array(share[at, which], pa.float64()))
        score = share.max(axis=1, initial=0.0)
        yield pa.RecordBatch.from_arrays(
            [piece.column(c) for c in keep]
            + [pa.array(label, pa.string()), pa.array(np.minimum(score, 1.0)), mixed], keep + new)

    own = "".join(f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    read = df.select(*dict.fromkeys([*keep, text]),
                     F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(letter))
    return map_pieces(read, work, own + "lang_pred string, score double, languages map<string,double>",
                      text)


def held_out(column: str, parts: int, part: int):
    """Whether crc32 of the id, as text, leaves the remainder ``part`` of ``parts``."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts == part, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    out = held_out("doc_id", 4, 2)
    model = learn(docs.filter(~out))
    return identify(docs, model, keep=["doc_id"]).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score", "languages")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows whose language can be told; the others (no letter, null) are rejected."""
    model = learn(docs.filter(~held_out("doc_id", 4, 2)))
    return identify(docs, model).filter(F.col("lang_pred") != "und").select(*docs.columns)
