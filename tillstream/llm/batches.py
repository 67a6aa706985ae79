"""Helpers for Arrow batches of texts: bounded pieces, raw bytes, and hashes of byte ranges.

A text batch is seen as one byte buffer with row offsets, so that words, lines and windows are
found and hashed with whole-array operations and no Python string is made per word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text bytes worked on at once; one longer text is a piece of its own.
PIECE_BYTES = 2 << 20
# Rows sent to Python at once: texts may be long, so far fewer than Spark's default.
ROWS_PER_BATCH = 512

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
_powers = np.ones(1, np.uint64)

# Words end at a space or one of the control characters 9 to 13; fixed by the contracts.
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def map_pieces(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
               schema: str, text: str = "text") -> DataFrame:
    """Apply ``work`` to row pieces of at most ``PIECE_BYTES`` of text (or one row)."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text):
                yield from work(piece)

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return df.mapInArrow(run, schema)


def sampled(share: float, *key: str) -> Column:
    """Whether a row is in a sample of about ``share`` of all, by a hash of its key; finer than any table."""
    return F.shiftrightunsigned(F.xxhash64(*key), 2) < F.lit(int(share * 2**62))


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    offsets = row_bytes(batch.column(text))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + PIECE_BYTES, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def row_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows in order, and the n + 1 row offsets; null counts as empty."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def _times(a: np.uint64, b: np.uint64) -> np.uint64:
    return np.uint64(int(a) * int(b) % (1 << 64))


def powers(n: int) -> np.ndarray:
    """The first ``n`` or more powers of the multiplier, modulo 2**64."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * _times(_powers[-1], _MULTIPLIER)])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RangeHasher:
    """64-bit hashes of any byte ranges of a buffer, equal for equal bytes in any buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * powers(n)[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        # Multiplying by the power that is left of a fixed total makes equal ranges equal.
        shift = _inverse_powers(len(self.sums))[start]
        return mix((self.sums[end] - self.sums[start]) * shift
                   + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_inverses = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverses
    while len(_inverses) < n:
        _inverses = np.concatenate([_inverses, _inverses * _times(_inverses[-1], _INVERSE)])
    return _inverses


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross rows: start, end, and row of each."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:n]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


# Longer words are hashed one by one: they are few for their bytes.
LONG_WORD = 256
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, block after block of eight bytes, each mixed in before the next:
    no sum over the bytes, so that words made of the same letters in another order stay apart."""
    size = end - start
    code = mix(size.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    left = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    at = start[left]
    while len(left):
        rest = end[left] - at
        block = blocks[at] & _FIRST_BYTES[np.minimum(rest, 8)]
        code[left] = mix((code[left] ^ block) * _MULTIPLIER + np.uint64(0x9FB21C651E98DF25))
        more = rest > 8
        left, at = left[more], at[more] + 8
    for k in np.flatnonzero(size > LONG_WORD):
        code[k] = int.from_bytes(hashlib.blake2b(data[start[k]:end[k]], digest_size=8).digest(), "little")
    return code


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, start, end and row of each blank-separated word of the buffer, as it stands."""
    start, end, row = runs(~SPACES[data], offsets)
    return word_codes(data, start, end), start, end, row


def row_ends(row: np.ndarray, rows: int) -> np.ndarray:
    """For items sorted by row, where each row's items start, and the end: rows + 1 offsets."""
    return np.searchsorted(row, np.arange(rows + 1))


def list_column(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))
