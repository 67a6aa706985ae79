"""Byte-pair encoding by longest matches with backtracking, and decoding by an offset table.

All tokens are matched at once by an Aho-Corasick automaton. From each position the longest token
is tried first; it stands only if it is compatible with the token before it, i.e. if merging the
text of both would leave exactly these two. A dead end takes back the last token and tries the
next shorter one. A position that failed is never entered again, so the work is linear in the
text. The result equals that of the merge rules applied in order (Tests compare the two).

Texts: null counts as empty and gives no token; the whole text is encoded. Rows keep all their
columns, repeated rows are encoded each; the new columns replace any of the same name.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections import Counter
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import list_column, map_pieces, row_bytes

# Distinct words whose tokens one Python process remembers, and the longest word remembered.
REMEMBERED, REMEMBERED_LENGTH = 500_000, 64
# Compatible and incompatible token pairs one Python process remembers.
REMEMBERED_PAIRS = 2_000_000

# The words of the vocabulary's own splitting rule.
WORDS = regex.compile(r"\p{L}+|\p{N}|'(?:s|t|re|ve|m|ll|d)|[^\p{White_Space}\p{L}\p{N}]+")
# Characters that split() takes for white space and the rule does not.
NOT_SPACE = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of one vocabulary file (``model.vocab``, ``model.merges``, ``added_tokens``)."""

    def __init__(self, text: str):
        file = json.loads(text)
        model = file["model"]
        self.end = model.get("end_of_word_suffix") or ""
        names = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.names = {i: s for s, i in names.items()} | {i: s for s, i in self.special.items()}
        alphabet = byte_alphabet()
        # Symbols: a byte within a word, or (256 higher) the byte that ends it.
        self.symbols = {}
        for name, i in names.items():
            last = 256 if self.end and name.endswith(self.end) and name != self.end else 0
            own = [alphabet[c] for c in (name[:-len(self.end)] if last else name)]
            own[-1] += last
            self.symbols[i] = "".join(map(chr, own))
        self.single = {s: i for i, s in self.symbols.items() if len(s) == 1}
        self.joined, self.parts, self.rank = {}, {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            whole = names[a + b]
            self.joined.setdefault((names[a], names[b]), (rank, whole))
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (names[a], names[b]), rank
        usable = {s: i for i, s in self.symbols.items()
                  if len(s) == 1 or (i in self.parts and self.merged(s) == [i])}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        # The automaton looks through a node's branches in the order they were added in.
        common = Counter(c for s in usable for c in s)
        for s, i in sorted(usable.items(), key=lambda x: -common[x[0][0]]):
            self.automaton.add_word(s, (i, len(s)))
            self.shorter[i] = next((usable[s[:k]] for k in range(len(s) - 1, 0, -1)
                                    if s[:k] in usable), None)
        self.automaton.make_automaton()
        self.length = {i: len(s) for i, s in self.symbols.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        size = max(self.names) + 1
        pieces = [(self.names.get(i, "") + " ").encode() for i in range(size)]
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.cumsum([0, *map(len, pieces)])
        # Tokens of chunks seen: a full younger part takes the place of the older one.
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, symbols: str) -> list[int]:
        """The tokens of a word by applying the lowest merge first; for short words only."""
        ids = [self.single[s] for s in symbols]
        while len(ids) > 1:
            rank, at = min(((self.joined.get(p, (1 << 60, 0))[0], k)
                            for k, p in enumerate(zip(ids, ids[1:], strict=False))))
            if rank == 1 << 60:
                break
            ids[at:at + 2] = [self.joined[ids[at], ids[at + 1]][1]]
        return ids

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border of the two tokens comes before it is too late.

        Both tokens are taken apart again, the latest merge first (of equal ones the right token's,
        as merges of one rule run from the left). A merge across the border that is due before
        the merge just taken back would have happened instead.
        """
        key = left, right
        known = self.pairs.get(key)
        if known is not None:
            return known
        joined, parts, rank = self.joined, self.parts, self.rank
        due, answer = 1 << 60, True
        while True:
            across = joined.get((left, right))
            if across is not None and across[0] < due:
                answer = False
                break
            left_rank, right_rank = rank.get(left, -1), rank.get(right, -1)
            if left_rank < 0 and right_rank < 0:
                break
            if left_rank > right_rank:
                due, left = left_rank, parts[left][1]
            else:
                # The border's merge would start before the right token's: equal rank wins too.
                due, right = right_rank + 1, parts[right][0]
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        self.pairs[key] = answer
        return answer

    def word(self, symbols: str) -> list[int]:
        n = len(symbols)
        longest = [None] * n
        for end, (token, size) in self.automaton.iter(symbols):
            longest[end - size + 1] = token
        ids, at, token = [], 0, longest[0]
        dead = bytearray(n + 1)
        length, shorter, compatible = self.length, self.shorter, self.compatible
        while True:
            end = at + length[token]
            if not dead[end] and (not ids or compatible(ids[-1], token)):
                ids.append(token)
                if end == n:
                    return ids
                at, token = end, longest[end]
                continue
            token = shorter[token]
            while token is None:
                dead[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]

    def chunk(self, chunk: str) -> bytes:
        """Tokens (as 4-byte integers) of text without white space."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        ids = array("i")
        for word in WORDS.findall(chunk.lower()):
            own = word if word.isascii() else word.encode().decode("latin-1")
            ids.extend(self.word(own[:-1] + chr(ord(own[-1]) + 256) if self.end else own))
        return ids.tobytes()

    def remember(self, chunk: str) -> bytes:
        ids = self.older.get(chunk) or self.chunk(chunk)
        if len(chunk) <= REMEMBERED_LENGTH:
            if len(self.remembered) >= REMEMBERED:
                self.remembered, self.older = {}, self.remembered
            self.remembered[chunk] = ids
        return ids

    def plain(self, text: str) -> bytes:
        chunks = [c for c in SPACE.split(text) if c] if NOT_SPACE.search(text) else text.split()
        known = self.remembered.get
        return b"".join([known(c) or self.remember(c) for c in chunks])

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            split = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text)
            raw = b"".join(np.array([self.special[s]], np.int32).tobytes() if k % 2
                           else self.plain(s) for k, s in enumerate(split))
        else:
            raw = self.plain(text)
        return np.frombuffer(raw, np.int32)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the token names, joined by blanks, and the end offsets of each row."""
        size = self.offsets[ids + 1] - self.offsets[ids]
        stop = np.concatenate([[0], np.cumsum(size)])
        shift = np.repeat(self.offsets[ids] - stop[:-1], size)
        data = self.bytes[np.arange(stop[-1]) + shift]
        # The blank after the last token of a row goes.
        row_stop = stop[ends]
        keep = np.ones(len(data), bool)
        keep[row_stop[1:][np.diff(ends) > 0] - 1] = False
        return data[keep], row_stop - np.concatenate([[0], np.cumsum(np.diff(ends) > 0)])


_loaded: dict[str, Vocabulary] = {}


def _vocabulary(text: str) -> Vocabulary:
    if text not in _loaded:
        _loaded.clear()
        _loaded[text] = Vocabulary(text)
    return _loaded[text]


def _with(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + list(new.values()),
                                      keep + list(new))


def _schema(df: DataFrame, keep: list[str], new: str) -> str:
    own = ", ".join(f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return f"{own}, {new}" if own else new


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids",
           decoded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add the token ids of ``text`` (an array, empty for null), and ``decoded`` if named.

    ``vocabulary`` is the path of a tokenizer file; the driver reads it, and it reaches the
    executors as a broadcast (its size does not depend on the data). ``keep`` names the columns to
    return besides the new ones (default: all).
    """
    file = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text("utf-8"))
    keep = [c for c in (df.columns if keep is None else keep) if c not in (ids, decoded)]

    def work(batch):
        model = _vocabulary(file.value)
        found = [model.encode(t or "") for t in batch.column(text).to_pylist()]
        ends = np.cumsum([0, *map(len, found)])
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        new = {ids: list_column(flat, ends, pa.int32())}
        if decoded:
            new[decoded] = _strings(*model.decode(flat, ends))
        yield _with(batch, keep, new)

    schema = _schema(df, keep, f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else ""))
    return map_pieces(df.select(*dict.fromkeys([*keep, text])), work, schema, text)


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def decode(df: DataFrame, vocabulary: str, ids: str = "token_ids",
           decoded: str = "decoded") -> DataFrame:
    """Add the text of token ids: their names joined by blanks; null or no ids give ''."""
    file = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text("utf-8"))
    keep = [c for c in df.columns if c != decoded]

    def work(batches):
        for batch in batches:
            lists = batch.column(ids)
            ends = np.concatenate([[0], np.cumsum([len(x or ()) for x in lists.to_pylist()])])
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            text = _strings(*_vocabulary(file.value).decode(flat, ends.astype(np.int64)))
            yield _with(batch, keep, {decoded: text})

    return df.mapInArrow(work, _schema(df, keep, f"`{decoded}` string"))


def digests(df: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: number of tokens, and digests of its ids and of its decoded text."""
    coded = encode(df, vocabulary, decoded="decoded", keep=["doc_id"])
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
