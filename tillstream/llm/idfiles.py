"""Token ids as binary files: one compressed frame per document, one dictionary shared by all.

A folder holds

* ``dictionary-<sha256>``: a zstandard dictionary trained on serialized id arrays;
* ``ids-<run>.bin``, one per range of doc_ids: ``MAGIC``, the 32 bytes of the dictionary's hash, and
  one frame per document, in ascending order of doc_id. A frame holds the document's ids, as
  little-endian unsigned 32-bit integers, with a checksum;
* ``ids-<run>.idx``: a fixed-width record (``RECORD``) per document, so that one short document is
  found by bisection and read with two seeks;
* ``manifest``: a Parquet table of the files in order, with the number of ids before each.

A task writes files under names of its own and returns their names; only names that reach the
manifest count, so a task that is lost or run twice leaves no trace in the data. Files are written
and read through ``pyarrow.fs``; the folder must be one that every executor reaches by that path.

Rows: a null text is empty, i.e. the end id alone; whole texts are encoded. Null doc_ids come first.
Rows of one doc_id are documents each, ordered by the checksum of their ids. Other columns, whatever
their names, are not written. An empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm.batches import LOWER, SPACES, row_bytes
from tillstream.session import run_dir, settle

MAGIC = b"TSIDS001"
RECORD = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("start", "<u8"), ("tokens", "<u8")])
LEVEL = 3
# The dictionary: its size, and the bounded sample of text pieces (of all documents) it is trained on.
DICTIONARY_BYTES, SAMPLE_PIECES, PIECE_CHARS = 112_640, 1_000, 4_096
# Text worked on at once, index records read at once, and words one Python process remembers.
BATCH_BYTES, BLOCK, REMEMBERED = 8 << 20, 65_536, 400_000
# A blank before the marks that end a word changes no token: white space is dropped, and letter and
# mark never share a token. It halves the number of different words.
_MARKS = r"([a-zß-öø-ÿ])([.,!?;:]+)( |$)"
# Lower-case bytes with a blank for each white one: the vocabulary does not tell them apart.
_PLAIN = np.where(SPACES, np.uint8(32), LOWER)


class Encoder:
    """The tokenizer library over Arrow arrays of texts; each different word goes to it once."""

    def __init__(self, file: str):
        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Lower-case ASCII letters are one word as they stand and go straight to the model."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
            words = list(dict.fromkeys(words))
        known, other = self.known, []
        for word in words:
            if word in known:
                continue
            if word.isascii() and word.isalpha() and word.islower():
                known[word] = np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
            else:
                other.append(word)
        for word, found in zip(other, self.library.encode_batch_fast(other, add_special_tokens=False), strict=True):
            known[word] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the n + 1 offsets of the texts in them."""
        data, ends = row_bytes(texts)
        lower = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(_PLAIN[data]))
        odd = pa.array(np.zeros(len(texts), bool))
        for name in self.special:
            # A special token is one only as it is written; such texts are encoded as they are.
            odd = pc.or_(odd, pc.match_substring(lower, name.lower()))
        plain = pc.if_else(odd, "", lower) if pc.any(odd).as_py() else lower
        lists = pc.split_pattern(pc.replace_substring_regex(plain, _MARKS, r"\1 \2\3"), " ")
        words = lists.flatten().dictionary_encode()
        different = words.dictionary.to_pylist()
        self._learn(different)
        coded = [self.known[w] for w in different]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        table = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]),
                                              pa.array(np.frombuffer(b"".join(coded), "<u4")))
        at = words.indices.to_numpy(zero_copy_only=False)
        flat = table.take(words.indices).flatten().to_numpy(zero_copy_only=False)
        word_ends = np.concatenate([[0], np.cumsum(size[at])])
        ends = word_ends[np.asarray(lists.offsets)]
        rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(rows):
            own = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            for k in rows:
                own[k] = np.array(self.library.encode(texts[int(k)].as_py() or "", add_special_tokens=False).ids, "<u4")
            flat, ends = np.concatenate(own), np.cumsum([0, *map(len, own)])
        return flat, ends


_encoders: dict[str, Encoder] = {}


def _encoder(file: str) -> Encoder:
    if file not in _encoders:
        _encoders.clear()
        _encoders[file] = Encoder(file)
    return _encoders[file]


def _pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Row pieces of at most ``BATCH_BYTES`` of text, or one row."""
    for batch in batches:
        ends, start = row_bytes(batch.column(text))[1], 0
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, ends[start] + BATCH_BYTES, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def _serialized(file: str, texts: pa.Array, end: int) -> Iterator[bytes]:
    """The ids of each text and the end id, as little-endian unsigned 32-bit integers."""
    flat, ends = _encoder(file).encode(texts)
    raw, last, ends = flat.astype("<u4").tobytes(), np.array([end], "<u4").tobytes(), (4 * ends).tolist()
    for a, b in zip(ends, ends[1:], strict=False):
        yield raw[a:b] + last


# the dictionary

def train(docs: DataFrame, file, end: int) -> bytes:
    """A dictionary trained on the id arrays of ``SAMPLE_PIECES`` or so pieces of text.

    Every text is cut into pieces of ``PIECE_CHARS`` characters, and a hash of document and piece
    chooses among all of them, so each part of each document has the same chance. Where there are
    too few for the trainer, their bytes are the dictionary; without any text it is empty.
    """
    size = F.greatest(F.lit(0), F.ceil(F.length("text") / F.lit(PIECE_CHARS)).cast("int"))
    total = docs.agg(F.sum(size)).first()[0] or 0
    if not total:
        return b""
    below = int(min(1.0, SAMPLE_PIECES / total) * 2**62)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", F.length("text"), "piece"), 2)
    some = (docs.filter(F.length("text") > 0)
            .select("doc_id", "text", F.explode(F.sequence(F.lit(1), size)).alias("piece"))
            .filter(chance <= below)
            .select(F.substring("text", (F.col("piece") - 1) * PIECE_CHARS + 1, F.lit(PIECE_CHARS)).alias("text")))

    def work(batches):
        for piece in _pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(_serialized(file.value, piece.column("text"), end)), pa.binary())], ["ids"])

    samples = sorted(bytes(r["ids"]) for r in some.mapInArrow(work, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


# files

def _at(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder.removeprefix("file:")


def _put(folder: str, name: str, data: bytes) -> None:
    system, path = _at(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def _get(folder: str, name: str) -> bytes:
    system, path = _at(folder)
    with system.open_input_stream(f"{path}/{name}") as source:
        return source.read()


MANIFEST = ("shard long, file string, first_id long, last_id long, nulls long, documents long, tokens long, "
            "bytes long, dictionary string")


def write(docs: DataFrame, vocabulary: str, folder: str, end: int = 1) -> None:
    """Encode ``docs`` (doc_id, text), append ``end`` to each, and write the files to ``folder``.

    Texts are read and encoded once; what is shuffled into order are compressed frames. Rows of one
    doc_id may be any part of the table: ranges are cut between them too.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    file = spark.sparkContext.broadcast(Path(vocabulary).read_text("utf-8"))
    raw = train(docs, file, end)
    name = hashlib.sha256(raw).hexdigest()
    _put(folder, f"dictionary-{name}", raw)
    shared = spark.sparkContext.broadcast(raw)

    def compress(batches):
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value), write_checksum=True)
        for piece in _pieces(batches, "text"):
            ids = list(_serialized(file.value, piece.column("text"), end))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                 pa.array([packer.compress(x) for x in ids], pa.binary())],
                ["doc_id", "tokens", "crc", "frame"])

    frames = settle(docs.mapInArrow(compress, "doc_id long, tokens long, crc long, frame binary")
                    .withColumn("row", F.monotonically_increasing_id()), "frames")
    order = ["doc_id", "crc", "row"]
    sorted_frames = frames.repartitionByRange(*order).sortWithinPartitions(*order).drop("row", "crc")

    def save(batches):
        system, path = _at(folder)
        own, shard = f"ids-{uuid.uuid4().hex}", TaskContext.get().partitionId()
        data = index = first = last = None
        documents = nulls = tokens = 0
        offset = len(MAGIC) + 32
        for batch in batches:
            if not batch.num_rows:
                continue
            if data is None:
                data = system.open_output_stream(f"{path}/{own}.bin")
                index = system.open_output_stream(f"{path}/{own}.idx")
                data.write(MAGIC + bytes.fromhex(name))
            size = batch.column("tokens").to_numpy()
            body, ends = row_bytes(batch.column("frame"))
            ids = batch.column("doc_id")
            record = np.zeros(batch.num_rows, RECORD)
            record["null"], record["doc_id"] = ids.is_null(), ids.fill_null(0)
            record["offset"], record["tokens"] = offset + ends[:-1], size
            record["start"] = tokens + np.concatenate([[0], np.cumsum(size)[:-1]])
            data.write(body.tobytes())
            index.write(record.tobytes())
            with_id = record["doc_id"][record["null"] == 0]
            if len(with_id):
                first, last = int(with_id[0]) if first is None else first, int(with_id[-1])
            documents, nulls = documents + len(record), nulls + int(ids.null_count)
            tokens, offset = tokens + int(size.sum()), offset + int(ends[-1])
        if data is not None:
            data.close()
            index.close()
            row = [shard, own, first, last, nulls, documents, tokens, offset, name]
            yield pa.RecordBatch.from_pylist([dict(zip(_MANIFEST_FIELDS.names, row, strict=True))], _MANIFEST_FIELDS)

    # One row per file, computed once: the names that the surviving tasks wrote.
    sorted_frames.mapInArrow(save, MANIFEST).write.parquet(f"{folder.rstrip('/')}/manifest")


_MANIFEST_FIELDS = pa.schema([(part.split()[0], pa.string() if part.split()[1] == "string" else pa.int64())
                              for part in MANIFEST.split(", ")])


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")


def _shards(spark: SparkSession, folder: str, keep=lambda row: True) -> tuple[list, bytes]:
    """(file, ids before it) of the files asked for, in order, and the dictionary. One small row per file
    passes the driver, as in any listing of files."""
    rows = sorted(manifest(spark, folder).select("shard", "file", "first_id", "last_id", "nulls", "tokens", "dictionary")
                  .collect(), key=lambda r: r["shard"])
    names = {r["dictionary"] for r in rows}
    if len(names) > 1:
        raise ValueError(f"the files of {folder} were written with different dictionaries")
    raw = _get(folder, f"dictionary-{names.pop()}") if rows else b""
    found, before = [], 0
    for r in rows:
        if keep(r):
            found.append((r["file"], before))
        before += r["tokens"]
    return found, raw


def _check(head: bytes, raw: bytes, name: str) -> None:
    if head != MAGIC + hashlib.sha256(raw).digest():
        raise ValueError(f"{name}: not a file of ids, or written with another dictionary")


def _frames(system, path: str, name: str, raw: bytes, wanted: list[int] | None) -> Iterator[tuple]:
    """(record, ids as bytes) of all documents of a file in order, or of the wanted doc_ids only."""
    unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)).decompress
    with system.open_input_file(f"{path}/{name}.bin") as data, system.open_input_file(f"{path}/{name}.idx") as index:
        _check(data.read(len(MAGIC) + 32), raw, name)
        count, stop = index.size() // RECORD.itemsize, data.size()

        def records(at: int, n: int) -> np.ndarray:
            index.seek(at * RECORD.itemsize)
            return np.frombuffer(index.read(n * RECORD.itemsize), RECORD)

        def blocks(start: int, least: int | None):
            at = start
            while at < count:
                block = records(at, min(BLOCK if least is None else 256, count - at) + 1)
                ends = np.append(block["offset"][1:], stop if at + len(block) >= count else [])
                block = block[:len(ends)]
                yield block, ends
                at += len(block)
                if least is not None and block[-1]["doc_id"] > least:
                    return

        if wanted is None:
            for block, ends in blocks(0, None):
                data.seek(int(block[0]["offset"]))
                for record, end in zip(block.tolist(), ends.tolist(), strict=True):
                    yield record, unpack(data.read(int(end) - record[2]))
            return
        for doc_id in wanted:
            low, high = 0, count
            while low < high:
                middle = (low + high) // 2
                record = records(middle, 1)[0]
                if record["null"] or record["doc_id"] < doc_id:
                    low = middle + 1
                else:
                    high = middle
            for block, ends in blocks(low, doc_id):
                for record, end in zip(block.tolist(), ends.tolist(), strict=True):
                    if record[1] == doc_id and not record[0]:
                        data.seek(record[2])
                        yield record, unpack(data.read(int(end) - record[2]))


def _rows(spark: SparkSession, folder: str, shards: list, raw: bytes, schema: str, fields: pa.Schema, make,
          wanted: list[int] | None = None) -> DataFrame:
    """``make(record, before, ids)`` for each document of the files, a file per task."""
    shared = spark.sparkContext.broadcast(raw)
    files = spark.createDataFrame(shards, "file string, before long")
    if shards:
        files = files.repartition(max(1, min(len(shards), 4 * spark.sparkContext.defaultParallelism)))

    def work(batches):
        system, path = _at(folder)
        for batch in batches:
            for row in batch.to_pylist():
                rows, weight = [], 0
                for record, ids in _frames(system, path, row["file"], shared.value, wanted):
                    rows.append(make(record, row["before"], ids))
                    weight += len(ids)
                    if len(rows) >= 4_096 or weight >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, fields)
                        rows, weight = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, fields)

    return files.mapInArrow(work, schema)


def _document(record, before, ids):
    return {"doc_id": None if record[0] else record[1], "start": before + record[3], "n_tokens": record[4],
            "token_ids": np.frombuffer(ids, "<u4").astype(np.int64)}


_DOCUMENT = "doc_id long, start long, n_tokens long, token_ids array<long>"
_DOCUMENT_FIELDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                              ("token_ids", pa.list_(pa.int64()))])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of the files: doc_id, ids before it, number of ids, and the ids."""
    return _rows(spark, folder, *_shards(spark, folder), _DOCUMENT, _DOCUMENT_FIELDS, _document)


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The documents of a stated, short list of doc_ids, by seeking in the files that may hold them."""
    wanted = sorted(set(doc_ids))
    shards, raw = _shards(spark, folder, lambda r: r["first_id"] is not None and any(
        r["first_id"] <= i <= r["last_id"] for i in wanted))
    return _rows(spark, folder, shards, raw, _DOCUMENT, _DOCUMENT_FIELDS, _document, wanted)


def _digest(record, before, ids):
    return {"doc_id": None if record[0] else record[1], "start": before + record[3], "n_tokens": len(ids) // 4,
            "ids_crc32": zlib.crc32(ids)}


def report(docs: DataFrame, vocabulary: str, end: int = 1) -> DataFrame:
    """Write the ids of ``docs`` below the shared folder, read the files back: start, count and checksum."""
    folder = run_dir(docs.sparkSession, "ids")
    write(docs, vocabulary, folder, end)
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return _rows(docs.sparkSession, folder, *_shards(docs.sparkSession, folder),
                 "doc_id long, start long, n_tokens long, ids_crc32 long", fields, _digest)
