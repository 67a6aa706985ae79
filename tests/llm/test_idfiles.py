"""Files of token ids: round trips against the tokenizer library."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tests.llm import brute
from tests.llm.test_texts import LETTERS
from tillstream import session
from tillstream.llm import idfiles

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_one_by_one_give_the_tokens_of_the_text():
    rng = random.Random(9)
    letters = [*LETTERS, ".", ",", "!?", "don't", "word.", "Über,", "é.", "ab;:", "İ.", "\x0b"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(6000)]
    texts += [None, "", " ", "a" * 5000, "dog's. it's, 's.", "x<|endoftext|>y", "<|ENDOFTEXT|>", "no.\x1fway. "]
    flat, ends = idfiles.Encoder(Path(FILE).read_text()).encode(pa.array(texts))
    for text, a, b in zip(texts, ends, ends[1:]):
        assert flat[a:b].tolist() == ids_of(text)[:-1], text


def test_few_words_remembered(monkeypatch):
    monkeypatch.setattr(idfiles, "REMEMBERED", 2)
    model = idfiles.Encoder(Path(FILE).read_text())
    for texts in (["one two", "three é one"], ["two four", None], ["one two four É"]):
        flat, ends = model.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [ids_of(t)[:-1] for t in texts]


def expected(rows):
    """(doc_id, start, n_tokens, crc32) in order of the files."""
    coded = [(i, np.array(ids_of(t), "<u4").tobytes()) for i, t in rows]
    coded.sort(key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1])))
    out, start = [], 0
    for i, b in coded:
        out.append((i, start, len(b) // 4, zlib.crc32(b)))
        start += len(b) // 4
    return out


def test_files_of_the_documents(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    got = contract.queries()["op11_id_files"](spark, brute.SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(brute.texts(docs))


def test_files_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    got = idfiles.report(docs, FILE).collect()
    assert Counter(map(tuple, got)) == Counter(expected(brute.texts(docs)))
    assert idfiles.report(brute.empty(spark), FILE).count() == 0
    nothing = spark.createDataFrame([(3, None), (None, None), (3, "")], "doc_id long, text string")
    assert sorted(map(tuple, idfiles.report(nothing, FILE).collect()), key=lambda r: r[1]) == [
        (None, 0, 1, zlib.crc32(b"\1\0\0\0")), (3, 1, 1, zlib.crc32(b"\1\0\0\0")), (3, 2, 1, zlib.crc32(b"\1\0\0\0"))]


@pytest.fixture(scope="module")
def folder(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id = 7")).unionByName(docs.limit(1).selectExpr("null as doc_id", "text"))
    folder = session.run_dir(spark, "files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        idfiles.write(docs, FILE, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return folder, dict(brute.texts(docs))


def test_reading_and_fetching(spark, folder):
    folder, texts = folder
    files = idfiles.manifest(spark, folder).collect()
    assert len(files) > 4 and sum(r["documents"] for r in files) == 202 and sum(r["nulls"] for r in files) == 1
    rows = idfiles.read(spark, folder).collect()
    assert all(r["token_ids"] == ids_of(texts[r["doc_id"]]) for r in rows)
    place = {(r["doc_id"], r["start"]) for r in rows}
    some = idfiles.fetch(spark, folder, [7, 150, 7, 10**9, -1]).collect()
    assert sorted(r["doc_id"] for r in some) == [7, 7, 150]
    assert all(r["token_ids"] == ids_of(texts[r["doc_id"]]) and (r["doc_id"], r["start"]) in place for r in some)
    assert idfiles.fetch(spark, folder, []).count() == 0


def test_the_dictionary_is_trained_shared_and_checked(spark, folder):
    folder, texts = folder
    rows = idfiles.manifest(spark, folder).collect()
    names = {r["dictionary"] for r in rows}
    assert len(names) == 1
    raw = idfiles._get(folder, f"dictionary-{names.pop()}")
    assert 0 < len(raw) <= idfiles.DICTIONARY_BYTES
    plain = sum(4 * r["tokens"] for r in rows)
    assert sum(r["bytes"] for r in rows) < 0.6 * plain
    system, path = idfiles._at(folder)
    with pytest.raises(ValueError, match="another dictionary"):
        list(idfiles._frames(system, path, rows[0]["file"], raw + b"x", None))
