"""The pipeline, each stage on its own input, against brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute

NAMES = ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe"]


def plain_lines(rows):
    """Texts without lines of ten sites or more, unless they are most of a text."""
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if source is not None:
                sites[line.strip(" \t\r")].add(source)
    out = {}
    for i, text, _ in rows:
        own = [(x, x.strip(" \t\r")) for x in (text or "").split("\n")]
        wide = [s for _, s in own if s and len(sites[s]) >= 10]
        fits = sum(map(len, wide)) <= sum(len(s) for _, s in own) / 2
        out[i] = "\n".join(x for x, s in own if not (fits and s and len(sites[s]) >= 10)) if wide and fits else text
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))


@pytest.fixture(scope="module")
def run(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").unionByName(
        brute.awkward(spark).selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "n_chars"))
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stage(spark, made[-1], brute.SF).cache())
    return made


def test_stages(run):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    assert all(d.columns == run[0].columns for d in run[:-1])


def test_language_stage(run):
    kept = [t for _, t in brute.texts(run[1])]
    assert sorted(kept) == sorted(t for _, t in brute.texts(run[0])
                                  if t and any(c.isalpha() for c in t))


def test_line_stage(run):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in run[1].collect()]
    assert len({i for i, *_ in rows}) >= len(rows) - 2
    want = plain_lines(rows)
    assert all(want[i] == t for i, t in brute.texts(run[2]) if i is not None)
    assert run[2].count() == len(rows)


def test_near_stage(run):
    groups = brute.near_groups(brute.texts(run[2]), 5, 80)
    ids = sorted(i for i, _ in brute.texts(run[3]) if i is not None)
    assert ids == sorted({i for i, root in groups.items() if i == root})


def test_decontamination_stage(run, spark):
    grams = set()
    for r in spark.read.parquet(f"{brute.SF}/benchmark.parquet").collect():
        w = item_words(r["text"])
        size = min(10, len(w))
        grams |= {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if w else set()
    sizes = {len(g) for g in grams}
    clean = []
    for i, t in brute.texts(run[3]):
        w = item_words(t)
        if not any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1)):
            clean.append(i)
    assert sorted(clean, key=str) == sorted((i for i, _ in brute.texts(run[4])), key=str)


def test_encoding_stage(run):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = run[5].collect()
    assert len(rows) == run[4].count()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_stages_of_nothing(spark):
    docs = brute.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, brute.SF)
        assert docs.count() == 0
