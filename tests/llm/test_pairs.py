"""Near-duplicates, repeated strings and nearest vectors against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

import __spark_entry__ as contract
from tests.llm import brute
from tillstream.llm import ann, components, neardup, repeats

VOCABULARY = [f"w{k}" for k in range(400)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    """Chains and clusters of edited copies around the threshold, and exact copies."""
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = rng.choices(VOCABULARY, k=120)
        texts += [edited(rng, base, rng.randrange(0, 9)) for _ in range(25)]
        chain = base
        for _ in range(10):
            chain = edited(rng, chain, 2).split()
            texts.append(" ".join(chain))
    texts += [texts[3]] * 60
    rng.shuffle(texts)
    return brute.awkward(spark, texts)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_groups(corpus, size, percent):
    got = neardup.groups(corpus, size, percent).collect()
    rows = brute.texts(corpus)
    want = brute.near_groups(rows, size, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    sizes = sorted((i is None, i or 0, len(brute.shingles(t, size))) for i, t in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"]) for r in got) == sizes


def test_keep_one(corpus):
    kept = neardup.keep_one(corpus)
    assert kept.columns == corpus.columns
    want = brute.near_groups(brute.texts(corpus), 5, 80)
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({i for i, r in want.items() if i == r})


def test_near_of_nothing(spark):
    assert neardup.groups(brute.empty(spark)).count() == 0
    assert neardup.keep_one(brute.empty(spark)).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    a, b = " ".join(VOCABULARY[:30]), " ".join(VOCABULARY[50:90])
    rows = spark.createDataFrame([(3, a), (1, a), (3, b), (7, b), (9, "other words")],
                                 "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in neardup.groups(rows).collect()}
    assert got == {(3, 1), (1, 1), (7, 1), (9, 9)}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [
        (400 + k, 401 + k) for k in range(60)]
    got = {r["node"]: r["label"] for r in components.components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}
    for a, b in pairs:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k not in alone}


def test_repeats(spark):
    rng = random.Random(9)
    passages = ["".join(rng.choices("abcdefé ", k=rng.randrange(45, 140))) for _ in range(8)]
    texts = []
    for _ in range(120):
        parts = ["".join(rng.choices("abc ", k=rng.randrange(0, 90)))
                 if rng.random() < 0.5 else rng.choice(passages)[rng.randrange(0, 20):]
                 for _ in range(rng.randrange(1, 6))]
        texts.append("".join(parts))
    docs = brute.awkward(spark, texts + texts[:20] + ["ab" * 200] * 5)
    got = sorted(map(tuple, repeats.report(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == sorted(brute.repeated_bytes(brute.texts(docs)), key=str)


def test_repeats_with_hot_seeds(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLED", 1.0)
    monkeypatch.setattr(repeats, "HOT_FLOOR", 4)
    monkeypatch.setattr(repeats, "TASK_ROWS", 8)
    rng = random.Random(11)
    passage, line = ("".join(rng.choices("abcdefghé ", k=k)) for k in (130, 55))
    texts = []
    for i in range(150):
        own = ["".join(rng.choices("abc ", k=rng.randrange(0, 120))) for _ in range(3)]
        # One passage in every document, whole or cut, another one alone on its line.
        texts.append(f"{own[0]}{passage[rng.randrange(0, 60):]}{own[1]}\n{line}\n{own[2] if i % 3 else ''}")
    docs = brute.awkward(spark, texts + texts[:40] + [passage] * 30).repartition(12)
    seeds = repeats._hot_seeds(repeats._ranked(docs), repeats.LENGTH, repeats.SEED).collect()
    assert len(seeds) > 3 and max(r["tasks"] for r in seeds) > 10
    got = sorted(map(tuple, repeats.report(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == sorted(brute.repeated_bytes(brute.texts(docs)), key=str)


def test_repeats_of_nothing(spark):
    assert repeats.report(brute.empty(spark)).count() == 0


def test_repeated_ids_with_other_texts(spark):
    p = "a passage that is longer than fifty bytes, for sure it is."
    rows = [(1, p), (1, "x" + p), (2, p + "!"), (2, "nothing of it"), (None, p)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, repeats.report(docs).collect()), key=str)
    assert got == sorted(brute.repeated_bytes(rows), key=str)


def exact(ids, x, i, k):
    score = x @ x[i]
    score[ids == ids[i]] = -np.inf
    order = np.lexsort((ids, -np.round(score, 9)))[:k]
    return [int(ids[j]) for j in order if score[j] > -np.inf]


def test_nearest_on_the_test_table(spark):
    rows = spark.read.parquet(f"{brute.SF}/embeddings.parquet").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), float)
    got = contract.queries()["op5_nearest"](spark, brute.SF).toPandas()
    found = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        own = got[got["query_id"] == ids[i]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        at = {v: k for k, v in enumerate(ids)}
        assert np.allclose(own["score"], [x[i] @ x[at[v]] for v in own["vec_id"]], rtol=1e-12)
        found += len(set(exact(ids, x, i, 20)) & set(own["vec_id"]))
        total += 20
    assert found >= 0.9 * total


def test_nearest_with_parts(spark, monkeypatch):
    """Many parts, one vector that is there very often, and ties in the order of ids."""
    monkeypatch.setattr(ann, "PART_ROWS", 500)
    monkeypatch.setattr(ann, "BLOCK", 1000)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 16))
    x = centers[rng.integers(0, 40, 9000)] + 0.4 * rng.normal(size=(9000, 16))
    x[rng.random(9000) < 0.3] = centers[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = rng.permutation(20000)[:9000]
    docs = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)],
                                 "vec_id long, embedding array<double>")
    got = ann.nearest(docs).toPandas()
    asked = np.flatnonzero(ids % 20 == 0)
    often = np.argmax((np.round(x, 12) == np.round(centers[0] / np.linalg.norm(centers[0]), 12)).all(axis=1))
    assert set(got["query_id"]) == set(ids[asked])
    found = total = 0
    for i in asked:
        want = exact(ids, x, i, 20)
        own = got[got["query_id"] == ids[i]].sort_values("rank")["vec_id"].tolist()
        found, total = found + len(set(want) & set(own)), total + 20
        assert len(own) == 20
        if (x[i] == x[often]).all():
            assert own == want
    assert found >= 0.9 * total


def test_small_tables_have_parts(spark):
    rows = ann.usable(spark.read.parquet(f"{brute.SF}/embeddings.parquet"), "embedding")
    index = ann.build(rows, rows.count())
    assert index.parts >= 4 and 1 <= index.visits <= index.parts and ann.RECALL >= 0.97


def test_nearest_of_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [None, 1.0]),
            (100, [1.0, 2.0, 3.0]), (3, [2.0, 0.0]), (2, [2.0, 0.0]), (5, [-1.0, 0.0]),
            (120, [float("inf"), 0.0]), (0, [1.0, 0.0]), (None, [1.0, 0.0]), (140, [])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.nearest(docs).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 2.0), (0, 2, 3, 2.0), (0, 3, 5, -1.0)]
    assert ann.nearest(docs.filter("vec_id < 0")).count() == 0
