"""Encoding, lines, benchmark windows, languages, toxicity, personal data, and likelihoods."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from dataclasses import replace
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tests.compare import differences, oracle
from tests.llm import brute
from tillstream.llm import bpe, contamination, langid, lattice, lines, pii, toxicity

FILE = public_tokenizers.path("word_bpe_49k.json")
LETTERS = ["a", "b", "e", "s", "t", "'", " ", "\n", "Σ", "É", "é", "é", "İ", "1", "٣", "½",
           "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "漢", "😀", "\x1f", "\x85", "​",
           "　", "ing", "the", "...", "'re", "'LL", "ß", "ǅ", "\x00", "अनु", "ſ"]


@pytest.mark.parametrize("name", ["op6_decontamination", "op8_line_dedup"])
def test_against_sql(spark, name):
    assert differences(spark, oracle(brute.SF), name, brute.SF) is None


# encoding

def test_encoding_equals_the_library():
    model, library = bpe.Vocabulary(Path(FILE).read_text()), Tokenizer.from_file(FILE)
    rng = random.Random(4)
    texts = ["".join(rng.choices(LETTERS, k=rng.randrange(30))) for _ in range(5000)]
    texts += ["".join(rng.choices("abcdefghinorstu'", k=rng.randrange(1, 25))) for _ in range(5000)]
    texts += ["", " ", "a" * 5000, "ab" * 2000]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        own = model.encode(text)
        assert own.tolist() == ids, text
        data, _ = model.decode(own, np.array([0, len(own)]))
        assert data.tobytes().decode() == library.decode(ids, skip_special_tokens=False)


def test_encoding_of_rows(spark):
    docs = brute.awkward(spark).withColumn("decoded", F.lit("old"))
    coded = bpe.encode(docs, FILE)
    assert coded.columns == [*docs.columns, "token_ids"]
    got = bpe.decode(coded, FILE)
    assert sorted(got.columns) == sorted(coded.columns)
    library = Tokenizer.from_file(FILE)
    rows = got.select("text", "token_ids", "decoded", "cell").collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.digests(brute.empty(spark), FILE).count() == 0


def test_digests(spark):
    library = Tokenizer.from_file(FILE)
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    texts = dict(brute.texts(docs))
    for r in contract.queries()["op3_bpe"](spark, brute.SF).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == brute.sha(library.decode(ids, skip_special_tokens=False))


# lines

def pages(spark):
    body = [f"text of its own, number {k}, a line that is long enough to be most of it" for k in range(40)]
    rows = [(k, f"Menu\n{body[k]}\r\n\n  Menu ", "en", f"s{k % 12}", 5, "c", 1) for k in range(40)]
    rows += [(100 + k, "a copied page\nwith these lines", "en", f"s{k}", 5, "c", 1) for k in range(12)]
    rows += [(200 + k, f"{body[k]}x\nNine sites", "en", f"s{k}", 5, "c", 1) for k in range(9)]
    return spark.createDataFrame(rows, brute.DOCS).unionByName(brute.awkward(spark))


def test_line_removal(spark):
    docs = pages(spark)
    got = {(r["doc_id"], r["text"]): r for r in lines.remove(docs).collect()}
    assert lines.remove(docs).columns == docs.columns
    for k in range(40):
        r = next(v for (i, _), v in got.items() if i == k and v["text"] and "of its own" in v["text"])
        assert "Menu" not in r["text"] and r["n_chars"] == len(r["text"])
    assert {t for (i, t) in got if i and 100 <= i < 112} == {"a copied page\nwith these lines"}
    assert all("Nine sites" in t for (i, t) in got if i and 200 <= i < 209)
    assert (51, None) in got and (1, "") in got
    assert lines.remove(docs).count() == docs.count()
    assert lines.remove(brute.empty(spark)).count() == 0


def test_very_long_texts_lose_lines_and_spans(spark):
    # 80,000 lines of which every second one goes: the square of that would not end here.
    rows = [(s, "spread over all sites", f"site{s}") for s in range(20)]
    own = [f"a line of its own, number {k}" for k in range(40_000)]
    rows.append((99, "\n".join(x for line in own for x in (line, "spread over all sites")), "site1"))
    got = {r["doc_id"]: r["text"] for r in lines.remove(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[99] == "\n".join(own)
    item = "one two three four five six seven eight nine ten"
    text = ", ".join(f"w{k}. {item}" for k in range(4_000))
    docs = spark.createDataFrame([(1, text), (2, item.upper() + "!"), (3, "nothing"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("b", item)], "item_id string, text string")
    got = {r["doc_id"]: r["text"] for r in contamination.remove_spans(docs, bench).collect()}
    assert got == {1: ", ".join(f"w{k}. " for k in range(4_000)), 2: "!", 3: "nothing", 4: None}


def test_lines_near_the_threshold_are_counted(spark):
    rows = [(100 * n + k, f"line {n}", f"site {k}") for n in range(1, 25) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert lines.spread_lines(docs).count() == 15


# benchmark windows

def test_windows(spark):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame(
        [(1, item), (2, item), (3, "short item"), (4, None), (5, "--"), (6, "aa aa aa aa aa aa aa aa aa aa")],
        "item_id long, text string")
    own = [f"start, {item.upper()}! end", "x ONE two three four five six seven eight nine ten y",
           "a Short\nitem here", "aa " * 15, "short, then item", "one two three four five six seven"]
    docs = brute.awkward(spark, own)
    rows = {(r["doc_id"], r["n_words"]): r for r in contamination.report(docs, bench).collect()}
    hit = {k[0]: (r["n_hit"], r["n_items"], r["items_sha256"]) for k, r in rows.items() if r["contaminated"]}
    assert hit == {10: (11, 2, brute.sha("1,2")), 11: (10, 2, brute.sha("1,2")), 12: (2, 1, brute.sha("3")),
                   13: (15, 1, brute.sha("6"))}
    kept = contamination.remove_documents(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    cut = dict(brute.texts(contamination.remove_spans(docs, bench)))
    assert cut[10] == "start, ! end" and cut[12] == "a  here" and cut[14] == own[4] and cut[0] is None
    nothing = bench.filter("item_id = 4")
    assert contamination.remove_documents(docs, nothing).count() == docs.count()
    assert contamination.report(brute.empty(spark), bench).count() == 0


# languages

def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count() and {r["doc_id"] for r in held} == {
        r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 and abs(sum(r["languages"].values()) - 1) < 1e-9 for r in got)


def test_mixed_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs)
    some = {lang: docs.filter((F.col("lang") == lang) & (F.length("text") > 3000)).first()["text"][:3000]
            for lang in ("en", "de")}
    rows = [(1, some["en"] + " " + some["de"]), (2, some["en"][:1000] + " " + some["de"])]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert all(set(r["languages"]) == {"en", "de"} for r in got)
    assert abs(got[0]["languages"]["en"] - 0.5) < 0.1 and abs(got[1]["languages"]["en"] - 0.25) < 0.1


def test_languages_of_awkward_rows(spark):
    docs = brute.awkward(spark, ["12 34 !!", "٣", "漢字"])
    got = {r["doc_id"]: r for r in langid.predictions(docs).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} >= {0, 1, 2, 8, 10, 11, 51}
    assert got[12]["lang_pred"] == "en" and got[0]["score"] == 0
    assert langid.predictions(brute.empty(spark)).count() == 0
    assert langid.accepted(docs).columns == docs.columns
    untaught = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predictions(untaught).collect()} == {"und"}


# toxicity

def test_toxicity(spark):
    dir_ = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{dir_}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.predictions(docs, labels)
    rows = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    toxic = rows["toxic"] == 1
    assert ((rows["predicted"] == 1) == toxic).mean() > 0.95
    assert rows["predicted"][toxic].mean() > 0.8 and rows["predicted"][~toxic].mean() < 0.03


def test_toxic_sentences(spark):
    rng = random.Random(3)
    clean = [f"word{k}" for k in range(50)]
    rows, marks = [], []
    for k in range(600):
        sentences = [" ".join(rng.choices(clean, k=6)) + "." for _ in range(4)]
        if k % 3 == 0:
            sentences[k % 4] = "You are a horrible É person."
        rows.append((k, " ".join(sentences)))
        marks.append((k, int(k % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    texts = dict(rows)
    for r in toxicity.score(docs, model).collect():
        assert r["predicted"] == (r["doc_id"] % 3 == 0)
        found = [texts[r["doc_id"]][s["start"]:s["end"]].strip() for s in r["offending"]]
        assert found == (["You are a horrible É person."] if r["predicted"] else [])


def test_toxicity_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    kind = "doc_id long, toxic int"
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (6, None), (None, 1), (8, 0)], kind)
    got = toxicity.predictions(docs, labels)
    assert got.count() == docs.count() and got.filter("score < 0 or score > 1 or score is null").isEmpty()
    nothing = toxicity.predictions(docs, spark.createDataFrame([], kind))
    assert nothing.filter("score <> 0 or predicted <> 0").isEmpty()
    assert toxicity.predictions(brute.empty(spark), labels).count() == 0


# personal data

def test_base_spans(spark):
    own = ["mail a.b@c.de, x@y, @z.de a@b.c@d.e", "1.2.3.4 1.2.3.256 1.2.3.4.5.6.7.8 01.002.3.4",
           "4111 1111 1111 1111 and 4111-1111-1111-1112 411111111111111 4", "+49 (30) 123-456 +1 +12345678901234567",
           "+1 (555) 123-4567 4111111111111111a@b.co", "1" * 20000, "é 4111111111111111"]
    docs = brute.awkward(spark, own)
    texts = brute.texts(docs)
    got = pii.report(docs).collect()
    assert sorted(r["base_sha256"] for r in got) == sorted(brute.sha(brute.personal(t)) for _, t in texts)
    for r in contract.queries()["op7_pii"](spark, brute.SF).collect():
        assert r["n_email"] >= 0 and set(brute.personal("").split(",")) <= {""}
    assert pii.report(brute.empty(spark)).count() == 0


def test_contexts_find_more(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        rows.append((k, f"{rng.random()} words. Please write to user{k}@mail.example for more {k}"))
    rows.append((100, "Please write to user_77(at)mail.example for more things, and code_77x there"))
    rows.append((101, "seen 4111111111111111 once"))
    rows.append((102, "wrong 4111111111111111 4111111111111111 twice"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(docs).collect()}
    assert got[100]["spans"] == "email:16:39" and got[100]["n_email"] == 0
    assert got[102]["spans"] == "card:6:22,card:23:39"
    assert all(got[k]["n_added"] == 0 for k in range(60))


def test_contexts_find_numbers_in_groups_and_written_addresses(spark):
    rng = random.Random(18)
    rows = []
    for k in range(60):
        rows.append((k, f"{rng.random()} w. Please call me at +1 (017) 555-{1000 + k} from nine on"))
        rows.append((100 + k, f"{rng.random()} w. Please write to user{k}@mail.example for more things"))
        digits = next(d for d in (f"41111111{k:04}111{c}" for c in range(10)) if pii.luhn(d))
        rows.append((200 + k, f"{rng.random()} w. It was paid by card {digits} in full"))
    texts = {300: ("Please call me at (017) 555-7713 from nine on", "(017) 555-7713", "phone"),
             301: ("It was paid by card 4111 1111 1111 1112 in full", "4111 1111 1111 1112", "card"),
             302: ("Please write to jane dot doe at mail dot example for more", "jane dot doe at mail dot example", "email"),
             303: ("seen elsewhere: 4111-1111-1111-1112 once", "4111-1111-1111-1112", "card"),
             304: ("seen elsewhere [017] 555 7713 once", "[017] 555 7713", "phone"),
             305: ("as of 4111 and 7713 and 2024", "", "")}
    rows += [(k, t) for k, (t, *_) in texts.items()]
    got = {r["doc_id"]: r["spans"] for r in pii.report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (text, span, kind) in texts.items():
        at = text.find(span)
        assert got[k] == (f"{kind}:{at}:{at + len(span)}" if span else ""), (k, got[k])


def test_chains_of_contexts_are_followed_to_the_end(spark):
    # Each context is trusted only once the values that it shares with the one before are known.
    rows = []
    for k, w in enumerate("abcdef"):
        own = [f"s{k}x{j}@mail.example" for j in range(50)] + [f"user_{k}x{j}" for j in range(10)]
        own += [f"user_{k - 1}x{j}" for j in range(10)] if k else []
        rows += [(f"{w}one {w}two {v} {w}end",) for v in own]
    docs = spark.createDataFrame([(n, t) for n, (t,) in enumerate(rows)], "doc_id long, text string")
    got = pii.report(docs).filter("n_added = 1").count()
    assert got == sum("user_" in t for t, in rows)


def test_rows_of_groups():
    text = "4111 1111 1111 1112 5500 0000 0000 0004 4222 2222 2222 2223"
    own = {text[s:e] for s, e, _ in pii.grouped(text, [])}
    assert {text[:19], text[20:39], text[40:]} <= own
    assert pii.grouped("1 " * 50_000, []) and not pii.grouped("x1 2y 3-4", [])
    assert pii.written("a at b.c " * 5_000 + "a at b.de", [])[-1][2] == "a@b.de"


# likelihoods

def log_sum(values):
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def test_lattice_sums_over_all_segmentations():
    pieces = lattice.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    weight = dict(zip(pieces.names, pieces.weight, strict=True))
    words = [w.encode() for w in ("a", "the", "onesen", "éreaiou", "x" * 40, "漢z", "onesen" * 70)]

    def slow(word):
        word = b" " + word
        alpha = [0.0]
        for end in range(1, len(word) + 1):
            alpha.append(log_sum([alpha[s] + weight[word[s:end]] for s in range(end)
                                  if word[s:end] in weight]))
        return alpha[-1] + pieces.stop

    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    own, used = lattice.Lattice(pieces).run(data, start, size, np.ones(len(words)))
    assert np.allclose(own, [slow(w) for w in words])
    # Every byte, and the blank before each word, is covered once on average.
    spelled = sum(used[i] * len(n) for i, n in enumerate(pieces.names))
    assert abs(spelled - (size.sum() + len(words))) < 1e-6
    fitted = lattice.refit(pieces, used)
    assert lattice.Lattice(fitted).run(data, start, size)[0].sum() > own.sum()


@pytest.mark.parametrize("kind", ["awkward", "table", "empty"])
def test_scores(spark, kind):
    docs = {"awkward": lambda: brute.awkward(spark, ["one", "supercalifragilistic" * 30]),
            "table": lambda: spark.read.parquet(f"{brute.SF}/documents.parquet"),
            "empty": lambda: brute.empty(spark)}[kind]()
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = lattice.scores(docs, path).collect()
    rows = brute.texts(docs)
    assert len(got) == len(rows)
    count = Counter()
    tokens = [(i, [*brute.words(t), None]) for i, t in rows]
    train = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    for t, (_, own) in zip(train, tokens, strict=True):
        if t:
            count.update(own)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(own), sum(count[w] > 0 for w in own),
                   round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 4), n)
                  for i, own in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4),
                   r["train_tokens"]) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_score_is_that_of_the_model(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").limit(60)
    train = docs.filter("doc_id % 2 = 0")
    model = lattice.learn(train, public_tokenizers.path("piece_bpe_32k.model"))
    count = Counter()
    for _, t in brute.texts(train):
        count.update([*brute.words(t), None])
    net = lattice.Lattice(model.pieces)
    total = sum(count.values())
    for r in lattice.score(docs, "doc_id % 2 = 0", model).collect():
        text = dict(brute.texts(docs))[r["doc_id"]]
        own = [w.encode() for w in brute.words(text)]
        size = np.array([len(w) for w in own])
        p, _ = net.run(np.frombuffer(b"".join(own), np.uint8), np.cumsum(size) - size, size)
        want = sum(math.log10((count[w.decode()] + model.weight * math.exp(q)) / (total + model.weight + 1))
                   for w, q in zip(own, p, strict=True))
        want += math.log10((count[None] + 1) / (total + model.weight + 1))
        assert r["score"] == pytest.approx(want, rel=1e-6)


def test_scores_do_not_depend_on_the_table_of_frequent_words(spark, monkeypatch):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").limit(80)
    path = public_tokenizers.path("piece_bpe_32k.model")
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    model = lattice.learn(docs.filter("doc_id % 2 = 0"), path)
    want = {r["doc_id"]: [r[n] for n in names] for r in lattice.score(docs, "doc_id % 2 = 0", model).collect()}
    # As many words as all counts allow, some, and none at all; and counts the model does not bring.
    assert len(model.frequent) > 30
    for most in (30, 0):
        monkeypatch.setattr(lattice, "FREQUENT", most)
        few = lattice.learn(docs.filter("doc_id % 2 = 0"), path)
        assert len(few.frequent) <= most and (most == 0 or few.counts.max() == model.counts.max())
        for m in (few, replace(few, words=None)):
            got = lattice.score(docs, "doc_id % 2 = 0", m).collect()
            assert len(got) == len(want)
            for r in got:
                assert [r[n] for n in names] == pytest.approx(want[r["doc_id"]], rel=1e-9)


def test_every_round_sees_all_training_words(spark):
    # Words of 24 rare alphabets, each in few of many documents, so that a sample misses most of them.
    rng = random.Random(12)
    rows = []
    for k in range(9000):
        rare = "".join(chr(0x1200 + 40 * (k // 375) + rng.randrange(12)) for _ in range(6))
        rows.append((k, f"common words of text {rng.randrange(50)} {rare if k % 25 == 0 else ''}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    count = Counter(w.encode() for _, t in rows for w in brute.words(t))
    names = sorted(count)
    data, size = np.frombuffer(b"".join(names), np.uint8), np.array([len(w) for w in names])
    times = np.array([float(count[w]) for w in names])
    pieces = lattice.vocabulary(path)
    for _ in range(6):
        pieces = lattice.refit(pieces, lattice.Lattice(pieces).run(data, np.cumsum(size) - size, size, times)[1])
    model = lattice.learn(docs, path)
    assert np.allclose(model.pieces.weight, pieces.weight, atol=1e-6)
    assert model.weight == sum(n == 1 for n in count.values())
    assert model.tokens == sum(count.values()) + len(rows) and model.ends == len(rows)
    assert model.counts.max() == max(count.values())
