"""Hashes of words: equal words anywhere agree, different ones do not, however alike."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tillstream.llm import batches, neardup


def codes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return batches.words(data, np.array([0, len(data)]))[0].tolist()


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [8, 16, 128, 256, 512, 1024, 4096])
def test_words_that_sums_of_letters_cannot_tell_apart(n):
    a, b = codes(" ".join(thue_morse(n)))
    assert a != b


def test_codes_depend_on_the_word_alone():
    rng = random.Random(6)
    words = list({"".join(rng.choices("abé\x00", k=rng.randrange(1, 40))) for _ in range(3000)} | {"x" * 255, "x" * 256, "x" * 257})
    first = dict(zip(words, codes(" ".join(words))))
    assert len(set(first.values())) == len(words)
    rng.shuffle(words)
    assert dict(zip(words, codes("  \n".join(words) + " end"))) == first
    assert codes("") == [] and codes(" ") == []


def test_documents_without_a_common_shingle_are_not_linked(spark):
    a, b = thue_morse(1024)
    rows = [(1, f"{a} one two"), (2, f"{b} one two"), (3, f"{a} one two"), (4, " ".join([a] * 9)), (5, " ".join([b] * 9))]
    got = neardup.groups(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
