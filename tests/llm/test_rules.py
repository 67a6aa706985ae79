"""Rules that must hold at any size, and values of mixed kinds."""

from __future__ import annotations

import __spark_entry__ as contract
from tests.llm import brute
from tillstream.llm import pii
from tillstream.llm.batches import sampled


def test_samples_of_tables_of_any_size(spark):
    rows = spark.range(400_000).withColumnRenamed("id", "doc_id")
    assert rows.filter(sampled(1.0, "doc_id")).count() == 400_000
    assert 300 < rows.filter(sampled(1e-3, "doc_id")).count() < 500
    # The share for 1e14 rows is far below one in 2**20; in 62 bits it still chooses some of them.
    assert int(4_000 / 1e14 * 2**62) > 10**8


def test_an_address_is_not_a_number(spark):
    rows = [(1, "the server is 10.0.0.1 now"), (2, "order no 10001 was shipped"), (3, "1000.1 and 100.0.1 and 1 0 0 0 1"),
            (4, "host 10.0.0.1")]
    got = pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["spans"] for r in got} == {1: "ip:14:22", 2: "", 3: "", 4: "ip:5:13"}


def test_words_beside_a_value_are_whole():
    long = "x" * 300
    text = f"{long} {long} user12 {long} end"
    at = text.index("user12")
    assert pii._beside(text, at, at + 6) == [f"{long} {long} _", f"{long} _ {long}"]
    assert pii._beside("user12", 0, 6) == ["  _", " _ "]
    assert pii._beside("a  b user12 c", 5, 11) == ["a b _", "b _ c"]


def test_base_spans_of_the_registered_query(spark):
    texts = dict(brute.texts(spark.read.parquet(f"{brute.SF}/documents.parquet")))
    rows = contract.queries()["op7_pii"](spark, brute.SF).collect()
    assert {r["doc_id"]: r["base_sha256"] for r in rows} == {i: brute.sha(brute.personal(t)) for i, t in texts.items()}
    for r in rows:
        base = [s for s in brute.personal(texts[r["doc_id"]]).split(",") if s]
        assert set(base) <= set(r["spans"].split(",")) and len(base) == sum(r[f"n_{k}"] for k in pii.KINDS)
