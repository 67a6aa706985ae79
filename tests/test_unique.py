"""Unique keys: the outcome of a batch equals that of one insert after the other."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillstream.functions import pii
from tillstream.operators import entity_ops, unique
from tillstream.operators.unique import UniqueKey, refuse_repeats

KEYS = [UniqueKey(("mail",), ignore_case=True), UniqueKey(("a", "b"))]
ROWS = "n int, mail string, a int, b string, reason string"
NOW = datetime(2026, 1, 1)


def one_by_one(requests, stored):
    def claims(r):
        return [(0, r[1].lower()) if r[1] is not None else None,
                (1, r[2], r[3]) if r[2] is not None and r[3] is not None else None]
    names = ["mail", "a, b"]
    held, taken, out = {c for r in stored for c in claims(r) if c}, set(), {}
    for r in sorted(requests):
        old = [names[k] for k, c in enumerate(claims(r)) if c in held]
        new = [names[k] for k, c in enumerate(claims(r)) if c in taken]
        out[r[0]] = r[4] or (old and f"{old[0]} already exists") or (new and f"{new[0]}: requested more than once") or None
        if not out[r[0]]:
            taken |= {c for c in claims(r) if c}
    return out


@pytest.mark.parametrize("values", [3, 8, 40])
def test_as_if_one_by_one(spark, values):
    rng = random.Random(values)

    def row(n, reason=None):
        pick = lambda *own: rng.choice([*own, None]) if rng.random() < 0.3 else own[0]
        return (n, pick(rng.choice(["X", "x"]) + str(rng.randrange(values))), pick(rng.randrange(values)),
                pick(rng.choice("pq")), reason)
    stored = [row(-k) for k in range(values // 3)]
    requests = [row(n, rng.choice([None] * 5 + ["bad"])) for n in range(80)]
    df = spark.createDataFrame(requests, ROWS).repartition(5)
    got = refuse_repeats(df, spark.createDataFrame(stored, ROWS), KEYS, ["n"])
    assert got.columns == df.columns
    assert {r["n"]: r["reason"] for r in got.collect()} == one_by_one(requests, stored)


def test_a_chain_of_refusals(spark):
    """Each request wants what the one before would have taken, had it not been refused."""
    requests = [(n, f"m{(n + 1) // 2}", n // 2, "p", None) for n in range(40)]
    got = refuse_repeats(spark.createDataFrame(requests, ROWS), spark.createDataFrame([], ROWS), KEYS, ["n"])
    assert {r["n"]: r["reason"] for r in got.collect()} == one_by_one(requests, [])
    nothing = refuse_repeats(spark.createDataFrame([], ROWS), spark.createDataFrame([], ROWS), KEYS, ["n"])
    assert nothing.count() == 0


def _spread_over(spark, monkeypatch, n):
    """Requests for places of stock, and the rows that each intermediate table of their check holds."""
    held, real = {}, unique.settle

    def settle(df, label):
        done = real(df, label)
        held[label] = done.count()
        return done
    monkeypatch.setattr(unique, "settle", settle)
    requests = spark.range(n).selectExpr("cast(id as int) as n", "cast(null as string) as mail", "cast(id as int) as a",
                                         "if(id % 50 = 1, null, 'p') as b", "cast(null as string) as reason")
    requests = requests.unionByName(requests.filter("n % 100 = 0").withColumn("n", F.col("n") + n))
    stored = requests.filter("n % 100 = 2").limit(5)
    got = refuse_repeats(requests, stored, [KEYS[1]], ["n"])
    reasons = {r["reason"]: r["count"] for r in got.groupBy("reason").count().collect()}
    return held, reasons


def test_values_that_nobody_else_wants_are_moved_once(spark, monkeypatch):
    held, reasons = _spread_over(spark, monkeypatch, 2000)
    assert reasons == {None: 1995, "a, b: requested more than once": 20, "a, b already exists": 5}
    assert held.pop("requests") == 2020 and sum(held.values()) <= 50


@pytest.mark.parametrize("most", [0, 3])
@pytest.mark.parametrize("keys", [KEYS, KEYS[:1]])
def test_hot_values(spark, monkeypatch, most, keys):
    """Values that many requests want are refused in the same way, though they are not gathered."""
    rng = random.Random(most)
    rows = [(n, rng.choice(["x", "X", "y", "z", None, f"m{n}"]), rng.randrange(60), rng.choice(["p", None]), None)
            for n in range(120)]
    df, stored = spark.createDataFrame(rows, ROWS), spark.createDataFrame([(-1, "Z", 1, "p", None)], ROWS)
    want = {r["n"]: r["reason"] for r in refuse_repeats(df, stored, keys, ["n"]).collect()}
    monkeypatch.setattr(unique, "TASK_ROWS", most)
    labels, real = [], unique.settle
    monkeypatch.setattr(unique, "settle", lambda d, label: labels.append(label) or real(d, label))
    got = {r["n"]: r["reason"] for r in refuse_repeats(df, stored, keys, ["n"]).collect()}
    assert got == want and "hot" in labels
    if keys == KEYS:
        assert got == one_by_one(rows, [(-1, "Z", 1, "p", None)])


def test_encrypted_columns(spark):
    customers = spark.createDataFrame(
        [("CUST_000001", "Ann", b"ann@x.de", b"123456789", "here", NOW, NOW)],
        "customer_id string, name string, email binary, phone binary, address string, created_at timestamp, updated_at timestamp")
    stored = pii.encrypt(customers, ["email", "phone"], "key")
    requests = spark.createDataFrame(
        [(1, "Bo", "ann@x.de", "555555555", "a"), (2, "Cy", "cy@x.de", "555555555", "b"), (3, "Di", "cy@x.de", "666666666", "c")],
        "n int, name string, email string, phone string, address string")
    done = entity_ops.insert_rows("customers", {"customers": stored}, requests, ["n"], 2, NOW, secret="key")
    assert {r["n"]: r["reason"] for r in done.rejected.collect()} == {
        1: "email already exists", 3: "email: requested more than once"}
    assert [r["customer_id"] for r in done.inserted.collect()] == ["CUST_000002"]


def test_two_patches_of_one_name(spark):
    rows = [(k, f"name {k}", NOW, None, NOW) for k in range(1, 5)]
    table = spark.createDataFrame(rows, "category_id long, name string, created_at timestamp, deleted_at timestamp, updated_at timestamp")
    requests = spark.createDataFrame([(1, "New"), (2, "new"), (3, "NAME 4"), (4, "other")], "category_id long, name string")
    done = entity_ops.patch_rows("categories", {"categories": table}, requests, NOW)
    assert {r["category_id"]: r["reason"] for r in done.rejected.collect()} == {
        2: "name: requested more than once", 3: "name already exists"}
    assert sorted(r["name"] for r in done.df.collect()) == ["New", "name 2", "name 3", "other"]
