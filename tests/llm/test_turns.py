"""Repair of conversations against a plain search over all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
from tests.llm import brute
from tillstream.llm import turns

TURNS = "conv_id long, turn long, role string, text string, copies string, shard int"
NAMES = {"u": "user", "a": "assistant"}
PATTERN = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """(conv_id, turn, role, text) after damage, by conversation, in order; every conv_id has an entry."""
    out = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        out[c] += []
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out[c] += [(t, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, x in out.items()}


def step(state, initial):
    """State of the pattern (as the last initial, "" at the start) after another initial, or None."""
    return initial if initial and state + initial in ("s", "u", "su", "ua", "au") else None


def cheapest(rows):
    """(cost, edits, repaired rows) by relaxing all prefixes in order; rows: (role, text, fault)."""
    best = {"": (0, "", [])}

    def relax(table):
        for _ in range(4):
            for q, (cost, edits, kept) in list(table.items()):
                for c in "ua":
                    to = step(q, c)
                    new = (cost + 2, edits + "I", kept + [(NAMES[c], "")])
                    if to is not None and (to not in table or new[:2] < table[to][:2]):
                        table[to] = new
        return table

    for role, text, fault in rows:
        after = {}
        for q, (cost, edits, kept) in relax(best).items():
            more = [(q, cost + 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                extra = cost + (fault == "truncated")
                more += [(step(q, role[:1]), extra, "K", [(role, text)])]
                more += [(step(q, c), extra + 2, "R", [(NAMES[c], text)]) for c in "ua"]
            for to, total, letter, line in more:
                new = (total, edits + letter, kept + line)
                if to is not None and (to not in after or new[:2] < after[to][:2]):
                    after[to] = new
        best = after
    return min((v for q, v in relax(best).items() if q in ("", "a")), key=lambda v: v[:2])


def expected(rows):
    out = []
    for c, own in damaged(rows).items():
        seen, faulty, count = set(), [], Counter()
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
            faulty.append((role, text, fault))
            count[fault] += 1
        count["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        at = [t for t, _, _ in own if t is not None]
        cost, edits, kept = cheapest(faulty)
        assert PATTERN.fullmatch("".join(r[:1] for r, _ in kept))
        out.append((c, max(at) - min(at) + 1 - len(set(at)) if at else 0, count["blank"], count["duplicate"],
                    count["truncated"], count["illegal"], cost, edits,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return out


def conversations(rng, n, longest):
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown"])
            text = rng.choice([f"text {t}.", f"text {t}", "same words!", "", None, " \n", "é?  ", f"{t} a.\t"])
            rows.append((c, rng.choice([t, t, t, t + 1, None]), role, text))
    rows += [(None, 0, "user", "no id."), (None, None, "assistant", "none."), (900, None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "old", 1) for r in rows], TURNS)


def test_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = contract.queries()["op12_turn_repair"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows))


@pytest.mark.parametrize("piece", [turns.PIECE_ROWS, 3, 1])
def test_random_conversations(spark, monkeypatch, piece):
    monkeypatch.setattr(turns, "PIECE_ROWS", piece)
    rows = conversations(random.Random(piece), 60, 14)
    got = turns.report(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(rows)))


def test_long_conversation_over_several_ranges(spark, monkeypatch):
    """Half of all rows are one conversation; a third of these are one turn, said over and over."""
    monkeypatch.setattr(turns, "PIECE_ROWS", 50)
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"turn {t}{rng.choice(['.', '', '!'])}") for t in range(600)]
    rows += [(1, 5000, "user", "again.")] * 300 + [(1, t, "user", "again.") for t in range(700, 760)]
    rows += [r for r in conversations(rng, 150, 8) if r[0] != 1]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = turns.report(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(rows)))


def test_repaired_rows(spark, monkeypatch):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "user", "And you?"), (1, 3, "assistant", "Fine."),
            (2, 0, "assistant", "Hm."), (3, 0, "user", "")]
    want = {1: [("system", "Be kind."), ("user", "Hello?"), ("assistant", ""), ("user", "And you?"), ("assistant", "Fine.")],
            2: [("user", ""), ("assistant", "Hm.")]}
    for piece in (100, 2):
        monkeypatch.setattr(turns, "PIECE_ROWS", piece)
        got = defaultdict(list)
        for r in turns.repair(frame(spark, rows)).orderBy("conv_id", "position").collect():
            got[r["conv_id"]].append((r["role"], r["text"]))
        assert got == want


def test_no_conversations(spark):
    assert turns.report(brute.empty(spark, TURNS)).count() == 0
    assert turns.repair(brute.empty(spark, TURNS)).count() == 0
    c = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert [tuple(r) for r in turns.report(frame(spark, [(c, 0, "user", "gone.")])).collect()] == [
        (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_auction_equals_relaxation():
    """Prices on random graphs with free arcs but no free cycle."""
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randrange(2, 12)
        arcs = [[(k, rng.randrange(0 if j > i else 1, 6), j) for k, j in enumerate(rng.choices(range(n), k=3))]
                for i in range(n - 1)] + [[]]
        # Only nodes that reach the last one can be priced.
        far = {n - 1}
        for _ in range(n):
            far |= {i for i in range(n) if any(j in far for _, _, j in arcs[i])}
        arcs = [[a for a in own if a[2] in far] if i in far else [] for i, own in enumerate(arcs)]
        price, settled = [0] * n, [False] * (n - 1) + [True]
        turns.auction(arcs, price, settled, range(n - 2, -1, -1))
        want = [turns.NEVER] * (n - 1) + [0]
        for _ in range(n):
            want = [min([want[i], *[c + want[j] for _, c, j in arcs[i]]]) for i in range(n)]
        assert price == want
