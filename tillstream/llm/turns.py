"""Repair of damaged conversations by cheapest edits, found by an auction over an integer lattice.

A repaired conversation has the roles ``(s?(ua)+)?``: nothing, or an optional system turn and pairs of
user and assistant. The nodes of the lattice are (rows read, state of that pattern); its arcs keep a
row, give it another role, delete it, or insert an empty turn, at integer costs. The auction holds a
price per node, never above the cheapest way to the end. A path grows from an origin along an arc that
its price pays for exactly (extension), and where none does, the node's price rises and the path gives
the node back (contraction). Origins are taken from the end backwards, and a path ends at a node whose
price has converged, so that each node is visited a few times. Converged prices expose all tight arcs; every arc
carries another letter than its neighbours, so that following the least tight letter gives the one
ASCII-least cheapest list of edits.

Conversations may have any length. Rows are ordered by ranges of (conversation, turn), which cut long
conversations too, and worked on in pieces of at most ``PIECE_ROWS`` rows. A piece that is not surely a
whole conversation is solved from each state to each state; the same auction over these small tables
then joins the pieces (one row of sixteen costs per piece, in one task per conversation). Only the final digest passes all
repaired rows of one conversation through one task, as a stream: SHA-256 has no other form.

Rows: null role and text count as one blank, null turns come first, rows of one turn are ordered by role
and text, and a null conv_id is a conversation of its own. Equal rows of one turn are counted before the
shuffle. Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.session import settle

PIECE_ROWS, PIECE_BYTES = 4_096, 4 << 20
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The user or assistant turn that may follow each state, whose name is that of the state it leads to.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# What is missing at the end after each state, and what it costs to insert it.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
NEVER = float("inf")


# the auction

def auction(arcs: list[list[tuple]], price: list, settled: list[bool], origins) -> None:
    """Raise ``price`` to the cost of the cheapest way from each origin to a node settled before.

    ``arcs[i]`` lists (letter, cost, node). Prices must not exceed costs plus the price of the arc's
    end, and cycles must cost something. A node without any way gets the price ``NEVER``.
    """
    for origin in origins:
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            best, to = NEVER, -1
            for _, cost, end in arcs[node]:
                if cost + price[end] < best:
                    best, to = cost + price[end], end
            if price[node] < best:
                price[node] = best
                settled[node] = best == NEVER
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            settled[node] = True


@dataclass
class Row:
    initial: str
    fault: str
    copies: int
    role: str = ""
    text: str = ""


def lattice(rows: list[Row], into: set[int]) -> list[list[tuple]]:
    """Arcs of the nodes 4 * rows read + state, in the order of their letters, between the states that
    lead to a wanted end. Copies of a row are deleted right after it."""
    arcs = []
    for k, row in enumerate(rows):
        here, there = 4 * k, 4 * k + 4
        rest = DELETE * (row.copies - 1)
        stay = rest + TRUNCATED * (row.fault == "truncated")
        for q in STATES:
            own = [("D", DELETE + rest, there + q)]
            if FOLLOWS[q] in into:
                own.append(("I", INSERT, here + FOLLOWS[q]))
            if row.fault not in ("blank", "duplicate"):
                kept = NEXT.get((q, row.initial))
                if kept in into:
                    own.append(("K", stay, there + kept))
                if FOLLOWS[q] in into:
                    own.append(("R", RENAME + stay, there + FOLLOWS[q]))
            arcs.append(own if q in into else [])
    arcs.extend([] for _ in STATES)
    return arcs


def _priced(rows: list[Row], ends: dict[int, int]) -> tuple[list, list]:
    """The lattice and its converged prices, when the states of ``ends`` cost that much at the end."""
    # Nothing leads back to the first two states.
    into = set(STATES) if max(ends) >= USER else set(range(max(ends) + 1))
    arcs = lattice(rows, into)
    price, settled = [0] * len(arcs), [False] * len(arcs)
    for q in STATES:
        price[4 * len(rows) + q] = ends.get(q, NEVER)
        settled[4 * len(rows) + q] = True
    auction(arcs, price, settled, range(4 * len(rows) - 1, -1, -1))
    return arcs, price


def _trace(rows: list[Row], arcs: list, price: list, state: int) -> tuple[str, int]:
    """The least letters along tight arcs, and the state at the end."""
    letters, node, last = [], state, 4 * len(rows)
    while node < last:
        letter, _, end = next(a for a in arcs[node] if a[1] + price[a[2]] == price[node])
        letters.append(letter + "D" * (rows[node // 4].copies - 1) * (letter != "I"))
        node = end
    return "".join(letters), node - last


def solve(rows: list[Row]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    arcs, price = _priced(rows, {q: INSERT * len(x) for q, x in ENDING.items()})
    edits, state = _trace(rows, arcs, price, START)
    return price[START], edits + ENDING[state]


def solve_piece(rows: list[Row]) -> tuple[list[int], list[int], list[str]]:
    """From each state to each state: cost (-1: no way), rank of the edits among those of the same
    start, and the edits. No edits of one start are the beginning of others."""
    costs, edits = [-1] * 16, [""] * 16
    for end in STATES:
        arcs, price = _priced(rows, {end: 0})
        for start in STATES:
            if price[start] != NEVER:
                costs[4 * start + end] = price[start]
                edits[4 * start + end] = _trace(rows, arcs, price, start)[0]
    ranks = [sorted(edits[4 * (k // 4):4 * (k // 4) + 4]).index(e) for k, e in enumerate(edits)]
    return costs, ranks, edits


def join_pieces(tables: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]]]:
    """Cost of a conversation, and the states before and after each of its pieces: the auction over the
    pieces' tables, an arc's letter being its rank."""
    arcs = [[(ranks[4 * q + r], costs[4 * q + r], 4 * k + 4 + r) for r in STATES if costs[4 * q + r] >= 0]
            for k, (costs, ranks) in enumerate(tables) for q in STATES] + [[] for _ in STATES]
    last = 4 * len(tables)
    price = [0] * last + [INSERT * len(ENDING[q]) for q in STATES]
    auction(arcs, price, [False] * last + [True] * 4, range(last - 1, -1, -1))
    node, steps = START, []
    while node < last:
        end = min(a for a in arcs[node] if a[1] + price[a[2]] == price[node])[2]
        steps.append((node % 4, end % 4))
        node = end
    return price[START], steps


def replay(rows: list[Row], edits: str, state: int) -> Iterator[tuple[str, str]]:
    """Role and text of each repaired row."""
    coming, k, copies = iter(rows), None, 0
    for letter in edits:
        if letter == "I":
            state = FOLLOWS[state]
            yield NAMES[state], ""
            continue
        if not copies:
            k = next(coming)
            copies = k.copies
        copies -= 1
        if letter == "K":
            state = NEXT[state, k.initial]
            yield k.role, k.text
        elif letter == "R":
            state = FOLLOWS[state]
            yield NAMES[state], k.text


# conversations of a table

def damage(df: DataFrame) -> DataFrame:
    """``df`` (conv_id, turn, role, text) with seeded faults, and ``copies`` of each row: 0 drops it."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    code = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return df.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn, equal ones as one with ``copies``, and their faults."""
    there = F.col("copies") > 0
    # A dropped row leaves no trace but its conversation.
    rows = rows.select("conv_id", F.when(there, F.col("turn")).alias("turn"),
                       *[F.when(there, F.col(c)).otherwise("").alias(c) for c in ("role", "text")], "copies")
    rows = settle(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    end = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    rows = rows.select("*", (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    digest = F.unhex(F.sha2("text", 256))
    at = F.struct(F.col("turn").isNotNull(), "turn")
    seen = (rows.filter("copies > 0 and not blank").groupBy("conv_id", "role", digest.alias("digest"))
            .agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    # Few, as a rule: once written, their size is known when the join is planned.
    seen = settle(seen.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "digest", "first"), "seen")
    joined = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                       & (digest == F.col("digest")) & ~F.col("blank"), "left")
    fault = (F.when(F.col("blank"), "blank").when(F.coalesce(at > F.col("first"), F.lit(False)), "duplicate")
             .when(F.col("truncated"), "truncated").otherwise(""))
    flagged = joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))
    # The beginning of a text is enough to cut ranges within a turn; the order is by whole texts.
    return (flagged.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
            .sortWithinPartitions("conv_id", "turn", "role", "text"))


@dataclass
class Piece:
    """Consecutive rows of one conversation, and what is counted over them."""
    conv_id: object
    rows: list[Row] = field(default_factory=list)
    size: int = 0
    turns: list = field(default_factory=lambda: [None, None, 0])
    counts: dict = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))

    def add(self, turn, row: Row) -> None:
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        first = "duplicate" if row.fault in ("", "truncated") else row.fault
        self.counts[first] += row.copies - 1
        if row.fault:
            self.counts[row.fault] += 1
        if self.rows:
            self.counts["illegal"] += self.rows[-1].initial + row.initial not in LEGAL
        self.counts["illegal"] += (row.copies - 1) * (2 * row.initial not in LEGAL)
        self.rows.append(row)
        self.size += len(row.text)


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_RESULT = pa.schema([("gaps", pa.int64()), *[(c, pa.int64()) for c in [*_COUNTS, "cost"]], ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PIECE = pa.schema([
    ("shard", pa.int64()), ("piece", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("turns", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())), ("edits", pa.list_(pa.string())),
    ("rows", pa.list_(pa.struct([("initial", pa.string()), ("fault", pa.string()), ("copies", pa.int64()),
                                 ("role", pa.string()), ("text", pa.string())])))])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>",
             pa.list_(pa.string()): "array<string>", _MESSAGES: "array<struct<role:string,text:string>>",
             _PIECE.field("rows").type: "array<struct<initial:string,fault:string,copies:long,role:string,text:string>>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _joined(messages: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()


def _whole(p: Piece, texts: bool) -> dict:
    cost, audit = solve(p.rows)
    messages = list(replay(p.rows, audit, START))
    low, high, different = p.turns
    return {"conv_id": p.conv_id, "gaps": high - low + 1 - different if different else 0, **p.counts, "cost": cost,
            "audit": audit, "repaired_sha256": _joined(messages),
            "messages": [{"role": r, "text": t} for r, t in messages] if texts else None}


def _part(p: Piece, shard: int, number: int) -> dict:
    costs, ranks, edits = solve_piece(p.rows) if p.rows else ([-1] * 16, [0] * 16, [""] * 16)
    return {"conv_id": p.conv_id, "shard": shard, "piece": number, **p.counts, "first_turn": p.turns[0],
            "last_turn": p.turns[1], "turns": p.turns[2], "costs": costs, "ranks": ranks, "edits": edits,
            "first_initial": p.rows[0].initial if p.rows else None,
            "last_initial": p.rows[-1].initial if p.rows else None,
            "rows": [vars(r) if r.fault not in ("blank", "duplicate") else vars(r) | {"role": "", "text": ""}
                     for r in p.rows]}


def _emit(rows: Iterator[dict], fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows, bounded by the text they hold."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1_000 + sum(len(m["text"]) for c in ("messages", "rows") for m in row.get(c) or ())
        if size >= PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(held, fields)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, fields)


def solved(rows: DataFrame, texts: bool = False) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, copies): counts of faults, cost and edits,
    digest of the repaired rows and, with ``texts``, these rows as an array ``messages``."""
    ordered = _in_order(rows)
    key = pa.field("conv_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[
        ordered.schema["conv_id"].dataType.simpleString()])
    name = f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, "
    result = pa.schema([key, *_RESULT, ("messages", _MESSAGES)])
    out = pa.schema([*result, *_PIECE])

    def cut(batches):
        """Each piece, and whether it is surely a whole conversation."""
        piece, whole = None, False
        for batch in batches:
            for r in batch.to_pylist():
                if piece is None or r["conv_id"] != piece.conv_id:
                    if piece is not None:
                        yield piece, whole
                    # The first run of a partition may continue one of the partition before.
                    piece, whole = Piece(r["conv_id"]), piece is not None
                elif len(piece.rows) >= PIECE_ROWS or piece.size >= PIECE_BYTES:
                    yield piece, False
                    piece, whole = Piece(r["conv_id"]), False
                if r["copies"]:
                    piece.add(r["turn"], Row(r["role"][:1], r["fault"], r["copies"], r["role"], r["text"]))
        if piece is not None:
            yield piece, False

    def first(batches):
        shard = TaskContext.get().partitionId()
        yield from _emit((_whole(p, texts) if whole else _part(p, shard, k)
                          for k, (p, whole) in enumerate(cut(batches))), out)

    found = settle(ordered.mapInArrow(first, name + _ddl(pa.schema([*_RESULT, ("messages", _MESSAGES), *_PIECE]))), "pieces")
    parts = found.filter("shard is not null")

    def runs(batches):
        """The rows of each conversation, one conversation after the other, each as an iterator."""
        def flat():
            for batch in batches:
                yield from batch.to_pylist()
        rows, ahead = flat(), None
        ahead = next(rows, None)
        while ahead is not None:
            own = ahead["conv_id"]

            def run(own=own):
                nonlocal ahead
                while ahead is not None and ahead["conv_id"] == own:
                    row = ahead
                    yield row
                    ahead = next(rows, None)
            yield own, run()

    steps_schema = pa.schema([("s", pa.int64()), ("p", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                              ("gaps", pa.int64()), *[(f"n_{c}", pa.int64()) for c in [*_COUNTS, "cost"]]])

    def second(batches):
        for _, run in runs(batches):
            pieces = list(run)
            full = [p for p in pieces if p["first_initial"] is not None]
            cost, steps = join_pieces([(p["costs"], p["ranks"]) for p in full])
            totals = {f"n_{c}": sum(p[c] for p in pieces) for c in _COUNTS} | {"n_cost": cost}
            turns, low, high = 0, None, None
            for before, p in zip([None, *full], full):
                if before:
                    totals["n_illegal"] += before["last_initial"] + p["first_initial"] not in LEGAL
                if p["turns"]:
                    turns += p["turns"] - (p["first_turn"] == high)
                    low, high = p["first_turn"] if low is None else low, p["last_turn"]
            totals["gaps"] = high - low + 1 - turns if turns else 0
            if not full:
                full, steps = pieces[:1], [(START, START)]
            yield from _emit(({"s": p["shard"], "p": p["piece"], "start": a, "end": b, **totals}
                              for p, (a, b) in zip(full, steps)), steps_schema)

    order = ["conv_id", "shard", "piece"]
    small = [*order, *_COUNTS, "first_turn", "last_turn", "turns", "first_initial", "last_initial", "costs", "ranks"]
    steps = parts.select(*small).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(second, _ddl(steps_schema))
    chosen = parts.select(*order, "edits", "rows").join(steps, (F.col("shard") == F.col("s")) & (F.col("piece") == F.col("p")))

    def third(batches):
        def rows():
            for conv_id, run in runs(batches):
                digest, audit, kept, any_yet, last = hashlib.sha256(), [], [], False, None
                for last in run:
                    edits = last["edits"][4 * last["start"] + last["end"]]
                    audit.append(edits)
                    for role, text in replay([Row(**r) for r in last["rows"]], edits, last["start"]):
                        digest.update(("\n" * any_yet + f"{role}:{text}").encode())
                        any_yet = True
                        if texts:
                            kept.append({"role": role, "text": text})
                audit.append(ENDING[last["end"]])
                for role, text in replay([], audit[-1], last["end"]):
                    digest.update(f"\n{role}:{text}".encode())
                    if texts:
                        kept.append({"role": role, "text": text})
                yield {"conv_id": conv_id, "gaps": last["gaps"], **{c: last[f"n_{c}"] for c in [*_COUNTS, "cost"]},
                       "audit": "".join(audit), "repaired_sha256": digest.hexdigest(),
                       "messages": kept if texts else None}
        yield from _emit(rows(), result)

    joined = (chosen.repartition("conv_id").sortWithinPartitions(*order)
              .mapInArrow(third, name + _ddl(pa.schema([*_RESULT, ("messages", _MESSAGES)]))))
    return found.filter("shard is null").select(*joined.columns).unionByName(joined)


def repair(df: DataFrame) -> DataFrame:
    """The repaired rows of ``df`` (conv_id, turn, role, text) as it stands: conv_id, position, role, text."""
    nulls = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), *nulls, F.lit(1).alias("copies"))
    return (solved(rows, texts=True).select("conv_id", F.posexplode("messages").alias("position", "m"))
            .select("conv_id", "position", "m.role", "m.text"))


def report(df: DataFrame) -> DataFrame:
    """Per conversation of ``df``, after damage: its faults, and cost, edits and digest of its repair."""
    return solved(damage(df)).drop("messages")
