"""Personal data by fixed patterns, and more of it by bootstrapping from the contexts found.

Base: e-mail and IP addresses, card and phone numbers by their form. They are the seeds of a graph
of values and contexts (the words before and after). A context is trusted by how many distinct
values it holds and what part of them is known to be of one kind; a value by the contexts that it is
in. Values that look like identifiers, were not found by their form, and are seen in enough trusted
contexts become known, and the contexts are weighed anew, until a round adds no value. Such values are runs without blanks, numbers
written in groups of digits with single blanks, brackets or hyphens between them, and addresses whose
signs are written out ("at", "dot"). At the end every identifier-like string
whose value is known is marked. All weighing is done by Spark joins and sums over all documents.

Texts: null counts as empty and has no spans; whole texts are searched, in time linear in their
length. Positions are code points, end exclusive. Repeated rows are answered each; a value seen
twice in one context counts once, so copies of a document lend no weight.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.batches import map_pieces
from tillstream.llm.lines import row_key
from tillstream.session import settle

KINDS = ["email", "ip", "card", "phone"]
# Distinct values that a context must hold, the part of them that must be of the kind, and the
# weight that a value must reach.
LEAST_VALUES, LEAST_PART, LEAST_WEIGHT = 8, 0.8, 0.95
# Characters looked at first for the words beside a value; more where words are longer.
BESIDE = 80

# The forms of the base kinds. Look-behinds and possessive repeats change no match;
# they keep long runs of digits linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Identifier-like: a run of non-blanks with a digit, an at-sign or an underscore, without the
# punctuation around it.
_LIKE = re.compile(r"[0-9@_]")
# Groups of digits of one number, and what may be between two of them.
_GROUP = re.compile(r"[0-9]++")
_BETWEEN = re.compile(r"(?=.)[)\]]?(?:[ ./-]| - )?[(\[]?", re.DOTALL)
MOST_DIGITS = 19
# Digits from which on the first group of a number in groups may be an identifier by itself.
OWN_DIGITS = 7
# The signs of an address written out, and the host behind it.
_DOT = re.compile(r" ?[(\[{<] ?dot ?[)\]}>] ?| dot ", re.IGNORECASE | re.ASCII)
_AT = re.compile(r" ?[(\[{<] ?at ?[)\]}>] ?| at ", re.IGNORECASE | re.ASCII)
_HOST = re.compile(rf"[a-z0-9-]++(?:(?:\.|{_DOT.pattern})[a-z0-9-]++)*(?:\.|{_DOT.pattern})[a-z]{{2,}}(?![a-z0-9-])",
                   re.IGNORECASE | re.ASCII)
_DOT_END = re.compile(rf"(?:{_DOT.pattern})\Z", re.IGNORECASE | re.ASCII)
_EDGE = " \t\n\r\x0b\x0c\"'`.,;:!?()[]{}<>|=*#%&$"


def emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        at = text.find("@", max(done, at + 1))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _small(part: str) -> bool:
    """Whether a number is at most 255; leading zeros do not count."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of all base spans, in this order."""
    found = [(s, 0, e) for s, e in emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            own = _digits(m[0])
            if 12 <= len(own) <= 19 and luhn(own):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                  if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def _merged(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """Start and end of what the spans cover, in order."""
    merged: list[list[int]] = []
    for s, e in sorted((s, e) for s, _, e in spans):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return merged


def like(text: str, merged: list[list[int]]) -> list[tuple[int, int]]:
    """Identifier-like runs without blanks outside the spans."""
    found, done, k = [], 0, 0
    for m in _LIKE.finditer(text):
        at = m.start()
        if at < done:
            continue
        while k < len(merged) and merged[k][1] <= at:
            k += 1
        if k < len(merged) and merged[k][0] <= at:
            done = merged[k][1]
            continue
        # Nothing before ``done`` is taken, so each character is looked at a fixed number of times.
        floor = max(done, merged[k - 1][1] if k else 0)
        ceiling = merged[k][0] if k < len(merged) else len(text)
        start = at
        while start > floor and not text[start - 1].isspace():
            start -= 1
        end = at + 1
        while end < ceiling and not text[end].isspace():
            end += 1
        done = end
        while start < end and text[start] in _EDGE:
            start += 1
        while start < end and text[end - 1] in _EDGE:
            end -= 1
        if end - start >= 4:
            found.append((start, end))
    return found


def grouped(text: str, merged: list[list[int]]) -> list[tuple[int, int, int]]:
    """Numbers in several groups, with a blank or bracket between some of them, outside the spans:
    start, end, and where the first group begins.

    A row of groups is one number as far as it has ``MOST_DIGITS`` digits; a longer row is proposed
    from each of its groups on, each time as long as it may be.
    """
    found: list[tuple[int, int, int]] = []
    row: list[tuple[int, int]] = []

    def propose():
        last, digits = 0, 0
        for first, (begin, _) in enumerate(row):
            while last < len(row) and digits + row[last][1] - row[last][0] <= MOST_DIGITS:
                digits += row[last][1] - row[last][0]
                last += 1
            if last > first:
                start, end = begin, row[last - 1][1]
                if any(c in " ()[]" for c in text[start:end]):
                    if start and text[start - 1] in "([" and {"(": ")", "[": "]"}[text[start - 1]] in text[start:end]:
                        start -= 1
                    if start and text[start - 1] == "+":
                        start -= 1
                    found.append((start, end, begin))
                digits -= row[first][1] - begin
            else:
                last = first + 1
            if last == len(row):
                break
        row.clear()

    def of_word(c: str) -> bool:
        return c.isalnum() or c in "_@"

    k = 0
    for m in _GROUP.finditer(text):
        s, e = m.span()
        while k < len(merged) and merged[k][1] <= s:
            k += 1
        taken = k < len(merged) and merged[k][0] < e
        if row and not (0 < s - row[-1][1] <= 5 and _BETWEEN.fullmatch(text, row[-1][1], s)):
            propose()
        if taken or s and of_word(text[s - 1]) or e < len(text) and of_word(text[e]):
            propose()
        else:
            row.append((s, e))
    propose()
    return found


def written(text: str, merged: list[list[int]]) -> list[tuple[int, int, str]]:
    """Addresses with their signs written out, outside the spans: start, end, and the address."""
    found, done, k = [], 0, 0
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        if not host:
            continue
        start = m.start()
        while True:
            part = start
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            dot = _DOT_END.search(text, max(done, start - 8), start) if start < part else None
            if not dot or dot.start() <= done or text[dot.start() - 1] not in _LOCAL:
                break
            start = dot.start()
        if start == m.start():
            continue
        done = host.end()
        while k < len(merged) and merged[k][1] <= start:
            k += 1
        if k == len(merged) or merged[k][0] >= done:
            address = f"{_DOT.sub('.', text[start:m.start()])}@{_DOT.sub('.', host[0])}"
            found.append((start, done, address.lower()))
    return found


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str, list[str]]]:
    """Identifier-like strings outside the spans: start, end, value and contexts.

    The first group of a number in groups is not what its context is about, unless it is long
    enough by itself; it has a value but no contexts then.
    """
    merged = _merged(spans)
    found = [(s, e, value, _beside(text, s, e)) for s, e, value in written(text, merged)]
    taken = {(s, e) for s, e, *_ in found}
    numbers = grouped(text, merged)
    heads = {begin for *_, begin in numbers}
    for s, e in like(text, merged):
        if (s, e) not in taken:
            first = s in heads or s + 1 in heads
            short = first and len(_digits(text[s:e])) < OWN_DIGITS
            found.append((s, e, _value(text[s:e]), [] if short else _beside(text, s, e)))
    return found + [(s, e, _value(text[s:e]), _beside(text, s, e)) for s, e, _ in numbers]


def _beside(text: str, start: int, end: int) -> list[str]:
    """The contexts of a span: two words before it, and one word before and after it."""
    size = BESIDE
    # The first word found may be cut off: two whole ones are wanted.
    while len(before := text[max(0, start - size):start].lower().split()) < 3 and size < start:
        size *= 4
    size = BESIDE
    while len(after := text[end:end + size].lower().split()) < 2 and end + size < len(text):
        size *= 4
    one = before[-1] if before else ""
    two = before[-2] if len(before) > 1 else ""
    return [f"{two} {one} _", f"{one} _ {after[0] if after else ''}"]


def _value(s: str) -> str:
    """What is compared of a string: its digits if it is a number in any writing, else its letters
    in lower case. The dots of an address are part of it: without them it would be any number."""
    if _DOTTED.fullmatch(s):
        return s
    return s.lower() if any(c.isalpha() for c in s) else _digits(s) or s


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                   ("value", pa.string()), ("beside", pa.list_(pa.string()))])
_SPAN_SQL = "array<struct<start:bigint,end:bigint,kind:int,value:string,beside:array<string>>>"


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, row key, and all base spans and identifier-like strings (kind -1)."""
    def work(piece):
        rows = []
        for text in piece.column("text").to_pylist():
            text = text or ""
            spans = base(text)
            every = [(s, e, k, _value(text[s:e]), _beside(text, s, e)) for s, k, e in spans]
            every += [(s, e, -1, value, beside) for s, e, value, beside in candidates(text, spans)]
            rows.append([{"start": s, "end": e, "kind": k, "value": value, "beside": beside}
                         for s, e, k, value, beside in every])
        yield pa.RecordBatch.from_arrays(
            [*(piece.column(c) for c in ("doc_id", "_row1", "_row2")),
             pa.array(rows, pa.list_(_SPAN))], ["doc_id", "_row1", "_row2", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_pieces(docs.select("doc_id", "text", *row_key("doc_id", "text")), work,
                      f"doc_id {kind}, _row1 long, _row2 long, spans {_SPAN_SQL}")


def known_values(found: DataFrame) -> DataFrame:
    """value, kind and weight: the seeds (weight 1), then what the rounds add."""
    each = found.select(F.explode("spans").alias("s")).select("s.*")
    known = settle(each.filter("kind >= 0").select("value", "kind", F.lit(1.0).alias("weight")).distinct(),
                   "seeds")
    edges = settle(each.select("value", F.explode("beside").alias("beside")).distinct(), "edges")
    while True:
        own = edges.join(known, "value", "left")
        # Values of several kinds count for each; the whole is the number of distinct values.
        whole = edges.groupBy("beside").agg(F.count("*").alias("values"))
        trusted = (own.filter("kind is not null").groupBy("beside", "kind").agg(F.sum("weight").alias("sum"))
                   .join(whole, "beside").withColumn("part", F.col("sum") / F.col("values"))
                   .filter((F.col("values") >= LEAST_VALUES) & (F.col("part") >= LEAST_PART)))
        # A context with few values proves less: one more of another kind is reckoned with.
        trust = F.col("sum") / (F.col("values") + 1)
        new = (edges.join(known.select("value").distinct(), "value", "left_anti")
               .join(trusted.select("beside", "kind", trust.alias("trust")), "beside")
               .groupBy("value", "kind").agg(F.sum(F.log(1 - F.col("trust"))).alias("doubt")))
        best = new.groupBy("value").agg(F.min(F.struct("doubt", "kind")).alias("b")).select(
            "value", "b.kind", (1 - F.exp("b.doubt")).alias("weight")).filter(
            F.col("weight") >= LEAST_WEIGHT)
        best = settle(best, "values")
        if best.isEmpty():
            return known
        known = settle(known.unionByName(best), "seeds")


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", _name(s.kind), s.start, s.end)), ",")


def spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``added``: arrays of (start, kind number, end)."""
    found = settle(find(docs), "spans")
    known = known_values(found).groupBy("value").agg(F.max_by("kind", F.struct("weight", -F.col("kind")))
                                                     .alias("known"))
    loose = found.select("_row1", "_row2", F.explode("spans").alias("s")).filter("s.kind < 0")
    added = (loose.select("_row1", "_row2", "s.start", "s.end", "s.value").join(known, "value")
             .groupBy("_row1", "_row2").agg(F.collect_set(F.struct(
                 "start", F.col("known").alias("kind"), "end")).alias("added")))
    own = F.transform(F.filter("spans", lambda s: s.kind >= 0),
                      lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    rows = found.select("doc_id", "_row1", "_row2", own.alias("base")).join(
        added, ["_row1", "_row2"], "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.select("doc_id", "base", F.coalesce("added", none).alias("added"))


def report(docs: DataFrame) -> DataFrame:
    rows = spans(docs.select("doc_id", "text"))
    def of(kind: int):
        # A second parameter would be taken for the place in the array.
        return lambda s: s.kind == kind

    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(F.concat("base", "added")).alias("spans"),
                       F.size("added").cast("long").alias("n_added"))
