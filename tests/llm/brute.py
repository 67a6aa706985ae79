"""Plain, slow forms of the operators, and small tables with the awkward cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, cell string, _row1 int"


def awkward(spark, texts=()):
    """Documents with null columns, empty, blank and very long texts, copies, and repeated rows."""
    own = [None, "", "  \n\t ", "é", "One two", "ONE TWO", "the cat sat on the mat. " * 3000,
           "x" * 30000, "7 " * 12, "<|endoftext|> a", *texts]
    rows = [(k, t, "en", f"s{k % 3}", len(t or ""), "c", k) for k, t in enumerate(own)]
    rows += [rows[4], (None, "no id here at all", None, None, None, None, None),
             (50, own[6], None, None, None, None, None), (51, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1))


def near_groups(rows, size, percent):
    """Smallest linked id of each id; rows of one id are one document."""
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(k)
    for k, (i, s) in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j > k)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(sets[j][0])
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def repeated_bytes(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, digest) of each row."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for s in range(len(b) - length + 1):
                w = b[s:s + length]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1) if i is not None else ():
            if first[b[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, sha(kept)))
    return out


_FORMS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        n = int(c) * (2 if k % 2 else 1)
        total += n // 10 + n % 10
    return total % 10 == 0


def personal(text):
    """Base spans as kind:start:end, joined."""
    found = []
    for k, (kind, form) in enumerate(_FORMS):
        for m in re.finditer(form, text or ""):
            d = "".join(c for c in m[0] if c in "0123456789")
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 12 <= len(d) <= 19 and _luhn(d)
                    or kind == "phone" and 9 <= len(d) <= 15):
                found.append((m.start(), k, m.end()))
    return ",".join(f"{_FORMS[k][0]}:{s}:{e}" for s, k, e in sorted(found))
