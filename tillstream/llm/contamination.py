"""Passages of benchmark items in documents, by word windows; DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words. A window is ``WINDOW`` consecutive words of an item;
an item of fewer words is one window. The hashes of all windows are matched with the hashes of the
documents' windows, and each match is verified word by word. Words inside a verified window are hit.

Null and empty texts have no words; an item without words has no window. An item that is there
twice counts once per id. Repeated documents are answered each; all columns are kept.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.lines import apart, back, computed, row_key
from tillstream.session import settle

WINDOW = 10
# The characters that words are made of, after and before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Benchmark windows that are broadcast at most (some 200 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 1 << 18


def words(text: str | Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hashes(of: Column, size: int) -> Column:
    """Hash of each window of ``size`` words, by start; no window if there are fewer words."""
    starts = F.when(F.size(of) >= size, F.sequence(F.lit(1), F.size(of) - (size - 1)))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(of, i, size)))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct window: its hash, its words, and the ids of the items that hold it."""
    items = computed(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"),
                     "words", words("text")).filter(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    starts = items.select("item", "words", size.alias("size"),
                          F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at"))
    grams = starts.select("item", F.slice("words", F.col("at"), F.col("size")).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("gram").alias("hash"), "gram", "items")


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns (as ``own_`` and the name), ``words``, and ``hits``: start (from 0), words
    and items of every benchmark window in the document."""
    grams = settle(benchmark_windows(benchmark, window), "windows")
    # At most ``window`` different sizes.
    sizes = sorted(r[0] for r in grams.select(F.size("gram")).distinct().collect())
    if grams.count() <= BROADCAST_WINDOWS:
        grams = F.broadcast(grams)
    keys = ["_row1", "_row2"]
    cut = computed(docs.select(*row_key("doc_id", "text"), "text"), "words", words("text"))
    # Window hashes, one array for each size; a benchmark without windows matches none.
    hashes = F.array(*[_hashes(F.col("words"), n) for n in sizes or [window]])
    found = (cut.select(*keys, F.explode(hashes).alias("hashes"))
             .select(*keys, F.posexplode("hashes").alias("start", "hash"))
             .join(grams, "hash")
             .groupBy(*keys).agg(F.collect_set(F.struct("start", "gram", "items")).alias("found")))
    rows = docs.select(*apart(docs), *row_key("doc_id", "text")).join(found, keys, "left")
    rows = computed(rows.drop(*keys), "words", words("own_text"))
    verified = F.filter("found", lambda h: F.slice("words", h.start + 1, F.size(h.gram)) == h.gram)
    return computed(rows, "hits", F.coalesce(verified, F.array())).drop("found")


def _hit_words() -> Column:
    return F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h.start, h.start + F.size(h.gram) - 1))))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = mark(docs.select("doc_id", "text"), benchmark)
    rows = rows.select(F.col("own_doc_id").alias("doc_id"), F.size("words").cast("long").alias("n_words"),
                       F.size(_hit_words()).cast("long").alias("n_hit"),
                       F.array_distinct(F.flatten(F.transform("hits", lambda h: h.items))).alias("items"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows in which no benchmark window occurs."""
    return mark(docs, benchmark).filter(F.size("hits") == 0).select(*back(docs))


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All rows; hit words are cut out of ``text``, with what stands between two hit words."""
    rows = computed(mark(docs, benchmark), "hit", _hit_words())
    rows = computed(rows, "own", F.regexp_extract_all("own_text", F.lit(ANY_CASE_WORD), F.lit(0)))
    rows = computed(rows, "gaps", F.split("own_text", ANY_CASE_WORD, -1))
    # Gaps at even places, words at odd ones. Gone are the hit words and the gaps between two of them; taken
    # off as a set, by hashing, so that a long text does not cost its square.
    between = F.array_intersect("hit", F.transform("hit", lambda i: i + 1))
    gone = F.concat(F.transform("hit", lambda i: 2 * i + 1), F.transform(between, lambda i: 2 * i))
    rows = computed(rows, "left", F.array_except(F.sequence(F.lit(0), 2 * F.size("own")), gone))
    half = lambda k: F.shiftright(k, 1)
    piece = lambda k: F.when(k % 2 == 0, F.get("gaps", half(k))).otherwise(F.get("own", half(k)))
    left = F.array_join(F.transform("left", piece), "")
    text = F.when(F.size("hit") > 0, left).otherwise(F.col("own_text"))
    return rows.select(*back(docs, text=text))


REPORT_SQL = r"""
with d as (select doc_id, text, regexp_extract_all(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from (select distinct doc_id, text from documents)),
b as (select cast(item_id as varchar) as item, regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
g as (select distinct item, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as gram,
             least(len(w), 10) as size
      from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
            from b where len(w) > 0)),
s as (select distinct size from g),
p as (select doc_id, text, i, size, array_to_string(w[i:i + size - 1], ' ') as gram
      from (select doc_id, text, w, size, unnest(range(1, len(w) - size + 2)) as i
            from d, s where len(w) >= size)),
h as (select p.doc_id, p.text, p.i, p.size, g.item from p join g on p.gram = g.gram and p.size = g.size),
c as (select doc_id, text, count(distinct x) as n_hit from
      (select doc_id, text, unnest(range(i, i + size)) as x from h) group by doc_id, text),
m as (select doc_id, text, count(distinct item) as n_items,
             sha256(string_agg(distinct item, ',' order by item)) as items_sha256
      from h group by doc_id, text)
select x.doc_id, coalesce(len(d.w), 0) as n_words, coalesce(c.n_hit, 0) as n_hit,
       coalesce(m.n_items, 0) as n_items, coalesce(m.items_sha256, sha256('')) as items_sha256,
       coalesce(c.n_hit, 0) > 0 as contaminated
from documents x
left join d on x.doc_id is not distinct from d.doc_id and x.text is not distinct from d.text
left join c on x.doc_id is not distinct from c.doc_id and x.text is not distinct from c.text
left join m on x.doc_id is not distinct from m.doc_id and x.text is not distinct from m.text
"""
