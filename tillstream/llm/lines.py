"""Removal of lines that are spread over many sites.

A line's sites are counted with a HyperLogLog sketch per line hash, merged by aggregation. A line
whose estimate is clearly beyond the threshold is boilerplate; estimates within the sketch's error
of the threshold are settled by an exact distinct count of just those lines.

A line is compared without the blanks around it; blank lines and null sites do not count. A document
of which more than ``MOST`` of the characters are such lines keeps them all, as REPORT_SQL has it. Such
a document may be a copy, but also a short page with much boilerplate, whose lines no later stage
removes; ``most=1`` removes every such line from all documents. Null texts stay null and
have no lines; a text that was not null stays so. Repeated rows are treated alike, wherever they
are; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.session import settle

# Sites from which on a line is boilerplate.
SITES = 10
MOST = 0.5
LOG_REGISTERS = 10
# Five standard errors of the sketch.
ERROR = 5 * 1.04 / (1 << LOG_REGISTERS) ** 0.5
BLANKS = " \t\r"


def row_key(*columns: str) -> list[Column]:
    """Two hashes of a row's content, so that rows are joined back right even if ids repeat."""
    return [F.xxhash64(*columns).alias("_row1"), F.xxhash64(F.lit(1), *columns).alias("_row2")]


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row, also where a lambda reads it for each element
    (the optimizer would otherwise put its expression there)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def apart(docs: DataFrame) -> list[Column]:
    """The columns under names that no column made here has."""
    return [quoted(c).alias("own_" + c) for c in docs.columns]


def back(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of ``docs`` under their names again, some of them new."""
    return [new.get(c, quoted("own_" + c)).alias(c) for c in docs.columns]


def _lines(docs: DataFrame) -> DataFrame:
    # The keys are made once per text, below the explosion: above it they would be made for each line.
    rows = computed(docs.select(*row_key("doc_id", "text"), F.col("source").cast("string").alias("site"), "text"),
                    "lines", F.split("text", "\n"))
    exploded = rows.select("_row1", "_row2", "site", F.posexplode("lines").alias("at", "line"))
    line = F.trim("line", F.lit(BLANKS))
    return exploded.filter(line != "").select(
        "_row1", "_row2", "site", "at", F.xxhash64(line).alias("line1"),
        F.xxhash64(F.lit(1), line).alias("line2"))


def spread_lines(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """Hashes of the lines that occur on at least ``sites`` sites."""
    key = ["line1", "line2"]
    lines = _lines(docs).filter("site is not null").select(*key, "site")
    estimates = (lines.groupBy(*key).agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"))
                 .select(*key, F.hll_sketch_estimate("sketch").alias("estimate"))
                 .filter(F.col("estimate") >= sites * (1 - ERROR)))
    estimates = settle(estimates, "line-sites")
    near = estimates.filter(F.col("estimate") <= sites * (1 + ERROR)).select(*key)
    exact = (lines.join(near, key, "left_semi").groupBy(*key, "site").agg(F.lit(1).alias("one"))
             .groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select(*key))
    sure = estimates.filter(F.col("estimate") > sites * (1 + ERROR)).select(*key)
    return sure.unionByName(exact)


def mark(docs: DataFrame, sites: int = SITES, most: float = MOST) -> DataFrame:
    """All rows and columns (as ``own_`` and the name), ``lines`` (the lines as they are) and ``drop``
    (the indexes of those to remove, null or empty for none)."""
    spread = settle(spread_lines(docs, sites), "spread-lines")
    hits = (_lines(docs).select("_row1", "_row2", "at", "line1", "line2")
            .join(spread, ["line1", "line2"], "left_semi")
            .groupBy("_row1", "_row2").agg(F.collect_set("at").alias("hit")))
    joined = docs.select(*apart(docs), *row_key("doc_id", "text")).join(
        hits, ["_row1", "_row2"], "left").drop("_row1", "_row2")
    rows = computed(joined, "lines", F.split("own_text", "\n"))
    rows = computed(rows, "sizes", F.transform("lines", lambda x: F.length(F.trim(x, F.lit(BLANKS)))))
    total = F.aggregate("sizes", F.lit(0), lambda a, b: a + b)
    hit = F.aggregate("hit", F.lit(0), lambda a, i: a + F.get("sizes", i))
    return computed(rows, "drop", F.when(hit <= total * most, F.col("hit"))).drop("hit", "sizes")


def _kept() -> Column:
    """The lines that are not dropped. A set of indexes is taken from another, by hashing, so that the
    work grows with the lines and not with their square."""
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    return F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")


def remove(docs: DataFrame, sites: int = SITES, most: float = MOST) -> DataFrame:
    """The documents without boilerplate lines; ``n_chars``, where it is a column, follows.

    All rows stay. Texts that lose no line are untouched.
    """
    rows = mark(docs, sites, most)
    loses = F.coalesce(F.size("drop") > 0, F.lit(False))
    rows = computed(rows, "text", F.when(loses, _kept()).otherwise(F.col("own_text")))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(loses, F.length("text")).otherwise(F.col("own_n_chars")).cast(
            docs.schema["n_chars"].dataType)
    return rows.select(*back(docs, **new))


def report(docs: DataFrame) -> DataFrame:
    rows = mark(docs.select("doc_id", "text", "source"))
    dropped = F.when(F.size("drop") > 0, F.size("drop")).otherwise(0)
    kept = F.when(dropped > 0, _kept()).otherwise(F.coalesce("own_text", F.lit("")))
    return rows.select(F.col("own_doc_id").alias("doc_id"), F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                       dropped.cast("long").alias("n_removed"),
                       F.sha2(kept, 256).alias("kept_sha256"))


REPORT_SQL = f"""
with l as (
  select doc_id, text, source, unnest(string_split(text, chr(10))) as raw,
         unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null),
t as (select *, trim(raw, ' ' || chr(9) || chr(13)) as line from l),
wide as (select line from t where line <> '' and source is not null
         group by line having count(distinct source) >= {SITES}),
j as (select t.*, wide.line is not null as hit from t left join wide on t.line = wide.line),
d as (
  select doc_id, text, count(distinct pos) as n_lines,
         coalesce(sum(length(line)) filter (where hit), 0) <= {MOST} * sum(length(line)) as page,
         count(distinct pos) filter (where hit) as n_hit,
         string_agg(raw, chr(10) order by pos) filter (where not hit) as rest
  from (select distinct doc_id, text, pos, raw, line, hit from j) group by doc_id, text)
select x.doc_id, coalesce(d.n_lines, 0) as n_lines,
       case when page then n_hit else 0 end as n_removed,
       sha256(case when page and n_hit > 0 then coalesce(rest, '') else coalesce(x.text, '') end)
         as kept_sha256
from documents x left join d on x.doc_id is not distinct from d.doc_id and x.text = d.text
"""
