"""Retention as marks on the rows of the base tables: only keys pass from step to step.

A step never rewrites a table. It adds a mark: rows are old, have a key that is settled as doomed, or lack
one that is settled as held. A later step sees a table less its marks, and reads of it the columns that its
marks and its key need. At the end one pass over each table finds the step each row goes with.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.joins import keyed_join, lookup_join
from tillstream.operators.retention import RETENTION_MONTHS, Tables, cutoff
from tillstream.session import folders, remove, replace_folder, settle


@dataclass(frozen=True)
class Old:
    """Rows of ``table`` that are older than the cut-off; a row without a time is not."""
    table: str
    ts: str


@dataclass(frozen=True)
class Lonely:
    """Old rows of ``table`` that no remaining row of ``child`` points to."""
    table: str
    ts: str
    child: str
    on: str


@dataclass(frozen=True)
class Follow:
    """Rows of ``table`` whose ``parent`` row is old, but for those that a remaining row of ``child`` points to."""
    table: str
    parent: str
    on: str
    parent_ts: str
    child: str | None = None
    child_on: str | None = None


Rule = Old | Lonely | Follow

# The daily run, in order. Within a step, rows that follow a parent are marked before the parent is.
KEY_STEPS: tuple[tuple[str, tuple[Rule, ...]], ...] = (
    ("order_items", (Old("order_items", "order_date"),)),
    ("orders", (Lonely("orders", "order_date", "order_items", "order_id"),)),
    ("products_sku", (Follow("order_items", "products_sku", "sku_id", "deleted_at"),
                      Old("products_sku", "deleted_at"))),
    ("products", (Follow("products_sku", "products", "product_id", "deleted_at", "order_items", "sku_id"),
                  Lonely("products", "deleted_at", "products_sku", "product_id"))),
    ("categories", (Lonely("categories", "deleted_at", "products", "category_id"),)),
    ("delivery_tracking", (Old("delivery_tracking", "shipment_date"),)),
    ("shipments", (Lonely("shipments", "shipment_date", "delivery_tracking", "shipment_id"),)),
    ("purchase_order_items", (Old("purchase_order_items", "order_date"),)),
    ("purchase_orders", (Lonely("purchase_orders", "order_date", "purchase_order_items", "po_id"),)),
    ("suppliers", (Lonely("suppliers", "deleted_at", "purchase_orders", "supplier_id"),)),
    ("financial_transactions", (Old("financial_transactions", "transaction_date"),)),
    ("employees", (Old("employees", "deleted_at"),)),
)


@dataclass(frozen=True)
class Mark:
    """Rows that are old by ``ts``, with a key among ``inside``, and with none among ``outside``; what is None
    does not matter. Both key frames are settled and hold each key once."""
    step_no: int
    step: str
    ts: str | None = None
    inside: tuple[str, DataFrame] | None = None
    outside: tuple[str, DataFrame] | None = None


class _Run:
    """The base tables and what is marked on them so far."""

    def __init__(self, tables: Tables, cut: Column):
        self.tables, self.cut = tables, cut
        self.marks: dict[str, list[Mark]] = {}

    def old(self, ts: str) -> Column:
        return F.col(ts) < self.cut

    def flagged(self, table: str, columns: Sequence[str]) -> tuple[DataFrame, list[Column]]:
        """``columns`` of a table with the flags its marks need, and one condition per mark."""
        base, marks, hits = self.tables[table], self.marks.get(table, []), []
        needed = {m.ts for m in marks} | {k[0] for m in marks for k in (m.inside, m.outside) if k}
        df = base = base.select(*columns, *sorted(needed - {None} - set(columns)))
        for n, mark in enumerate(marks):
            hit = F.lit(True) if mark.ts is None else self.old(mark.ts)
            for flag, side, wanted in ((f"_in{n}", mark.inside, True), (f"_out{n}", mark.outside, False)):
                if side:
                    on, keys = side
                    df = lookup_join(df, keys.withColumn(flag, F.lit(True)), on, "left", columns, basis=base)
                    hit = hit & (F.col(flag).isNotNull() if wanted else F.col(flag).isNull())
            hits.append(F.coalesce(hit, F.lit(False)))
        return df, hits

    def living(self, table: str, *columns: str) -> DataFrame:
        """What no mark takes. Marks by time alone reach the scan as its filter."""
        timed = [m.ts for m in self.marks.get(table, []) if not (m.inside or m.outside)]
        rest = [m for m in self.marks.get(table, []) if m.inside or m.outside]
        young = self.tables[table]
        for ts in timed:
            young = young.filter((F.col(ts) >= self.cut) | F.col(ts).isNull())
        view = _Run({table: young}, self.cut)
        view.marks[table] = rest
        df, hits = view.flagged(table, columns)
        return df.filter(~reduce(Column.__or__, hits, F.lit(False))).select(*columns)

    def held(self, child: str, on: str, wanted: DataFrame) -> tuple[str, DataFrame]:
        """Keys among ``wanted`` that a remaining row of ``child`` points to.

        Child keys are made distinct ahead of the shuffle. ``wanted`` comes from a filtered scan, so that a
        large child is read through a Bloom filter of it (Spark's own runtime filter).
        """
        return on, settle(keyed_join(self.living(child, on).distinct(), wanted, on, "left_semi"), "held-keys")

    def mark(self, rule: Rule, number: int, step: str) -> None:
        marks = self.marks.setdefault(rule.table, [])
        self.tables[rule.table]            # a table that is not given fails its step here
        if isinstance(rule, Old):
            self.tables[rule.table].select(rule.ts)
            marks.append(Mark(number, step, rule.ts))
        elif isinstance(rule, Lonely):
            aged = self.living(rule.table, rule.on, rule.ts).filter(self.old(rule.ts)).select(rule.on)
            marks.append(Mark(number, step, rule.ts, outside=self.held(rule.child, rule.on, aged)))
        else:
            gone = self.living(rule.parent, rule.on, rule.parent_ts).filter(self.old(rule.parent_ts))
            doomed = settle(gone.select(rule.on).filter(F.col(rule.on).isNotNull()).distinct(), "doomed-keys")
            outside = None
            if rule.child:
                mine = lookup_join(self.living(rule.table, rule.on, rule.child_on), doomed, rule.on, "left_semi")
                outside = self.held(rule.child, rule.child_on, mine.select(rule.child_on))
            marks.append(Mark(number, step, None, (rule.on, doomed), outside))


class StepsFailed(RuntimeError):
    """Raised when a run over stored tables is at its end, if steps of it failed: ``failures`` says why,
    ``counts`` what the other steps deleted."""

    def __init__(self, failures: dict[str, str], counts: DataFrame):
        super().__init__("retention steps failed: " + "; ".join(f"{s}: {why}" for s, why in failures.items()))
        self.failures, self.counts = failures, counts


@dataclass(frozen=True)
class KeyRun:
    marked: Tables                 # all rows of each table that a step is about, with ``step_no`` (null: stays)
    tables: Tables                 # what is left; tables that no step is about are as given
    purged: Tables                 # what goes, with ``step_no``
    counts: DataFrame              # step_no, step, table_name, rows_deleted
    failures: dict[str, str]
    marks: dict[str, list[Mark]]   # of the tables in ``marked``


def run_retention_keys(tables: Tables, as_of, months: int = RETENTION_MONTHS,
                       steps: Sequence[tuple[str, tuple[Rule, ...]]] = KEY_STEPS) -> KeyRun:
    """All purges in order, with the outcome of ``retention.run_retention``.

    A row is counted with the first step that takes it. A row whose key is null has no children and follows no
    parent. A step that fails leaves no mark and the run goes on. Empty tables lose nothing. No table may
    have a column ``step_no``, nor one that starts with ``_in`` or ``_out`` and a number.
    """
    run, failures = _Run(dict(tables), cutoff(as_of, months)), {}
    for number, (name, rules) in enumerate(steps, 1):
        before = {t: list(m) for t, m in run.marks.items()}
        try:
            for rule in rules:
                run.mark(rule, number, name)
        except Exception as exc:
            run.marks = before
            failures[name] = f"{type(exc).__name__}: {exc}"
    marked, counts = {}, []
    for table, marks in run.marks.items():
        if not marks:
            continue
        columns = tables[table].columns
        df, hits = run.flagged(table, columns)
        number = F.coalesce(*[F.when(hit, mark.step_no) for hit, mark in zip(hits, marks)], F.lit(None).cast("int"))
        marked[table] = df.select(*columns, number.alias("step_no"))
        named = {m.step_no: m.step for m in marks}
        counts.append(marked[table].agg(*[F.count_if(F.col("step_no") == n).alias(f"n{n}") for n in named])
                      .select(F.inline(F.array(*[
                          F.struct(F.lit(n).alias("step_no"), F.lit(step).alias("step"),
                                   F.lit(table).alias("table_name"), F.col(f"n{n}").alias("rows_deleted"))
                          for n, step in named.items()]))))
    if not counts:
        raise ValueError(f"every retention step failed: {failures}")
    left = {n: marked[n].filter("step_no is null").drop("step_no") if n in marked else df for n, df in tables.items()}
    gone = {n: df.filter("step_no is not null") for n, df in marked.items()}
    return KeyRun(marked, left, gone, reduce(DataFrame.unionByName, counts), failures,
                  {n: run.marks[n] for n in marked})


def purge_stored(spark: SparkSession, paths: dict[str, str], as_of, months: int = RETENTION_MONTHS,
                 steps: Sequence[tuple[str, tuple[Rule, ...]]] = KEY_STEPS, archive_to: str | None = None) -> DataFrame:
    """The run over stored tables, each a Parquet folder; returns the counts of :func:`run_retention_keys`.

    Of a table laid out by ``month`` only the months that lose rows are written again, once: beside the table
    (:func:`staging`), and each folder then takes the place of its month. A month that loses all is
    dropped. Other tables are written again if they lose rows, staged in the shared folder first.
    All keys are settled before the first table changes, and rows that follow a parent go before the
    parent, so a run that died may be run again: it puts back a month that was on its way and finds what is left
    to do. ``archive_to`` first copies what goes, one folder per table; a run that is repeated replaces the months
    it still finds. A step that fails deletes nothing; the others are carried out, then :class:`StepsFailed` is raised.
    """
    for path in paths.values():
        _put_back(spark, path)
    run = run_retention_keys({n: spark.read.parquet(p) for n, p in paths.items()}, as_of, months, steps)
    # One pass per table finds what goes, by month where there are months: few rows each.
    hits = {n: _losses(df).collect() for n, df in run.marked.items()}
    found = [(m.step_no, m.step, n, sum(r["rows"] for r in hits[n] if r["step_no"] == m.step_no))
             for n, marks in run.marks.items() for m in marks]
    counts = spark.createDataFrame(list(dict.fromkeys(found)), run.counts.schema)
    for name in [n for n, rows in hits.items() if any(r["step_no"] is not None for r in rows)]:
        path, marked = paths[name], run.marked[name]
        if archive_to:
            cold = run.purged[name].write.mode("overwrite")
            if "month" in marked.columns:      # months that an earlier run has done keep their copy
                cold = cold.option("partitionOverwriteMode", "dynamic").partitionBy("month")
            cold.parquet(f"{archive_to}/{name}")
        if "month" not in marked.columns:
            kept = settle(run.tables[name], f"{name}-kept")
            kept.write.mode("overwrite").parquet(path)
            continue
        stay = {r["month"] for r in hits[name] if r["step_no"] is None}
        lose = {r["month"] for r in hits[name] if r["step_no"] is not None}
        if lose & stay:
            kept = run.tables[name].filter(reduce(Column.__or__, [F.col("month").eqNullSafe(m) for m in lose & stay]))
            kept.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(staging(path))
            for folder in folders(spark, staging(path)):
                if folder.startswith("month="):
                    replace_folder(spark, f"{staging(path)}/{folder}", f"{path}/{folder}")
            remove(spark, staging(path))
        for month in lose - stay:
            remove(spark, f"{path}/month={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")
    if run.failures:
        raise StepsFailed(run.failures, counts)
    return counts


def staging(path: str) -> str:
    """The folder beside a table where its new months are written."""
    return path.rstrip("/") + "_purge_pending"


def _losses(marked: DataFrame) -> DataFrame:
    """Rows by step (null: they stay) and, where the table has months, by month."""
    return marked.groupBy("step_no", *[c for c in ("month",) if c in marked.columns]).agg(
        F.count(F.lit(1)).alias("rows"))


def _put_back(spark: SparkSession, path: str) -> None:
    """A run that died between the removal of a month and the move of its new folder left the month in the
    staging folder only. Months that are in the table still are as they were, or done."""
    for folder in folders(spark, staging(path)):
        if folder.startswith("month=") and folder not in folders(spark, path):
            replace_folder(spark, f"{staging(path)}/{folder}", f"{path}/{folder}")
    remove(spark, staging(path))
