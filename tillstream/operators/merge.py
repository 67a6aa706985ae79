"""MERGE of a batch of changes into a current-state table, as one declarative plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import is_small, lookup_join, planned_bytes, reads_little
from tillstream.operators.latest import latest_per_key
from tillstream.session import empty_frame
from tillstream.specs import TableSpec


# A target below this size is simply joined; a larger one is not moved for a small batch.
MOVE_LIMIT = 256 * 1024 * 1024


@dataclass(frozen=True)
class MergeResult:
    """``plan`` holds the key, the old row, the new row and the action for every key."""
    plan: DataFrame
    spec: TableSpec
    columns: list[str]

    @property
    def df(self) -> DataFrame:
        """The table after the merge."""
        kept = self.plan.filter("_action <> 'delete'")
        return kept.select(*[F.col(c if c in self.spec.key else f"new.`{c}`") for c in self.columns])

    @property
    def actions(self) -> DataFrame:
        return self.plan.selectExpr(*self.spec.key, "_action as action")

    def metrics(self) -> DataFrame:
        """One row: how many target rows were inserted, updated and deleted."""
        return self.plan.selectExpr("count_if(_action = 'insert') as rows_inserted",
                                    "count_if(_action = 'update') as rows_updated",
                                    "count_if(_action = 'delete') as rows_deleted")

    def changes(self) -> DataFrame:
        """Change feed of this merge, without a second comparison of old and new."""
        return feed_rows(self.plan.filter(F.col("_action") != "keep"), self.columns)


def feed_rows(changed: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (``_change_type`` + columns) from a frame of ``old``, ``new`` and ``_action``."""
    def image(kind: str, side: str) -> str:
        values = ", ".join(f"'{c}', {side}.`{c}`" for c in columns)
        return f"named_struct('_change_type', '{kind}', {values})"
    return changed.selectExpr(f"""inline(case _action
        when 'insert' then array({image("insert", "new")})
        when 'delete' then array({image("delete", "old")})
        else array({image("update_preimage", "old")}, {image("update_postimage", "new")}) end)""")


def _paired(target: DataFrame, source: DataFrame, key: list[str], way: str) -> DataFrame:
    """Every key once, with its ``t`` and ``s`` structs.

    ``way="broadcast"`` joins a small batch to the target without moving the target; unmatched
    rows are found by a second, key-only pass. ``"shuffle"`` is one full outer join. ``"auto"``
    broadcasts to a large target, and joins otherwise. A batch that is not small is never
    broadcast, whatever ``way`` says: it would pass the driver whole. Both ways give the same
    rows, and both sides hold each key once, so no key can be hot.
    """
    if way == "auto":
        way = "shuffle" if reads_little(target, MOVE_LIMIT) else "broadcast"
    if way == "broadcast" and not is_small(source):
        way = "shuffle"
    t = target.select(*key, F.struct(*target.columns).alias("t"))
    s = source.select(*key, F.struct(*source.columns).alias("s"))
    if planned_bytes(target) == 0:       # no rows: the batch stays as it is partitioned
        return s.select(*key, F.lit(None).cast(t.schema["t"].dataType).alias("t"), "s")
    if way == "shuffle":
        return _varying(t, key).join(s, key, "full_outer")
    known = target.select(*key).join(F.broadcast(source.select(*key)), key, "left_semi")
    fresh = s.join(known, key, "left_anti")
    return (t.join(F.broadcast(s), key, "left")
            .unionByName(fresh.select(*key, F.lit(None).cast(t.schema["t"].dataType).alias("t"),
                                      "s")))


def _varying(t: DataFrame, key: list[str]) -> DataFrame:
    """``t`` with the columns of its key after the first behind a one-element ``inline``, as in ``decode``.

    A tag may be the same in all rows. Where the batch bears another one, the planner would compare the two itself,
    find that nothing matches, and pair every row with every row to tell so. Order and partitions by the first
    column, which has to vary, are kept.
    """
    if len(key) == 1:
        return t
    rest = [c for c in t.columns if c not in key]
    return t.select(key[0], *rest, F.inline(F.array(F.struct(*key[1:])))).select(*key, *rest)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    now,
    guard: bool = True,
    on_delete: str = "ignore",
    way: str = "auto",
) -> MergeResult:
    """Insert new keys, update keys whose hash differs, keep the rest.

    ``source`` may hold several versions of a key; the newest one counts. ``guard`` keeps a
    stored row that is newer than the incoming one. Deletes are applied only with
    ``on_delete="delete"`` and rows of type ``d``.
    """
    key = list(spec.key)
    columns = spec.silver_schema().names
    given = set(source.columns)
    gone = "transaction_type <=> 'd'" if "transaction_type" in given else "false"
    newest = latest_per_key(source, key, spec.order_col)
    if on_delete != "delete":
        newest = newest.filter(f"not ({gone})")
    newest = newest.selectExpr(*[f"`{c}`" for c in columns if c in given], f"{gone} as _gone")
    pairs = _paired(target.select(*columns), newest, key, way)

    differs = "not (t.hash <=> s.hash)"
    # The guard compares source times, so it is off where the merge itself stamps the column.
    if guard and dict(spec.on_update).get(spec.order_col) != "now":
        # A row without a time does not beat one that has it.
        differs += (f" and coalesce(s.{spec.order_col} >= t.{spec.order_col}, "
                    f"t.{spec.order_col} is null)")
    action = f"""case when s is null then 'keep'
        when t is null and s._gone then 'skip' when t is null then 'insert'
        when s._gone then 'delete' when {differs} then 'update' else 'keep' end"""

    types = {f.name: f.dataType.simpleString() for f in spec.silver_schema().fields}
    on_insert, on_update = dict(spec.on_insert), dict(spec.on_update)

    def value(c: str) -> str:
        def side(rule: dict[str, str]) -> str:
            if rule.get(c) == "now":
                return "_now"
            return f"s.`{c}`" if c in given else f"cast(null as {types[c]})"
        return (f"'{c}', case _action when 'insert' then {side(on_insert)} "
                f"when 'update' then {side(on_update)} else t.`{c}` end")

    plan = (pairs.select(*key, "t", "s", F.expr(action).alias("_action"),
                         F.lit(now).cast("timestamp").alias("_now"))
            .filter("_action <> 'skip'")
            .selectExpr(*key, "t as old", f"named_struct({', '.join(map(value, columns))}) as new",
                        "_action"))
    return MergeResult(plan, spec, columns)


def empty_silver(spark, spec: TableSpec) -> DataFrame:
    return empty_frame(spark, spec.silver_schema())


def stale_rows(source: DataFrame, target: DataFrame, spec: TableSpec) -> DataFrame:
    """Incoming rows older than the row already stored under their key."""
    key, order = list(spec.key), spec.order_col
    stored = target.select(*key, F.col(order).alias("stored_at"))
    return lookup_join(source, stored, key).filter(F.col(order) < F.col("stored_at"))
