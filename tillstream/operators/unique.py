"""Several unique keys at once, against a table and among the requests of a batch.

Each request claims one value per key. All claims, whatever their key, go through one exchange as (key,
token of the value, request). The outcome is that of inserting the requests one after the other in
their order: a request that is refused takes none of its values, so a later one may have them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.pii import open_text
from tillstream.operators.joins import TASK_ROWS, lookup_join
from tillstream.session import settle


@dataclass(frozen=True)
class UniqueKey:
    """Columns that no two rows may share; a null in one of them makes a row share nothing."""
    columns: tuple[str, ...]
    ignore_case: bool = False

    @property
    def name(self) -> str:
        return ", ".join(self.columns)


def _parts(key: UniqueKey, values: dict[str, Column]) -> tuple[list[Column], Column]:
    """The texts that a key compares, and whether all are given."""
    parts = [values.get(c, F.col(f"`{c}`")).cast("string") for c in key.columns]
    if key.ignore_case:
        parts = [F.lower(p) for p in parts]
    given = F.lit(True)
    for p in parts:
        given = given & p.isNotNull()
    return parts, given


def _claims(df: DataFrame, keys: Sequence[UniqueKey], keep: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """(``keep``, _key, _value): a row per key whose columns are all given. Values are compared as
    digests, so that what is personal stays hidden and narrow in the shuffle."""
    def token(key: UniqueKey) -> Column:
        parts, given = _parts(key, values)
        text = F.to_json(F.struct(*[p.alias(f"c{k}") for k, p in enumerate(parts)]))
        return F.when(given, F.unhex(F.sha2(text, 256)))

    claims = F.array(*[F.struct(F.lit(k).alias("_key"), token(key).alias("_value")) for k, key in enumerate(keys)])
    return df.select(*keep, F.inline(claims)).filter("_value is not null")


CELLS = 1 << 16


def _hot_values(requests: DataFrame, claims: DataFrame, keys: Sequence[UniqueKey]) -> DataFrame | None:
    """Values that more requests claim than one task should hold; None if there are none.

    Counted are cells of the values' hash, a bounded number; then the values in cells that hold so many.
    """
    def cell(key: UniqueKey) -> Column:
        parts, given = _parts(key, {})
        return F.when(given, F.pmod(F.xxhash64(*parts), F.lit(CELLS)))

    cells = F.array(*[F.struct(F.lit(k).alias("_key"), cell(key).alias("_cell")) for k, key in enumerate(keys)])
    counts = requests.select(F.inline(cells)).filter("_cell is not null").groupBy("_key", "_cell").count()
    if counts.filter(F.col("count") > TASK_ROWS).isEmpty():
        return None
    return settle(claims.groupBy("_key", "_value").count().filter(F.col("count") > TASK_ROWS).drop("count"), "hot")


def _contested(claims: DataFrame, stored: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Claims whose value is stored (``_taken``) or has other claims, with the ``_first`` of them.

    Stored values and claims meet in one exchange. Claims of a hot value stay where they are: its first one
    is found map-side and sent to them. A value nobody else wants goes no further.
    """
    both = ["_key", "_value"]
    stored = stored.withColumn("_taken", F.lit(True))
    cold = claims if hot is None else claims.join(F.broadcast(hot), both, "left_anti")
    w = Window.partitionBy(*both)
    judged = (cold.join(stored, both, "left")
              .select("_order", *both, "_taken", F.min("_order").over(w).alias("_first"),
                      F.count(F.lit(1)).over(w).alias("_n")))
    if hot is not None:
        firsts = (claims.join(F.broadcast(hot), both, "left_semi").groupBy(*both)
                  .agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n")))
        firsts = settle(firsts.join(stored.join(F.broadcast(hot), both, "left_semi"), both, "left"), "hot-first")
        judged = judged.unionByName(claims.join(F.broadcast(firsts), both).select(judged.columns))
    taken = F.coalesce("_taken", F.lit(False))
    return judged.filter(taken | (F.col("_n") > 1)).select(
        "_key", F.when(~taken, F.col("_value")).alias("_value"), "_order",
        F.when(~taken, F.col("_first")).alias("_first"), taken.alias("_taken"))


def _late(claims: DataFrame, without: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(_row, _late): requests that want a value an accepted request before them has, and the first key of those."""
    both, row = ["_key", "_value"], F.col("_order._row")
    free = left = settle(claims, "free")
    accepted = None
    # Each round accepts what is first for all its values, and drops what wants one of those: most rows in
    # the first round; then as many rounds as chains of such wants are long.
    while not left.isEmpty():
        first = left.groupBy(*both).agg(F.min("_order").alias("_first"))
        mine = settle(lookup_join(left, first, both, "inner", ["_order"]), "round")
        leads = F.col("_first") == F.col("_order")
        winners = settle(mine.groupBy(row.alias("_row")).agg(F.min(leads).alias("_all")).filter("_all")
                         .select("_row"), "winners")
        losers = (mine.filter(~leads).join(winners, F.col("_first._row") == F.col("_row"), "left_semi")
                  .select(row.alias("_row")).distinct())
        accepted = winners if accepted is None else accepted.unionByName(winners)
        left = settle(without(without(left, winners), losers), "left")
    if accepted is None:
        return free.select(row.alias("_row"), F.col("_key").alias("_late"))
    kept = free.join(accepted.select(F.col("_row").alias("_won")), row == F.col("_won"), "left_semi")
    return (lookup_join(without(free, accepted), kept.select(*both, F.col("_order").alias("_by")), both, "inner",
                        ["_order"])
            .filter(F.col("_by") < F.col("_order"))      # a value that was taken only later refused nobody
            .groupBy(row.alias("_row")).agg(F.min("_key").alias("_late")))


def refuse_repeats(requests: DataFrame, table: DataFrame, keys: Sequence[UniqueKey], order_by: Sequence[str],
                   secret: str | None = None, hidden: Sequence[str] = (), repeated: str = "requested more than once",
                   reason: str = "reason") -> DataFrame:
    """``requests`` with ``reason`` filled for those that would break a key; others keep theirs.

    Requests that have a reason already claim nothing. Rows of ``table`` win over requests, requests
    that come first along ``order_by`` over later ones. Only claims to a value that is stored or has other
    claims are looked at again. ``hidden`` columns of ``table`` are encrypted by
    ``secret``; a value that it does not open is compared as it is.
    """
    columns = requests.columns
    numbered = settle(requests.withColumn("_row", F.monotonically_increasing_id()), "requests")
    order = F.struct(*[F.col(f"`{c}`") for c in order_by], "_row").alias("_order")
    asked = numbered.filter(F.col(reason).isNull())
    claims = _claims(asked.withColumn("_order", order), keys, ["_order"], {})
    stored = _claims(table, keys, [], {c: open_text(F.col(c), secret) for c in hidden}).distinct()
    row = F.col("_order._row")
    contested = settle(_contested(claims, stored, _hot_values(asked, claims, keys)), "contested")

    def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
        return rows.join(gone.select(F.col("_row").alias("_gone")), row == F.col("_gone"), "left_anti")

    if len(keys) == 1:                 # the first one has the value, and no other claim can fail it
        verdict = contested.filter(F.col("_taken") | (F.col("_order") > F.col("_first"))).select(
            row.alias("_row"), F.when(F.col("_taken"), F.col("_key")).alias("_taken"),
            F.when(~F.col("_taken"), F.col("_key")).alias("_late"))
    else:
        refused = settle(contested.filter("_taken").groupBy(row.alias("_row")).agg(F.min("_key").alias("_taken")), "taken")
        late = _late(without(contested.filter(~F.col("_taken")).select("_order", "_key", "_value"), refused), without)
        nothing = F.lit(None).cast("int")
        verdict = settle(refused.withColumn("_late", nothing).unionByName(late.withColumn("_taken", nothing)), "refused")
    out = numbered.join(verdict, "_row", "left")
    names = F.array(*[F.lit(k.name) for k in keys])
    why = F.when(F.col("_taken").isNotNull(), F.concat(names[F.col("_taken")], F.lit(" already exists"))).when(
        F.col("_late").isNotNull(), F.concat(names[F.col("_late")], F.lit(f": {repeated}")))
    return out.withColumn(reason, F.coalesce(F.col(reason), why)).select(*columns)
