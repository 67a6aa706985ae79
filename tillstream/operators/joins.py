"""Joins that stay balanced when one key holds a large part of the rows.

The rule for every equi-join of a large table with a table that is unique on the join key:
broadcast the unique side only if the optimizer's own size estimate is below a limit; else
salt the hot keys, so that no single task receives a whole hot group. A large table of less
than ``SALT_FLOOR`` bytes needs neither: one task can hold all of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 10 * 1024 * 1024
SALT_FLOOR = 512 * 1024 * 1024
TASK_ROWS = 1_000_000        # rows that one task should hold: a key with more is hot
HOT_KEYS = 1 << 18           # never more hot keys than this; a larger task instead
NULL_PIECES = 4096           # null keys match nothing, but must be spread as well


def planned_bytes(df: DataFrame) -> int | None:
    """Size the optimizer expects, or None where the session cannot tell."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = planned_bytes(df)
    return size is not None and size <= limit


def input_bytes(df: DataFrame) -> int | None:
    """Size of all tables ``df`` reads.

    A guide to cost, not a bound: unlike :func:`planned_bytes` it does not grow with every
    join, which suits frames joined on unique keys.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes()))
                   for i in range(leaves.size()))
    except AttributeError:
        return None


def reads_little(df: DataFrame, limit: int) -> bool:
    size = input_bytes(df)
    return size is not None and size <= limit


def hot_keys(df: DataFrame, on: Sequence[str], share: float | None = None) -> DataFrame:
    """Keys holding more rows than one task should, or more than ``share`` of all rows, with
    ``_pieces``: the tasks that their rows fill.

    What is too much for a task does not depend on the size of the table. Reads the key columns
    only and counts map-side before it shuffles.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    most = total * F.lit(share) if share else F.greatest(F.lit(TASK_ROWS), total / HOT_KEYS)
    return counts.filter(F.col("_rows") > most).select(
        *on, F.ceil(F.col("_rows") / most).cast("int").alias("_pieces"))


_HALF = ("left_semi", "left_anti")


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join by name. A semi or anti join keeps the columns of ``left`` as they stand."""
    joined = left.join(right, list(on), how)
    return joined.select(*left.columns) if how in _HALF else joined


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    share: float | None = None,
    salts: int | None = None,
    basis: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` with ``right``, splitting each hot key of ``left`` into as many pieces as its
    rows fill tasks, or into ``salts``.

    Hot keys are found in ``basis``, by default ``left`` itself. Where ``left`` is a join
    result, name its largest base table: that costs one scan of the key columns.

    Rows of a hot key are spread by the hash of ``spread``; the matching right rows are copied
    once per piece. Inner, left, semi and anti joins keep their exact result. Null keys, which
    never match, are spread as well.
    """
    on = list(on)
    hot = hot_keys(left if basis is None else basis, on, share)
    # At most HOT_KEYS rows.
    hot = F.broadcast(hot if salts is None else hot.withColumn("_pieces", F.lit(salts)))
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(c).isNull()
    pieces = F.coalesce("_pieces", F.when(null_key, NULL_PIECES).otherwise(1))
    salted = (left.join(hot, on, "left")
              .withColumn("_salt", F.pmod(F.xxhash64(*spread), pieces).cast("int")).drop("_pieces"))
    copied = (right.join(hot, on, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
              .drop("_pieces"))
    joined = salted.join(copied, [*on, "_salt"], how).drop("_salt")
    return joined.select(*left.columns) if how in _HALF else joined


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    limit: int = BROADCAST_BYTES,
    basis: DataFrame | None = None,
) -> DataFrame:
    """Join a large ``left`` with a ``right`` that is unique on ``on``.

    ``spread`` names left columns that differ between rows of one key; without it all columns
    of ``left`` are used. ``basis`` is the base table ``left`` was made of, if that is a join:
    its size and its keys stand for those of ``left``.
    """
    on = [on] if isinstance(on, str) else list(on)
    if is_small(right, limit):
        return _join(left, F.broadcast(right), on, how)
    if reads_little(left if basis is None else basis, SALT_FLOOR):
        return _join(left, right, on, how)
    return salted_join(left, right, on, how, spread or left.columns, basis=basis)


def keyed_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join of two sides that are both unique on ``on``: no key can be hot."""
    on = [on] if isinstance(on, str) else list(on)
    return _join(left, F.broadcast(right) if is_small(right, limit) else right, on, how)


def gather(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows with all of a key on one task, in as many partitions as a shuffle has: what goes on by the key
    needs no other exchange.

    Packed rows grow many times when they are read, so partitions are not put together by their packed size.
    """
    on = [on] if isinstance(on, str) else list(on)
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on)


def children_of(child: DataFrame, parents: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose key is among ``parents``."""
    on = [on] if isinstance(on, str) else list(on)
    return lookup_join(child, parents.select(*on).distinct(), on, "left_semi")


def not_children_of(child: DataFrame, parents: DataFrame, on: str | Sequence[str]) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    return lookup_join(child, parents.select(*on).distinct(), on, "left_anti")


def without_children(parent: DataFrame, child: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Parents no child row points to.

    The child keys are made distinct first: that collapses a hot key map-side, and the join
    then reuses the same partitioning.
    """
    on = [on] if isinstance(on, str) else list(on)
    return _join(parent, child.select(*on).distinct(), on, "left_anti")


def with_children(parent: DataFrame, child: DataFrame, on: str | Sequence[str]) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    return _join(parent, child.select(*on).distinct(), on, "left_semi")


def parent_flag(child: DataFrame, parents: DataFrame, on: str, flag: str) -> DataFrame:
    """All rows of ``child``; ``flag`` is true where the key is among ``parents``, else null."""
    return lookup_join(child, parents.select(on).distinct().withColumn(flag, F.lit(True)), on, "left").select(
        *child.columns, flag)


def child_flag(parent: DataFrame, child: DataFrame, on: str, flag: str) -> DataFrame:
    """All rows of ``parent``; ``flag`` is true where a child row points to it, else null."""
    return _join(parent, child.select(on).distinct().withColumn(flag, F.lit(True)), [on], "left").select(
        *parent.columns, flag)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    on: str | Sequence[str],
    parent_on: str | Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose (non-null) reference has no parent."""
    on = [on] if isinstance(on, str) else list(on)
    parent_on = on if parent_on is None else (
        [parent_on] if isinstance(parent_on, str) else list(parent_on))
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_on, on)]).distinct()
    present = child
    for c in on:
        present = present.filter(F.col(c).isNotNull())
    return lookup_join(present, keys, on, "left_anti")


def join_values(df: DataFrame, rows: Sequence[tuple], schema, on, limit: int = BROADCAST_BYTES):
    """Inner join with literal rows given by the caller; broadcast if they are few enough."""
    values = df.sparkSession.createDataFrame(list(rows), schema)
    return df.join(F.broadcast(values) if is_small(values, limit) else values, on, "inner")


def fill_from_parent(df: DataFrame, parent: DataFrame, on: str, columns: dict[str, str],
                     spread: Sequence[str] | None = None) -> DataFrame:
    """Fill null columns of ``df`` from its parent: ``{column: parent column}``."""
    slim = parent.select(on, *[F.col(p).alias(f"_parent_{c}") for c, p in columns.items()])
    joined = lookup_join(df, slim, on, "left", spread)
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_parent_{c}")).alias(c) if c in columns else F.col(c)
        for c in df.columns])


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))
