"""Data-quality rules, evaluated for a whole table in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import children_of
from tillstream.specs import TableSpec

# The forms that the checked tables demand.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^[0-9]{8,15}$"


@dataclass(frozen=True)
class Rule:
    """``holds`` is an SQL condition: true, or null where the rule does not apply to the row."""
    name: str
    holds: str

    @property
    def broken(self) -> str:
        return f"coalesce(not ({self.holds}), false)"


def _text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(*cols: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", f"{c} is not null") for c in cols]


def positive(*cols: str) -> list[Rule]:
    return [Rule(f"chk_{c}_positive", f"{c} > 0") for c in cols]


def non_negative(*cols: str) -> list[Rule]:
    return [Rule(f"chk_{c}_non_negative", f"{c} >= 0") for c in cols]


def non_empty(*cols: str) -> list[Rule]:
    return [Rule(f"chk_{c}_length", f"length({c}) > 0") for c in cols]


def not_blank(*cols: str) -> list[Rule]:
    """Present and more than blanks."""
    return [Rule(f"chk_{c}_not_blank", f"length(trim(coalesce({c}, ''))) > 0") for c in cols]


def not_future(now, *cols: str) -> list[Rule]:
    return [Rule(f"chk_{c}", f"{c} <= timestamp '{now}'") for c in cols]


def after(later: str, earlier: str) -> Rule:
    return Rule(f"chk_{later}_after_{earlier}", f"{later} > {earlier}")


def one_of(col: str, values: Iterable) -> Rule:
    listed = ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)
    return Rule(f"chk_{col}_allowed", f"{col} in ({listed})")


def matches(col: str, pattern: str, name: str | None = None) -> Rule:
    return Rule(name or f"chk_{col}_format", f"{col} rlike {_text(pattern)}")


def max_length(col: str, n: int) -> Rule:
    return Rule(f"chk_{col}_max_length", f"length({col}) <= {n}")


def table_rules(spec: TableSpec, now, columns: Sequence[str] | None = None,
                allowed_values: bool = True, layer: str = "silver") -> list[Rule]:
    """The rules of an entity in a layer (bronze or silver), for the columns at hand (all of the
    layer, lineage included), without the dropped ones."""
    whole = spec.bronze_schema() if layer == "bronze" else spec.silver_schema()
    have = set(columns if columns is not None else whole.names)

    def at_hand(cols: Iterable[str]) -> list[str]:
        return [c for c in cols if c in have]

    rules = [
        *not_null(*at_hand([*spec.not_null, *(c for at, c in spec.layer_not_null if at == layer)])),
        *non_empty(*at_hand(spec.non_empty)),
        *positive(*at_hand(spec.positive)),
        *non_negative(*at_hand(spec.non_negative)),
        *not_future(now, *at_hand(spec.not_future)),
        *[after(a, b) for a, b in spec.after if a in have and b in have],
    ]
    if allowed_values:
        rules += [one_of(c, v) for c, v in spec.allowed if c in have]
    return [r for r in rules if r.name not in spec.dropped_rules]


@dataclass(frozen=True)
class Checked:
    flagged: DataFrame      # input columns + ``violations`` array

    @property
    def valid(self) -> DataFrame:
        return self.flagged.filter(F.size("violations") == 0).drop("violations")

    @property
    def rejected(self) -> DataFrame:
        return self.flagged.filter(F.size("violations") > 0)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> Checked:
    """Flag every row with the names of the rules it breaks."""
    flags = ", ".join(f"case when {r.broken} then '{r.name}' end" for r in rules)
    return Checked(df.withColumn("violations", F.expr(
        f"array_compact(array({flags or 'cast(null as string)'}))")))


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Broken rows per rule: one aggregation over the table, then one row per rule."""
    wide = df.selectExpr(*[f"count_if({r.broken}) as `{r.name}`" for r in rules])
    pairs = ", ".join(f"named_struct('rule', '{r.name}', 'violations', `{r.name}`)"
                      for r in rules)
    return wide.selectExpr(f"inline(array({pairs}))")


def duplicates(df: DataFrame, key) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    key = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def conflicts(new: DataFrame, existing: DataFrame, on) -> DataFrame:
    """How many existing rows each key of ``new`` collides with."""
    on = [on] if isinstance(on, str) else list(on)
    counts = existing.groupBy(*on).agg(F.count(F.lit(1)).alias("existing_rows"))
    return new.select(*on).distinct().join(counts, on, "inner")


def duplicate_names(df: DataFrame, new: DataFrame, name: str = "name",
                    deleted: str = "deleted_at", ignore_case: bool = True) -> DataFrame:
    """Rows of ``new`` whose name is taken by an active row of ``df``."""
    def norm(c: Column) -> Column:
        return F.lower(c) if ignore_case else c
    taken = df.filter(F.col(deleted).isNull()).select(norm(F.col(name)).alias("_name"))
    tagged = new.withColumn("_name", norm(F.col(name)))
    return children_of(tagged, taken, "_name").drop("_name")
