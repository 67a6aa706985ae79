"""Change logs of the mapped entities: as messages for Spark, as SQL for the comparison.

Every row is sent once as a snapshot. A changed row then follows as an update (delivered
twice), a delete and a tombstone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.catalog.mapping import BINARY, MAPPED, entity, entity_sql, hash_sql
from tillstream.functions.scalars import encode_decimal
from tillstream.sources.tables import spread
from tillstream.specs import SPECS, TableSpec

SNAPSHOT_AT = "2024-01-01 00:00:00.250"
UPDATE_AT = "2024-01-10 12:30:00.500"
CONNECTOR = "postgresql"


def server(spec: TableSpec) -> str:
    return f"{spec.system}_server"


def wire_table(spec: TableSpec) -> str:
    return "audit_log" if spec.name.startswith("audit_log") else spec.name


def lineage_values(spec: TableSpec) -> tuple[str, str]:
    """The ``connector`` and ``source`` every message of the entity decodes to."""
    return (f"{CONNECTOR}_{server(spec)}",
            f"{spec.system}_db.public.{wire_table(spec)}")


def _wire(name: str, spec: TableSpec) -> Column:
    kind, col = spec.type_of(name), F.col(name)
    if isinstance(kind, T.DecimalType):
        return encode_decimal(col, kind.scale)
    if name in spec.micros:
        return F.unix_micros(col).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.concat(F.translate(col.cast("string"), " ", "T"), F.lit("Z"))
    return col


def second_version(spec: TableSpec) -> dict[str, str]:
    """What an update changes, as SQL expressions both engines read."""
    if spec.order_col in spec.columns:
        return {spec.order_col: f"{spec.order_col} + interval 1 day"}
    return {"query": "concat(query, ' (again)')"}


def messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The change log of an entity, one JSON text per message, in column ``value``."""
    spec = SPECS[name]
    rows = spread(entity(spark, sf_dir, name, even=True)).withColumn("_changed", F.expr(MAPPED[name].changed))
    kinds = F.when(F.col("_changed"), F.array(*[F.lit(k) for k in ("r", "u", "u", "d", "t")]))
    rows = rows.withColumn("_kind", F.explode(kinds.otherwise(F.array(F.lit("r")))))
    for col, expr in second_version(spec).items():
        rows = rows.withColumn(col, F.when(F.col("_kind") == "u", F.expr(expr))
                               .otherwise(F.col(col)))
    at = (F.when(F.col("_kind") == "r", F.lit(SNAPSHOT_AT).cast("timestamp"))
          .otherwise(F.lit(UPDATE_AT).cast("timestamp")))
    gone = F.col("_kind") == "d"
    payload = F.struct(
        F.col("_kind").alias("op"),
        F.when(gone, F.struct(*[_wire(k, spec).alias(k) for k in spec.key])).alias("before"),
        F.when(~gone, F.struct(*[_wire(c, spec).alias(c) for c in spec.columns])).alias("after"),
        F.struct(F.lit(CONNECTOR).alias("connector"), F.lit(server(spec)).alias("name"),
                 F.lit(f"{spec.system}_db").alias("db"), F.lit("public").alias("schema"),
                 F.lit(wire_table(spec)).alias("table")).alias("source"),
        F.unix_millis(at).cast("string").alias("ts_ms"))
    body = F.to_json(F.struct(payload.alias("payload")))
    return rows.select(F.when(F.col("_kind") != "t", body).alias("value"))


def log_sql(name: str) -> str:
    """CTE text: ``log`` holds every kept message with its hash and ingestion time."""
    spec = SPECS[name]
    change = second_version(spec)
    updated = ", ".join(f"{change.get(c, c)} as {c}" for c in spec.columns)
    plain = ", ".join(spec.columns)
    connector, source = lineage_values(spec)
    return f"""with e as {entity_sql(name)},
        v as (select {plain}, timestamp '{SNAPSHOT_AT}' as ingestion_time,
                     'r' as transaction_type from e
              union all
              select {updated}, timestamp '{UPDATE_AT}', 'u' from e
              where {MAPPED[name].changed}),
        log as (select *, '{connector}' as connector, '{source}' as source,
                       {hash_sql(name)} as hash from v)"""


def shown(df: DataFrame, name: str) -> DataFrame:
    """Binary columns as hex, so that results compare as plain types."""
    return df.select(*[F.hex(c).alias(c) if c in BINARY.get(name, ()) else F.col(c)
                       for c in df.columns])


def shown_sql(name: str, columns: list[str]) -> str:
    return ", ".join(f"hex({c}) as {c}" if c in BINARY.get(name, ()) else c for c in columns)
