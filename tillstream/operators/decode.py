"""Change messages to typed bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.scalars import decode_decimal, event_time, row_hash
from tillstream.specs import TableSpec

KEPT_OPS = ("r", "c", "u")       # snapshot, create, update
# Fixed value: the connector name of file loads.
BATCH_CONNECTOR = "airflow_batch_load"


def decode_envelope(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Parse ``value`` (bytes or text) into the struct column ``payload``; bad JSON gives nulls.

    The one-element ``inline`` is a barrier: as a plain projection the parse would be copied
    into every filter on its fields, and each message would be parsed twice.
    """
    value = F.col("value").cast("string")
    parsed = F.from_json(value, spec.envelope_schema())
    return df.select(value.alias("value"), F.inline(F.array(parsed)))


def keep_ops(df: DataFrame, ops: Sequence[str] = KEPT_OPS) -> DataFrame:
    return df.filter(F.col("payload.op").isin(*ops))


def _type_once(parsed: DataFrame, spec: TableSpec, truncate: str | None) -> DataFrame:
    """``parsed`` with each business column and ``ingestion_time`` typed once, behind a barrier as
    above: what tells good from bad and what goes on is one and the same value."""
    fields = [_typed(f"payload.after.`{n}`", n, spec).alias(n) for n in spec.columns]
    at = event_time(F.col("payload.ts_ms"), truncate).alias("ingestion_time")
    return parsed.select(*parsed.columns, F.inline(F.array(F.struct(*fields, at))))


def unreadable(spec: TableSpec) -> Column:
    """Names of the amounts and times that were sent, but cannot be read as such."""
    bad = [F.when(F.col(f"payload.after.`{n}`").isNotNull() & F.col(f"`{n}`").isNull(), n)
           for n in spec.columns if spec.wire_type(n) != spec.type_of(n)]
    bad.append(F.when(F.col("payload.ts_ms").isNotNull() & F.col("ingestion_time").isNull(), "ts_ms"))
    return F.array_compact(F.array(*bad))


def _reason(fields: Column) -> Column:
    return F.when(F.size(fields) > 0, F.concat(F.lit("unreadable: "), F.array_join(fields, ", ")))


def _malformed() -> Column:
    """A message that says something, but names no operation. Tombstones say nothing."""
    said = F.col("value").isNotNull() & (F.length(F.trim("value")) > 0)
    return said & F.col("payload.op").isNull()


def judge_cdc(df: DataFrame, spec: TableSpec, ops: Sequence[str] = KEPT_OPS,
              truncate: str | None = None) -> DataFrame:
    """Messages of the operations ``ops`` as bronze rows, and malformed ones, from a single parse.

    Besides the bronze columns: ``value``, the message, and ``reason``, null for good rows.
    """
    parsed = decode_envelope(df, spec).filter(F.col("payload.op").isin(*ops) | _malformed())
    typed = _type_once(parsed, spec, truncate)
    reason = F.when(F.col("payload.op").isNull(), "malformed message").otherwise(_reason(unreadable(spec)))
    rows = with_lineage_cdc(typed.withColumn("reason", reason))
    return rows.withColumn("hash", row_hash(rows, spec.columns))


def rejects(df: DataFrame, spec: TableSpec, ops: Sequence[str] = KEPT_OPS) -> DataFrame:
    """Messages that ``decode_cdc`` leaves out though they say something, with the reason: no
    readable operation, or fields that cannot be read. Tombstones are not rejects."""
    return judge_cdc(df, spec, ops).filter("reason is not null").select("value", "reason")


def _typed(field: str, name: str, spec: TableSpec) -> Column:
    kind = spec.type_of(name)
    if isinstance(kind, T.DecimalType):
        return decode_decimal(F.col(field), kind.precision, kind.scale)
    if name in spec.micros:
        return F.expr(f"timestamp_micros(try_cast({field} as bigint))")
    if isinstance(kind, T.TimestampType):
        return F.expr(f"try_cast({field} as timestamp)")
    if name in spec.key:
        return F.expr(f"coalesce({field}, payload.before.`{name}`)")
    return F.col(field)


def with_lineage_cdc(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("payload", "ingestion_time")]
    return df.select(
        *rest, "ingestion_time", F.col("payload.op").alias("transaction_type"),
        F.expr("concat_ws('_', payload.source.connector, payload.source.name)")
        .alias("connector"),
        F.expr("concat_ws('.', payload.source.db, payload.source.schema, payload.source.table)")
        .alias("source"))


def decode_cdc(
    df: DataFrame,
    spec: TableSpec,
    on_delete: str = "drop",
    truncate: str | None = None,
    hash_mode: str = "typed",
) -> DataFrame:
    """Messages to bronze rows: parse, filter, type, lineage, hash.

    ``on_delete="tombstone"`` keeps deletes as key-only rows of type ``d``; their key comes from the
    ``before`` image. ``hash_mode="raw"`` hashes the text as it came over the wire, the older form.
    Messages with an unreadable amount or time are left to :func:`rejects`.
    """
    ops = KEPT_OPS + (("d",) if on_delete == "tombstone" else ())
    typed = _type_once(keep_ops(decode_envelope(df, spec), ops).select("payload"), spec, truncate)
    good = typed.filter(F.size(unreadable(spec)) == 0)
    if hash_mode == "raw":
        parts = [F.hex(F.col(f"payload.after.{n}"))
                 if isinstance(spec.wire_type(n), T.BinaryType)
                 else F.col(f"payload.after.{n}").cast("string") for n in spec.columns]
        hashed = F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)
        return with_lineage_cdc(good.withColumn("hash", hashed)).select(spec.bronze_schema().names)
    rows = with_lineage_cdc(good)
    return rows.withColumn("hash", row_hash(rows, spec.columns))


def _text_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Columns that arrive as text of another type."""
    return [n for n, kind in spec.fields if isinstance(df.schema[n].dataType, T.StringType)
            and not isinstance(kind, T.StringType)]


def unreadable_drop(df: DataFrame, spec: TableSpec, typed: str = "_typed") -> Column:
    """Names of the columns whose text is there, but is not of the column's type; blank is null.
    ``typed`` holds the typed columns (see :func:`type_drop`)."""
    bad = [F.when((F.trim(n) != "") & F.col(f"{typed}.`{n}`").isNull(), n) for n in _text_columns(df, spec)]
    return F.array_compact(F.array(*bad, F.lit(None).cast("string")))


def type_drop(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A file drop with ``_typed``, its columns as the entity's types, read once behind a barrier."""
    text = set(_text_columns(df, spec))
    cols = [((F.try_to_binary(F.col(n), F.lit("base64")) if isinstance(kind, T.BinaryType)
              else F.col(n).try_cast(kind)) if n in text else F.col(n)).alias(n) for n, kind in spec.fields]
    return df.select(*df.columns, F.inline(F.array(F.struct(F.struct(*cols).alias("_typed")))))


def cast_drop(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed columns from a file drop, where nearly everything is text."""
    keep = [c for c in df.columns if c not in spec.columns]
    return type_drop(df, spec).select(*[F.col(f"_typed.`{n}`").alias(n) for n in spec.columns], *keep)


def drop_rejects(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of a file drop that ``decode_drop`` leaves out, as they came, with the reason."""
    judged = type_drop(df, spec).withColumn("reason", _reason(unreadable_drop(df, spec)))
    return judged.filter("reason is not null").drop("_typed")


def with_lineage_batch(df: DataFrame, now: Column, connector: str = BATCH_CONNECTOR,
                       source: Column | None = None) -> DataFrame:
    """Lineage of a file load: load time, type ``c``, the connector and the input file."""
    return df.select(
        *df.columns,
        now.alias("ingestion_time"),
        F.lit("c").alias("transaction_type"),
        F.lit(connector).alias("connector"),
        (F.input_file_name() if source is None else source).alias("source"),
    )


def judge_drop(df: DataFrame, spec: TableSpec, now: Column, hash_mode: str = "typed",
               source: Column | None = None) -> DataFrame:
    """File-drop rows as bronze rows, with ``value``, the row as it came as JSON, and ``reason``, null for
    good rows.

    ``hash_mode="raw"`` joins the raw text with ``||`` and leaves nulls out.
    """
    typed = type_drop(df, spec)
    typed = typed.withColumn("reason", _reason(unreadable_drop(df, spec)))
    came = F.when(F.col("reason").isNotNull(), F.to_json(F.struct(*[F.col(n) for n in spec.columns])))
    if hash_mode == "raw":
        typed = typed.withColumn("hash", row_hash(df, spec.columns, "||", "skip"))
    lined = with_lineage_batch(typed.withColumn("value", came), now, source=source)
    rest = [c for c in lined.columns if c not in (*spec.columns, "_typed")]
    rows = lined.select(*[F.col(f"_typed.`{n}`").alias(n) for n in spec.columns], *rest)
    return rows if hash_mode == "raw" else rows.withColumn("hash", row_hash(rows, spec.columns))


def decode_drop(df: DataFrame, spec: TableSpec, now: Column, hash_mode: str = "typed",
                source: Column | None = None) -> DataFrame:
    """File-drop rows to bronze rows. Rows with text that cannot be read are left to
    :func:`drop_rejects`."""
    return judge_drop(df, spec, now, hash_mode, source).filter("reason is null").drop("reason", "value")
