"""Column expressions of the change decode path. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_decimal(col: Column, precision: int, scale: int) -> Column:
    """Decimal from base64 text of its signed big-endian unscaled bytes, however many.

    Leading bytes that only repeat the sign are taken off; what then has more than 8 bytes is too
    wide for any money type here. Bad base64 or a value too wide for the type give null.
    """
    raw = F.try_to_binary(col, F.lit("base64"))
    digits = F.regexp_replace(F.hex(raw), "^(?:(?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", "")
    sign = F.when(digits >= "8", "F").otherwise("0")     # text order: first digit 8 to F
    unscaled = F.conv(F.lpad(digits, 16, sign), 16, -10).cast("decimal(20,0)")
    value = unscaled * F.lit(Decimal(1).scaleb(-scale))
    return F.when(F.length(digits) <= 16, value.try_cast(T.DecimalType(precision, scale)))


def encode_decimal(col: Column, scale: int) -> Column:
    """Inverse of :func:`decode_decimal`: eight bytes, base64."""
    unscaled = (col * F.lit(Decimal(10) ** scale)).cast("bigint")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))


def event_time(millis: Column, truncate: str | None = None) -> Column:
    """Timestamp from epoch milliseconds given as text or number."""
    ts = F.timestamp_millis(millis.try_cast("bigint"))
    return F.date_trunc(truncate, ts) if truncate else ts


def row_hash(
    df: DataFrame,
    cols: Sequence[str],
    sep: str = "|",
    null_mode: str = "empty",
) -> Column:
    """SHA-256 over the joined text of ``cols``; binary columns enter as hex.

    ``null_mode="empty"`` writes a null as the empty string, so a value moved by one
    column changes the hash. ``"skip"`` leaves nulls out, as the file loads do.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in cols:
        text = (f"hex(`{name}`)" if isinstance(types[name], T.BinaryType)
                else f"cast(`{name}` as string)")
        parts.append(text if null_mode == "skip" else f"coalesce({text}, '')")
    return F.expr(f"sha2(concat_ws('{sep}', {', '.join(parts)}), 256)")


def month_label(ts: str | Column) -> Column:
    """``yyyyMM`` of the half-open month ``[first, first of next)`` holding ``ts``."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyyMM")


def line_amount(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    return (F.col(quantity).cast("decimal(10,0)") * F.col(unit_price)).cast("decimal(18,2)")
