"""Protection of personal data: encryption, key rotation, masking, row scope, join tokens."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import children_of


def _key(secret: str) -> Column:
    """A 32-byte AES key from a passphrase of any length."""
    return F.unhex(F.sha2(F.lit(secret).cast("binary"), 256))


def encrypt(df: DataFrame, cols: Sequence[str], secret: str) -> DataFrame:
    """AES-GCM with a random nonce per value; null stays null."""
    return df.withColumns({c: F.aes_encrypt(F.col(c).cast("binary"), _key(secret)) for c in cols})


def decrypt(df: DataFrame, cols: Sequence[str], secret: str) -> DataFrame:
    """Back to text; a value this key cannot open becomes null."""
    return df.withColumns({c: F.try_aes_decrypt(F.col(c), _key(secret)).cast("string")
                           for c in cols})


def open_text(col: Column, secret: str) -> Column:
    """The text of an encrypted value; one this key cannot open stands for itself."""
    return F.coalesce(F.try_aes_decrypt(col.cast("binary"), _key(secret)).cast("string"), col.cast("string"))


def rotate_key(df: DataFrame, cols: Sequence[str], old: str,
               new: str) -> tuple[DataFrame, DataFrame]:
    """Re-encrypt under a new key. Returns (table, rows with a value the old key cannot open).

    Such values keep their old bytes.
    """
    opened = {c: F.try_aes_decrypt(F.col(c), _key(old)) for c in cols}
    rotated = df.withColumns({
        c: F.when(opened[c].isNotNull(), F.aes_encrypt(opened[c], _key(new))).otherwise(F.col(c))
        for c in cols})
    failed = F.lit(False)
    for c in cols:
        failed = failed | (F.col(c).isNotNull() & opened[c].isNull())
    return rotated, df.filter(failed)


@dataclass(frozen=True)
class Mask:
    """How a column looks to roles outside ``clear_for``: email, last4, hash or null."""
    how: str
    clear_for: frozenset[str] = field(default_factory=frozenset)


def _masked(col: Column, how: str) -> Column:
    text = col.cast("string")
    if how == "email":
        return F.regexp_replace(text, r"^(.)[^@]*(@.*)$", r"$1***$2")
    if how == "last4":
        return F.regexp_replace(text, r".(?=.{4})", "*")
    if how == "hash":
        return F.sha2(text, 256)
    if how == "null":
        return F.lit(None).cast("string")
    raise ValueError(how)


def mask(df: DataFrame, policy: dict[str, Mask], role: str) -> DataFrame:
    return df.withColumns({c: _masked(F.col(c), m.how) for c, m in policy.items()
                           if role not in m.clear_for and c in df.columns})


def row_scope(df: DataFrame, grants: DataFrame, user: str, scope: str) -> DataFrame:
    """Rows whose ``scope`` value is granted to ``user``. Grants: user_name, ``scope``."""
    mine = grants.filter(F.col("user_name") == user).select(scope)
    return children_of(df, mine, scope)


def tokenize(df: DataFrame, cols: Sequence[str], salt: str) -> DataFrame:
    """Deterministic token per value: equal values join, the value itself stays hidden."""
    return df.withColumns({c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256)
                           for c in cols})
