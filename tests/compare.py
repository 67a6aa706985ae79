"""Run queries beside their SQL and compare whole results.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None if query and SQL agree; else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    want = rows_of(rel.columns, rel.fetchall())
    if got == want:
        return None if got else "no rows on either side"
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows != {len(want)}; spark {only_got}; sql {only_want}"


def main() -> int:
    from tests.conftest import make_session
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(contract.queries())
    spark, con = make_session(), oracle(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = differences(spark, con, name, sf_dir)
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s"
              + (f"\n     {diff}" if diff else ""), flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
