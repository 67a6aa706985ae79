"""Named queries, each with the SQL it must agree with (or none)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


class Catalog(dict[str, Entry]):
    def add(self, name: str, run: Query, sql: str | None = None) -> None:
        if name in self:
            raise ValueError(f"duplicate query {name}")
        self[name] = Entry(run, sql)

    def query(self, name: str, sql: str | None = None):
        def wrap(run: Query) -> Query:
            self.add(name, run, sql)
            return run
        return wrap
