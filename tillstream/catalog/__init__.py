"""All named queries."""

from __future__ import annotations

from tillstream.catalog import current, ingest, mutations, quality, reports, retention, storage
from tillstream.catalog.registry import Entry


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for module in (reports, ingest, current, quality, retention, mutations, storage):
        for name, entry in module.CATALOG.items():
            if name in found:
                raise ValueError(f"duplicate query {name}")
            found[name] = entry
    return found
