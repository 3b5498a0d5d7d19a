"""Independent DuckDB SQL for the registered queries (correctness oracle)."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from . import core, dims, fptf, gtfs, ingest, sources
    out: dict[str, str] = {}
    for m in (core, ingest, gtfs, dims, sources, fptf):
        out.update(m.queries())
    return out
