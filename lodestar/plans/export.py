"""Export: the six flat CSV tables (startups, products, research_papers,
jobs, news, entity_mapping_log), one directory each."""

from __future__ import annotations

from lodestar.sinks import export_tables
from lodestar.sources.files import prefer_nonempty


def export_all(tables: dict, out_dir: str, raw: dict | None = None) -> dict:
    """``tables`` maps a table name to its record DataFrame (the mapping log
    is already flat); missing tables are skipped.  ``raw`` holds the records
    before resolution: a table of ``tables`` that is missing or empty is
    exported from there (S4)."""
    raw = raw or {}
    chosen = {}
    for name in dict.fromkeys([*tables, *raw]):
        first, second = tables.get(name), raw.get(name)
        if first is not None and second is not None:
            chosen[name] = prefer_nonempty(first, second)
        elif first is not None or second is not None:
            chosen[name] = first if first is not None else second
    return export_tables(chosen, out_dir)
