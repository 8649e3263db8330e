"""Startups: tag payloads -> company rows -> STARTUP records -> first-wins dedupe.

Shuffles: one (the ``min_by`` dedupe on company id, partial on the map side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodestar.operators.dedupe import first_wins
from lodestar.operators.records import startup_records
from lodestar.sources.payloads import COMPANY_ELEMENT, json_array_rows


def startups_from_tags(payloads: DataFrame, collected_at) -> DataFrame:
    """``payloads(tag_idx, tag, payload)`` (one JSON array per tag) ->
    deduped STARTUP records.  Invalid companies (no name/url) never claim an
    id; the first valid occurrence in (tag order, position) wins."""
    rows = json_array_rows(payloads, COMPANY_ELEMENT, keep=["tag_idx"])
    recs = startup_records(rows, collected_at, keep=("id", "tag_idx", "pos"))
    return first_wins(recs, "id", ["tag_idx", "pos"]).drop("id", "tag_idx", "pos")
