"""News: RSS / Atom feed payloads -> items -> NEWS records (fresh only), plus
the per-source funnel (items, kept, stale or undated).

No shuffle for the records; one small aggregate for the funnel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.dates import is_fresh
from lodestar.operators.profile import funnel
from lodestar.operators.records import news_flags, news_records
from lodestar.sources.payloads import feed_items


def news_from_feeds(payloads: DataFrame, as_of) -> DataFrame:
    """``payloads(source_name, payload)`` -> NEWS records."""
    return news_records(feed_items(payloads, keep=["source_name"]), as_of)


def news_funnel(payloads: DataFrame, as_of) -> DataFrame:
    """A8 for feeds: per source, items read, kept, skipped as stale/undated."""
    f = news_flags(feed_items(payloads, keep=["source_name"]), as_of)
    usable = F.col("__title__").isNotNull() & F.col("__link__").isNotNull()
    fresh = is_fresh(F.col("__date__"), as_of)
    return funnel(f, "source_name", {"kept": usable & fresh, "skipped": usable & ~fresh,
                                     "unusable": ~usable})
