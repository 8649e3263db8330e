"""Products: STARTUP records -> limit -> skip finished -> pricing from landed
model replies (first successful tier), rule tier for the rest -> PRODUCT.

Shuffles: resume anti join, reply min_by per record, reply join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodestar.operators.classify import build_products


def products_from_startups(startups: DataFrame, replies: DataFrame | None = None,
                           done: DataFrame | None = None, limit: int | None = None,
                           use_rules: bool = True, tiers=None) -> DataFrame:
    """``replies(record_key=source url, tier_idx, status, body)``; ``tiers``: the caller's
    classifiers for what the replies leave open (``operators.classify.Tier``)."""
    return build_products(startups, done=done, replies=replies, limit=limit, use_rules=use_rules, tiers=tiers)
