"""Predicates and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import col_of, lit_array
from lodestar.schemas import AGGREGATOR_KEYWORDS, AI_KEYWORDS, METHOD_NONE


def keyword_match(texts, keywords=None) -> Column:
    """lower-case the non-empty texts, join with spaces, pad with one
    space each side, and test for any keyword as a plain substring."""
    keywords = keywords or AI_KEYWORDS
    parts = F.filter(F.array(*[F.lower(col_of(t)) for t in texts]),
                     lambda x: x.isNotNull() & (x != ""))
    hay = F.concat(F.lit(" "), F.array_join(parts, " "), F.lit(" "))
    return F.exists(lit_array(keywords), lambda k: F.contains(hay, k))


def is_aggregator(full_name, description=None, keywords=None) -> Column:
    """list/digest repository test over ``lower(full_name + ' ' + description)``."""
    keywords = keywords or AGGREGATOR_KEYWORDS
    name = F.lower(F.coalesce(col_of(full_name), F.lit("")))
    desc = F.lower(F.coalesce(col_of(description), F.lit(""))) if description is not None \
        else F.lit("")
    hay = F.concat(name, F.lit(" "), desc)
    return F.exists(lit_array(keywords), lambda k: F.contains(hay, k))


def pending(df: DataFrame, key: str, done_col: str | None = None) -> DataFrame:
    """key present and (optionally) no value yet in ``done_col``."""
    cond = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    if done_col:
        cond = cond & (F.col(done_col).isNull() | (F.col(done_col).cast("string") == ""))
    return df.where(cond)


def named_lookup(df: DataFrame, name_col: str, names, cols) -> DataFrame:
    """exact, case-sensitive lookup of named records plus a projection."""
    return df.where(F.col(name_col).isin(*names)).select(*cols)


def seed_matched(log: DataFrame) -> DataFrame:
    """mapping-log rows that hit the seed."""
    return log.where(F.col("method") != METHOD_NONE)


def limit_first(df: DataFrame, n: int | None, order) -> DataFrame:
    """L1: first ``n`` rows by an explicit order; 0/None = no limit."""
    if not n:
        return df
    return df.orderBy(*order).limit(n)


def head_sample(df: DataFrame, k: int, order) -> DataFrame:
    """L2: ``k`` sample rows by an explicit order."""
    return df.orderBy(*order).limit(k)
