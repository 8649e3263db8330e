"""Aggregations and data-quality profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import percent
from lodestar.operators.records import truthy


def frequency(df: DataFrame, key: str) -> DataFrame:
    """A1: ``(key, count)`` by descending count; ties broken by key."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(key).asc_nulls_last()))


def repeated_values(df: DataFrame, col: str, min_count: int = 2) -> DataFrame:
    """Non-empty values seen at least ``min_count`` times, descending."""
    return (df.where(truthy(col)).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") >= min_count)
            .orderBy(F.col("count").desc(), F.col(col)))


def completeness(df: DataFrame, link: str = "github_url", stars: str = "github_stars",
                 title: str = "title", authors: str = "authors", date: str = "published_date") -> DataFrame:
    """A3: one-row profile: totals, link/star coverage with percentages, and
    missing title / authors / date counts.  Empty strings and empty arrays
    are missing; 0 stars is present; percentages are null on empty input."""
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(truthy(link)).alias("with_link"),
        F.count_if(F.col(stars).isNotNull()).alias("with_stars"),
        F.count_if(~truthy(title)).alias("missing_title"),
        F.count_if(F.coalesce(F.size(F.col(authors)), F.lit(0)) <= 0).alias("missing_authors"),
        F.count_if(F.col(date).isNull()).alias("missing_date"))
    return agg.select("*", percent("with_link", "total").alias("pct_link"),
                      percent("with_stars", "total").alias("pct_stars"))


def value_stats(df: DataFrame, col: str) -> DataFrame:
    """A4: min / max / mean of a column (nulls ignored); no values -> no row."""
    return (df.where(F.col(col).isNotNull())
            .agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("min_value"),
                 F.max(col).alias("max_value"), F.avg(F.col(col).cast("double")).alias("avg_value"))
            .where(F.col("n") > 0))


def distinct_elements(df: DataFrame, array_col: str, approx: bool = False) -> DataFrame:
    """A5: number of distinct elements over an array column."""
    e = df.select(F.explode(F.col(array_col)).alias("__e__"))
    fn = F.approx_count_distinct if approx else F.count_distinct
    return e.agg(fn("__e__").alias("n_distinct"))


def table_counts(tables: dict) -> DataFrame:
    """``(table, rows)`` for a dict of DataFrames, as one union plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def funnel(df: DataFrame, group: str, flags: dict) -> DataFrame:
    """Single-pass ``count_if`` per flag column/expression per group,
    plus the total.  Flags are computed before any filtering."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in flags.items()]
    return df.groupBy(group).agg(*aggs)


def repair_counts(df: DataFrame, flags: dict) -> DataFrame:
    """One-row counters of repair flags (cleared, rechecked, ...)."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
