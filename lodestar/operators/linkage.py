"""Paper -> code repository linkage.

The candidate side is reduced before any join: ids are extracted from each
repository text once (``regexp_extract_all`` + ``explode``), then the top
``k`` candidates per id are kept with ``row_number() <= k`` (a
WindowGroupLimit, partial on the map side), so a heavily cited id costs at
most ``k`` rows per map task.  Only those rows meet the papers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import bare_id, repo_owner_repo
from lodestar.operators.filters import is_aggregator
from lodestar.operators.keys import with_spread_key
from lodestar.operators.records import truthy

# A paper id with an optional version; group 1 is the bare id: new style
# (yymm.number) or the seven digits of the old style, with or without its archive.
ARXIV_ID_RE = r"\b(?:[a-z-]+(?:\.[A-Z]{2})?/)?(\d{4}\.\d{4,5}|\d{7})(v\d+)?\b"


def extract_refs(repos: DataFrame, text_col: str = "text", id_regex: str = ARXIV_ID_RE,
                 group: int = 1) -> DataFrame:
    """J6 (repo side): one row per (repo, distinct bare paper id mentioned)."""
    ids = F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(id_regex), group))
    return repos.withColumn("ref_id", F.explode(ids))


def top_candidates(cands: DataFrame, key: str = "ref_id", k: int = 8,
                   stars: str = "stars", url: str = "html_url") -> DataFrame:
    """The ``k`` most-starred candidates per id (ties by url), with rank."""
    w = Window.partitionBy(key).orderBy(F.col(stars).desc_nulls_last(), F.col(url).asc_nulls_last())
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def choose_link(top: DataFrame, key: str = "ref_id", url: str = "html_url",
                full_name: str = "full_name", description: str = "description", keywords=None) -> DataFrame:
    """W2 + F4: per id, the best-ranked candidate that is not an aggregator (by
    ``keywords``, or the default list).
    Cut to k happens before the filter: if all k are aggregators there is no
    link; an empty url that survives the filter also gives no link."""
    ok_rank = F.when(~is_aggregator(F.col(full_name), F.col(description), keywords), F.col("rank"))
    return (top.groupBy(key)
            .agg(F.min_by(F.col(url), ok_rank).alias("__u__"), F.min(ok_rank).alias("__r__"))
            .where(F.col("__r__").isNotNull())
            .select(F.col(key), F.nullif(F.col("__u__"), F.lit("")).alias("github_url"))
            .where(F.col("github_url").isNotNull()))


def find_links(papers: DataFrame, cands: DataFrame, id_col: str = "arxiv_id", k: int = 8,
               ref_key: str = "ref_id", keywords=None) -> DataFrame:
    """Paper rows + ``github_url`` (null when no acceptable candidate).
    Candidates ``(ref_id, html_url, full_name, description, stars)`` are keyed
    by the bare (version-less) paper id."""
    links = choose_link(top_candidates(cands, ref_key, k), keywords=keywords)
    p = with_spread_key(papers, "__bare__", F.when(truthy(id_col), bare_id(F.col(id_col))))
    return (p.join(links.withColumnRenamed(ref_key, "__bare__"), "__bare__", "left")
            .drop("__bare__"))


def star_lookup(df: DataFrame, repo_dim: DataFrame, url_col: str = "github_url",
                out: str = "github_stars") -> DataFrame:
    """Stars of ``owner/repo`` parsed from the url (X13); unknown -> null.
    A repository listed more than once has its largest known star count."""
    owner, repo = repo_owner_repo(F.col(url_col))
    d = (repo_dim.groupBy(F.concat_ws("/", "owner", "repo").alias("__r__"))
         .agg(F.max(F.col("stargazers_count").cast("bigint")).alias(out)))
    base = with_spread_key(df, "__r__", F.concat(owner, F.lit("/"), repo))
    if out in df.columns:
        base = base.drop(out)
    return base.join(d, "__r__", "left").drop("__r__")


def enrich_papers(papers: DataFrame, cands: DataFrame, repo_dim: DataFrame,
                  id_col: str = "arxiv_id", k: int = 8, keywords=None) -> DataFrame:
    """Link (J6) then star lookup (J7) for linked papers; unlinked -> both null."""
    linked = find_links(papers.drop("github_url", "github_stars"), cands, id_col, k, keywords=keywords)
    return star_lookup(linked, repo_dim)


def refill_links(papers: DataFrame, cands: DataFrame, repo_dim: DataFrame,
                 id_col: str = "arxiv_id", k: int = 8, keywords=None) -> DataFrame:
    """Clear links whose url looks like an aggregator (F4 on the url with
    an empty description), then re-link every row without a link that has an
    id.  Rows without an id keep what they have (possibly the cleared nulls).
    Adds ``__cleared__`` / ``__rechecked__`` flags for the repair counters (A9)."""
    bad = truthy("github_url") & is_aggregator(F.col("github_url"), F.lit(""), keywords)
    p = (papers.withColumn("__cleared__", F.coalesce(bad, F.lit(False)))
         .withColumn("github_url", F.when(F.col("__cleared__"), F.lit(None).cast("string"))
                     .otherwise(F.col("github_url")))
         .withColumn("github_stars", F.when(F.col("__cleared__"), F.lit(None).cast("bigint"))
                     .otherwise(F.col("github_stars")))
         .withColumn("__rechecked__", ~truthy("github_url")))
    todo = p.where(F.col("__rechecked__") & truthy(id_col))
    keep = p.where(~(F.col("__rechecked__") & truthy(id_col)))
    found = find_links(todo.withColumnRenamed("github_url", "__old_url__"), cands, id_col, k, keywords=keywords)
    found = star_lookup(found.withColumnRenamed("github_stars", "__old_stars__"), repo_dim,
                        "github_url", "__new_stars__")
    found = (found.withColumn("github_stars", F.when(F.col("github_url").isNotNull(),
                                                     F.col("__new_stars__"))
                              .otherwise(F.col("__old_stars__")))
             .withColumn("github_url", F.coalesce(F.col("github_url"), F.col("__old_url__")))
             .drop("__old_url__", "__old_stars__", "__new_stars__"))
    return keep.unionByName(found)


def overmatch_clear(papers: DataFrame, max_papers: int = 2, url_col: str = "github_url",
                    stars_col: str = "github_stars") -> DataFrame:
    """Null url and stars on rows whose url is linked to more than
    ``max_papers`` rows (only non-empty urls are counted).  An aggregate and
    a join, not a window; rows without a url are dealt evenly (``with_spread_key``)."""
    bad = (papers.where(truthy(url_col)).groupBy(url_col).count()
           .where(F.col("count") > max_papers).select(F.col(url_col).alias("__bad__")))
    j = with_spread_key(papers, "__key__", F.col(url_col)).join(bad, F.col("__key__") == F.col("__bad__"), "left")
    hit = F.col("__bad__").isNotNull()
    return (j.withColumn("__overmatched__", hit)
            .withColumn(url_col, F.when(hit, F.lit(None).cast("string")).otherwise(F.col(url_col)))
            .withColumn(stars_col, F.when(hit, F.lit(None).cast("bigint")).otherwise(F.col(stars_col)))
            .drop("__bad__", "__key__"))
