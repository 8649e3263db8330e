"""Papers: Atom feed pages -> paper records -> page cut per category ->
cross-category dedupe -> resume skip -> repository link + stars.

Shuffles: category window (top ``total``, WindowGroupLimit), id dedupe,
resume anti join, candidate top-8 window, link join, star join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.dedupe import cross_group_dedupe, cut_pages, resume_anti
from lodestar.operators.linkage import enrich_papers, overmatch_clear, refill_links
from lodestar.operators.records import paper_records
from lodestar.sources.payloads import atom_paper_entries


def papers_from_feeds(payloads: DataFrame, candidates: DataFrame, repo_dim: DataFrame, collected_at,
                      total: int | None = None, done: DataFrame | None = None,
                      strict_parity: bool = False, keywords=None) -> DataFrame:
    """All papers of all pages; ``total`` cuts each category to its first rows;
    ``keywords`` (default: the fixed list) mark repositories that only collect links.
    ``payloads(category, cat_idx, page_start, payload)``; ``candidates``
    ``(ref_id, html_url, full_name, description, stars)``; ``repo_dim``
    ``(owner, repo, stargazers_count)``; ``done`` = the sink (envelope rows)."""
    entries = atom_paper_entries(payloads, keep=["category", "cat_idx", "page_start"])
    sizes = (entries.groupBy("category", "page_start").agg(F.count(F.lit(1)).alias("n"))
             .unionByName(payloads.select("category", "page_start", F.lit(0).cast("bigint").alias("n")))
             .groupBy("category", "page_start").agg(F.max("n").alias("n")))
    recs = paper_records(entries, collected_at, keep=("category", "cat_idx", "page_start", "pos"))
    recs = recs.withColumn("arxiv_id", F.col("content.arxiv_id"))
    recs = cut_pages(recs, "category", "page_start", "pos", total, sizes)
    recs = cross_group_dedupe(recs, "arxiv_id", ["cat_idx", "page_start", "pos"], group="cat_idx",
                              strict_parity=strict_parity)
    if done is not None:
        recs = resume_anti(recs, done, "arxiv_id", F.col("content.arxiv_id"))
    flat = recs.select("*", F.col("content.github_url").alias("github_url"),
                       F.col("content.github_stars").alias("github_stars"))
    linked = enrich_papers(flat, candidates, repo_dim, keywords=keywords)
    return (linked.withColumn("content", F.col("content").withField("github_url", F.col("github_url"))
                              .withField("github_stars", F.col("github_stars")))
            .drop("github_url", "github_stars", "arxiv_id", "category", "cat_idx", "page_start", "pos"))


def repair_papers(papers: DataFrame, candidates: DataFrame, repo_dim: DataFrame,
                  max_papers: int = 2, keywords=None) -> DataFrame:
    """J9 then J10 over the sink: clear aggregator links and re-link, then
    null urls that are linked to more than ``max_papers`` papers."""
    flat = papers.select("*", F.col("content.arxiv_id").alias("arxiv_id"),
                         F.col("content.github_url").alias("github_url"),
                         F.col("content.github_stars").alias("github_stars"))
    fixed = overmatch_clear(refill_links(flat, candidates, repo_dim, keywords=keywords), max_papers)
    return (fixed.withColumn("content", F.col("content").withField("github_url", F.col("github_url"))
                             .withField("github_stars", F.col("github_stars")))
            .drop("arxiv_id", "github_url", "github_stars", "__cleared__", "__rechecked__", "__overmatched__"))
