"""End-to-end flow queries (lodestar.plans) over payloads derived from the
driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators.records import flatten
from lodestar.plans.papers import papers_from_feeds
from lodestar.plans.startups import startups_from_tags
from lodestar.queries.common import events_as_of, load, paper_number, paper_number_sql, register
from lodestar.queries.linkage import _CANDS, _OW, _RP, candidates, repo_dim
from lodestar.queries.records import STARTUPS_SQL, _TAG_SQL, _tag_idx, companies, underscored


@register("startups_flow", f"SELECT * FROM {STARTUPS_SQL}")
def q_startups_flow(spark, sf):
    """S5 -> P1/F1 -> W1: every company is landed twice (two tag lists);
    the first valid occurrence per id wins."""
    c = companies(spark, sf).drop("tag_idx", "pos")
    item = F.struct(*[F.col(x) for x in c.columns])
    one = c.select(F.floor(F.col("id") / 100).alias("tag_idx"), F.col("id").alias("o"), item.alias("item"))
    two = c.select((F.lit(100000) + F.floor(F.col("id") / 50)).alias("tag_idx"), F.col("id").alias("o"),
                   item.alias("item"))
    pl = (one.unionByName(two).groupBy("tag_idx")
          .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("o", "item"))),
                                     lambda x: x["item"])).alias("payload")))
    out = startups_from_tags(pl, events_as_of(spark, sf))
    return underscored(flatten(out, "startups"))


def paper_feed_pages(spark, sf):
    e = load(spark, sf, "events")
    k = F.col("event_id")
    aid = F.concat(paper_number(F.floor(k / 3).cast("bigint")), F.lit("v1"))  # each paper in up to three feeds
    x = F.concat(F.lit("<entry><id>http://arxiv.org/abs/"), aid, F.lit("</id><title>Paper "), k.cast("string"),
                 F.lit("</title><published>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                 F.lit("</published></entry>"))
    e = e.select(F.col("event_type").alias("category"), _tag_idx().alias("cat_idx"),
                 (F.floor(k / 100) * 100).alias("page_start"), k.alias("event_id"), x.alias("x"))
    return (e.groupBy("category", "cat_idx", "page_start")
            .agg(F.array_sort(F.collect_list(F.struct("event_id", "x"))).alias("a"))
            .select("category", "cat_idx", "page_start",
                    F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'),
                             F.array_join(F.transform("a", lambda v: v["x"]), ""), F.lit("</feed>")).alias("payload")))


@register("papers_flow", f"""WITH {_CANDS},
ev AS (SELECT event_id, event_type AS category, {_TAG_SQL} AS cat_idx, event_id // 100 AS page,
              {paper_number_sql("event_id // 3")} || 'v1' AS arxiv_id FROM events),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id ORDER BY cat_idx, page, event_id) r2
                      FROM ev) WHERE r2 = 1)
SELECT dd.arxiv_id, 'Paper ' || dd.event_id::VARCHAR AS title, l.github_url, d.stargazers_count AS github_stars
FROM dd LEFT JOIN links l ON l.ref_id = split_part(dd.arxiv_id, 'v', 1)
LEFT JOIN dim d ON d.owner = {_OW} AND d.repo = {_RP}""")
def q_papers_flow(spark, sf):
    """S8 -> P3/F1 -> S11 -> W4 -> J8: all pages of the paper feeds per
    category, deduped across categories, linked and starred."""
    out = papers_from_feeds(paper_feed_pages(spark, sf), candidates(spark, sf), repo_dim(spark, sf),
                            events_as_of(spark, sf))
    return out.select(F.col("content.arxiv_id").alias("arxiv_id"), F.col("content.title").alias("title"),
                      F.col("content.github_url").alias("github_url"),
                      F.col("content.github_stars").alias("github_stars"))

