"""Flows (lodestar.plans) over payloads derived from the sf0.001 tables."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_jobs_flow_matches_registered_query(spark):
    from lodestar.plans.jobs import jobs_from_sources
    from lodestar.queries.common import events_as_of
    from lodestar.queries.sources import job_payloads, jobs
    pa, pb, pc = job_payloads(spark, SF)
    a = jobs_from_sources(pa, pb, pc, events_as_of(spark, SF))
    assert sorted(a.select("source.url").collect()) == sorted(jobs(spark, SF).select("source.url").collect())
    only_b = jobs_from_sources(None, pb, None, events_as_of(spark, SF))
    assert only_b.where(F.col("source.name") != "WeWorkRemotely").count() == 0


def test_news_flow_and_funnel(spark):
    from lodestar.plans.news import news_from_feeds, news_funnel
    from lodestar.queries.common import events_as_of
    from lodestar.queries.sources import news_payloads
    as_of = events_as_of(spark, SF)
    pl = news_payloads(spark, SF).withColumn("source_name", F.concat(F.lit("Feed "), (F.col("page") % 5).cast("string")))
    recs = news_from_feeds(pl, as_of)
    f = news_funnel(pl, as_of).agg(F.sum("kept").alias("kept"), F.sum("total").alias("total"),
                                   F.sum("skipped").alias("s"), F.sum("unusable").alias("u")).first()
    assert recs.count() == f.kept
    assert f.total == f.kept + f.s + f.u


def test_resolution_flow_and_export(spark, tmp_path):
    from lodestar.operators.classify import pricing_rules
    from lodestar.operators.records import product_records
    from lodestar.plans.export import export_all
    from lodestar.plans.resolution import resolve_records
    from lodestar.queries.records import startups
    from lodestar.sources.seed import default_seed
    s = startups(spark, SF)
    p = product_records(s.withColumn("pricingModel", pricing_rules(F.col("content.description"))))
    rs, rp, log, counts = resolve_records(s, p, default_seed(spark))
    assert log.count() == s.count() + p.count()
    assert rs.count() == s.count() and rp.count() == p.count()
    assert counts.agg(F.sum("count")).first()[0] == log.count()
    out = export_all({"startups": rs, "products": rp, "entity_mapping_log": log}, str(tmp_path / "x"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out["startups"])
    assert back.count() == s.count() and "content.entityName" in back.columns


def test_products_flow_resume(spark):
    from lodestar.plans.products import products_from_startups
    from lodestar.queries.records import startups
    s = startups(spark, SF)
    first = products_from_startups(s, limit=10)
    rest = products_from_startups(s, done=first)
    assert first.count() == 10 and rest.count() == s.count() - 10


def test_papers_repair_flow(spark):
    from lodestar.operators.filters import is_aggregator
    from lodestar.plans.papers import papers_from_feeds, repair_papers
    from lodestar.queries.common import events_as_of
    from lodestar.queries.flows import paper_feed_pages
    from lodestar.queries.linkage import candidates, repo_dim
    papers = papers_from_feeds(paper_feed_pages(spark, SF), candidates(spark, SF), repo_dim(spark, SF),
                               events_as_of(spark, SF), total=250)
    # Plant aggregator links and one url shared by many papers, then repair.
    k = F.xxhash64(F.col("content.arxiv_id")) % 5
    bad = papers.withColumn("content", F.col("content").withField(
        "github_url", F.when(k == 0, F.lit("https://github.com/x/awesome-list"))
        .when(k == 1, F.lit("https://github.com/x/shared")).otherwise(F.col("content.github_url"))))
    fixed = repair_papers(bad, candidates(spark, SF), repo_dim(spark, SF))
    assert fixed.count() == papers.count()
    urls = fixed.where(F.col("content.github_url").isNotNull()).groupBy("content.github_url").count()
    assert urls.where(F.col("count") > 2).count() == 0
    assert fixed.where(is_aggregator(F.col("content.github_url"), F.lit(""))).count() == 0
