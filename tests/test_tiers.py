"""The caller's classifiers as a chain (E3) and the caller's aggregator words (E5)."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import classify as C
from lodestar.operators import linkage as L

REPLY = '{"pricingModel": "%s"}'


def records(spark, n=6):
    return spark.createDataFrame([(f"r{i}", "x" * (100 * i) if i else None) for i in range(n)], "record_key string, prompt string")


def tier(seen, status=200, body=REPLY % "FREE"):
    """A classifier that answers with the given columns and notes what it is asked."""
    def classify(todo):
        seen.append({r.record_key: r.prompt for r in todo.collect()})
        return todo.select("record_key", F.lit(status).alias("status") if isinstance(status, int) else status.alias("status"),
                           F.lit(body).alias("body") if isinstance(body, str) else body.alias("body"))
    return classify


def test_each_tier_sees_what_is_open_within_its_budget(spark):
    a, b, c = [], [], []
    odd = F.substr("record_key", F.lit(2)).cast("int") % 2 == 1
    got = C.run_tiers(records(spark), [
        C.Tier(tier(a, F.when(odd, 200).otherwise(429)), 250),
        C.Tier(tier(b, body=F.when(F.col("record_key") == "r0", "no json").otherwise(REPLY % "PAID")), None),
        C.Tier(tier(c, 500))]).collect()
    assert {r.record_key: r.tier_idx for r in got} == {"r1": 0, "r3": 0, "r5": 0, "r2": 1, "r4": 1}
    assert len(a[0]) == 6 and all(len(p) <= 250 for p in a[0].values()) and a[0]["r0"] == ""
    assert b[0].keys() == {"r0", "r2", "r4"} and b[0]["r4"] == "x" * 400
    assert c[0].keys() == {"r0"}


def test_landed_replies_come_first_and_a_classifier_runs_once(spark):
    asked = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def model(prompt):
        asked.add(1)
        return REPLY % "ENTERPRISE"
    landed = spark.createDataFrame([("r1", 7, 200, REPLY % "PAID"), ("r2", 0, 500, ""), ("r9", 0, 200, REPLY % "FREE")],
                                   "record_key string, tier_idx int, status int, body string")
    once = C.Tier(lambda todo: todo.select("record_key", F.lit(200).alias("status"), model("prompt").alias("body")))
    got = C.run_tiers(records(spark, 4), [once, once], landed)
    assert {r.record_key: r.tier_idx for r in got.collect()} == {"r1": 7, "r9": 0, "r0": 1000, "r2": 1000, "r3": 1000}
    got.count()
    assert asked.value == 3
    with pytest.raises(ValueError):
        C.run_tiers(records(spark), [])
    assert C.run_tiers(records(spark).limit(0), [once]).count() == 0


def test_products_ask_the_tiers(spark):
    from lodestar.queries.records import startups
    s = startups(spark, "/root/testdata/sf0.001")
    n = s.count()
    out = C.build_products(s, tiers=[C.Tier(tier([], body=REPLY % "freemium"))])
    assert n and [tuple(r) for r in out.groupBy("content.pricingModel").count().collect()] == [("FREEMIUM", n)]


def test_aggregator_words_are_an_argument(spark):
    cands = spark.createDataFrame([("2401.00001", "https://github.com/o/awesome-x", "o/awesome-x", "", 9),
                                   ("2401.00001", "https://github.com/o/zoo", "o/zoo", "", 5)],
                                  "ref_id string, html_url string, full_name string, description string, stars bigint")
    dim = spark.createDataFrame([("o", "awesome-x", 9), ("o", "zoo", 5)], "owner string, repo string, stargazers_count int")
    papers = spark.createDataFrame([("2401.00001v1", "https://github.com/o/zoo", 5)],
                                   "arxiv_id string, github_url string, github_stars bigint")
    assert L.find_links(papers.select("arxiv_id"), cands).first().github_url.endswith("/zoo")
    assert L.find_links(papers.select("arxiv_id"), cands, keywords=["zoo"]).first().github_url.endswith("/awesome-x")
    assert L.enrich_papers(papers, cands, dim, keywords=["zoo"]).first().github_stars == 9
    r = L.refill_links(papers, cands, dim, keywords=["zoo"]).first()
    assert (r.github_url, r.github_stars, r["__cleared__"]) == ("https://github.com/o/awesome-x", 9, True)
    assert L.refill_links(papers, cands, dim).first().github_url.endswith("/zoo")
