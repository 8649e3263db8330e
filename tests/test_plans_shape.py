"""Plan-shape regression tests: the scale properties found with explain()."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["link_top8", "capped_pages"])
def test_topk_is_partial_window_group_limit(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_name_regex_never_runs_per_input_row(spark):
    """Normalisation must run after the distinct: no plan line may apply the
    suffix regex to an expression that still mentions lineitem columns."""
    plan = E.queries()["resolve_lineitem"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    bad = [ln for ln in plan.splitlines() if "regexp_replace" in ln and "l_orderkey" in ln]
    assert not bad, bad[:1]


@pytest.mark.parametrize("name", ["first_wins_dedupe", "category_dedupe"])
def test_first_wins_is_one_pass_and_cut_before_the_shuffle(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan


@pytest.mark.parametrize("make", ["links", "stars", "overmatch", "resume"])
def test_null_keys_are_dealt_evenly(spark, make):
    """Half of the keys null, broadcast and AQE off: no task gets more than twice the median."""
    from pyspark.sql import functions as F

    from lodestar.operators import dedupe, linkage
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        n = F.col("id")
        url = F.when(n % 2 == 0, F.concat(F.lit("https://github.com/o/r"), n.cast("string")))
        df = spark.range(40000).select(n, url.alias("github_url"), F.when(n % 2 == 0, n.cast("string")).alias("arxiv_id"),
                                       F.lit(1).cast("bigint").alias("github_stars"))
        one = spark.range(5)
        if make == "stars":
            dim = one.select(F.lit("o").alias("owner"), F.concat(F.lit("r"), n.cast("string")).alias("repo"), n.alias("stargazers_count"))
            out = linkage.star_lookup(df, dim)
        elif make == "overmatch":
            out = linkage.overmatch_clear(df)
        elif make == "resume":
            out = dedupe.resume_anti(df, one.select(n.cast("string").alias("arxiv_id")), "arxiv_id")
        else:
            cands = one.select(n.cast("string").alias("ref_id"), F.lit("u").alias("html_url"), F.lit("f").alias("full_name"),
                               F.lit("d").alias("description"), n.alias("stars"))
            out = linkage.find_links(df.drop("github_url", "github_stars"), cands)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_projection_pruned_at_scan(spark):
    plan = _plan(E.queries()["resolve_lineitem"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
