"""Remaining inventory items as queries: pending keys (F5), similarity
scores (X16/X17), display cuts and sample (X23, L2), response kinds (X24),
publish (K2/K3) and a descending top-k report (O1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar import sinks as K
from lodestar.functions import replies as R
from lodestar.functions import similarity as SIM
from lodestar.functions.text import display_cut
from lodestar.operators.filters import head_sample, pending
from lodestar.queries import sqlfrag as Q
from lodestar.queries.common import load, register
from lodestar.queries.linkage import _SHARED, _prelinked, _shared_urls
from lodestar.session import scratch_path


@register("pending_keys", """
SELECT c_custkey FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE 'x' END AS arxiv_id,
    CASE c_custkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS github_url FROM customer)
WHERE arxiv_id IS NOT NULL AND github_url IS NULL""")
def q_pending_keys(spark, sf):
    """key present and no value yet (the rows a re-link pass visits)."""
    return pending(_prelinked(spark, sf), "arxiv_id", "github_url").select("c_custkey")


def _name_pairs(spark, sf):
    c = load(spark, sf, "customer")
    k = F.col("c_custkey")
    a = F.lower(F.col("c_name"))
    b = (F.when(k % 4 == 0, F.concat(F.lit("the "), a))
         .when(k % 4 == 1, F.concat(F.substr(a, F.lit(1), F.lit(8)), F.substr(a, F.lit(11))))
         .when(k % 4 == 2, F.concat_ws(" ", F.lower("c_mktsegment"), a))
         .otherwise(F.concat(a, F.lit(" "), F.lower("c_mktsegment"))))
    return c.select("c_custkey", a.alias("a"), b.alias("b"))


_PAIRS = """(SELECT c_custkey, lower(c_name) AS a,
  CASE c_custkey % 4 WHEN 0 THEN 'the ' || lower(c_name)
    WHEN 1 THEN substr(lower(c_name), 1, 8) || substr(lower(c_name), 11)
    WHEN 2 THEN concat_ws(' ', lower(c_mktsegment), lower(c_name))
    ELSE lower(c_name) || ' ' || lower(c_mktsegment) END AS b FROM customer)"""


@register("similarity_scores", f"""
SELECT c_custkey, l AS lcs,
  CASE WHEN t = 0 THEN 100.0 ELSE (1.0 - (t - 2 * l)::DOUBLE / t) * 100.0 END AS ratio,
  100 * (t - 2 * l) <= 10 * t AS passes
FROM (SELECT c_custkey, length(sa) + length(sb) AS t, {Q.lcs('sa', 'sb')} AS l FROM (
  SELECT c_custkey, {Q.token_sort('a')} AS sa, {Q.token_sort('b')} AS sb FROM {_PAIRS}))""")
def q_similarity_scores(spark, sf):
    """X16 + X17: token-sort Indel ratio and the exact >= 90 test per pair."""
    p = _name_pairs(spark, sf).select("c_custkey", SIM.token_sort("a").alias("sa"), SIM.token_sort("b").alias("sb"))
    p = p.withColumn("lcs", SIM.lcs_length_batched("sa", "sb"))
    return p.select("c_custkey", "lcs", SIM.indel_ratio("sa", "sb", F.col("lcs")).alias("ratio"),
                    SIM.passes_threshold("sa", "sb", 90, F.col("lcs")).alias("passes"))


@register("display_sample", """
SELECT doc_id, left(coalesce(text, ''), 60) AS title, n_chars FROM documents
ORDER BY n_chars DESC, doc_id LIMIT 5""")
def q_display_sample(spark, sf):
    """X23 + L2: five sample rows with the text cut to 60 characters for display."""
    d = load(spark, sf, "documents").select("doc_id", display_cut("text", 60).alias("title"), "n_chars")
    return head_sample(d, 5, [F.col("n_chars").desc(), F.col("doc_id")])


@register("outcome_kinds", """
SELECT o_orderkey, s,
  CASE WHEN s = 200 THEN 'ok' WHEN s = 403 AND rem = '0' THEN 'retryable' WHEN s = 422 THEN 'empty'
       WHEN s >= 500 THEN 'retryable' ELSE 'permanent' END AS search_outcome,
  CASE WHEN s = 200 THEN 'ok' WHEN s = 403 AND rem = '0' THEN 'retryable' WHEN s = 404 THEN 'empty'
       WHEN s >= 500 THEN 'retryable' ELSE 'permanent' END AS repo_outcome,
  CASE WHEN s = 200 THEN 'ok' WHEN s = 429 THEN 'retryable' WHEN s = 404 THEN 'empty'
       WHEN s >= 500 THEN 'retryable' ELSE 'permanent' END AS tag_outcome
FROM (SELECT o_orderkey, ([200, 403, 404, 422, 429, 500, 503, 401])[o_orderkey % 8 + 1] AS s,
             CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE '17' END AS rem FROM orders)""")
def q_outcome_kinds(spark, sf):
    """Outcome classes of search, repo and tag responses."""
    o = load(spark, sf, "orders")
    s = F.element_at(F.array(*[F.lit(x) for x in (200, 403, 404, 422, 429, 500, 503, 401)]),
                     (F.col("o_orderkey") % 8).cast("int") + 1)
    rem = F.when(F.col("o_orderkey") % 3 == 0, F.lit("0")).otherwise(F.lit("17"))
    o = o.select("o_orderkey", s.alias("s"), rem.alias("rem"))
    return o.select("o_orderkey", "s", R.outcome_class("s", "search", F.col("rem")).alias("search_outcome"),
                    R.outcome_class("s", "repo", F.col("rem")).alias("repo_outcome"),
                    R.outcome_class("s", "tag").alias("tag_outcome"))


@register("publish_sink", "SELECT c_custkey, c_name FROM customer")
def q_publish_sink(spark, sf):
    """K2 + K3: two appended units (each visible once complete), then the
    sink, all runs included, is published to the final path."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    sink = scratch_path(spark, "sink")
    K.write_jsonl(c.where(F.col("c_custkey") % 2 == 0), sink, mode="append")
    K.write_jsonl(c.where(F.col("c_custkey") % 2 == 1), sink, mode="append")
    final = K.publish(spark, sink, schema, scratch_path(spark, "final"))
    return spark.read.schema(schema).json(final)


@register("top_repeated_links", f"SELECT github_url, count(*)::BIGINT AS count FROM {_SHARED} "
          "WHERE github_url <> '' GROUP BY github_url ORDER BY count DESC, github_url LIMIT 10")
def q_top_repeated_links(spark, sf):
    """O1: descending top-10 report of the most repeated links (tie by url)."""
    from lodestar.operators.profile import repeated_values
    return repeated_values(_shared_urls(spark, sf), "github_url", 1).limit(10)
