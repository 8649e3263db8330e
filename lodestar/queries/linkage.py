"""Linkage and profile queries: papers = customers, repository candidates =
orders (each mentions its customer's paper id and the next one's, so a
paper has about twenty candidates and the cut at eight matters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import linkage as L
from lodestar.operators import profile as A
from lodestar.queries.common import load, paper_number, paper_number_sql, register
from lodestar.queries.records import _REPO_DESC_SQL, _REPO_NAME_SQL, _agg_sql, _repo_cols


def _pid(c):
    return paper_number(c)


def papers(spark, sf):
    c = load(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.concat(_pid(k), F.lit("v"), ((k % 3) + 1).cast("string")).alias("arxiv_id"))


def candidates(spark, sf):
    o = load(spark, sf, "orders")
    name, desc = _repo_cols(o)
    text = F.concat(F.lit("Code for arXiv:"), _pid(F.col("o_custkey")), F.lit(" (see also "),
                    _pid(F.col("o_custkey") + 1), F.lit("v2)."))
    url = F.when(F.col("o_orderkey") % 97 == 0, F.lit("")).otherwise(F.concat(F.lit("https://github.com/"), name))
    repos = o.select("o_orderkey", name.alias("full_name"), desc.alias("description"),
                     url.alias("html_url"), F.col("o_totalprice").cast("bigint").alias("stars"), text.alias("text"))
    return L.extract_refs(repos, "text")


def repo_dim(spark, sf):
    o = load(spark, sf, "orders").where(F.col("o_orderkey") % 5 != 0)
    name, _ = _repo_cols(o)
    return (o.select(F.split(name, "/")[0].alias("owner"), F.split(name, "/")[1].alias("repo"),
                     F.floor(F.col("o_totalprice") / 10).cast("bigint").alias("stargazers_count"))
            .groupBy("owner", "repo").agg(F.max("stargazers_count").alias("stargazers_count")))


_PID = paper_number_sql("{x}")
_CANDS = f"""cands AS (
  SELECT o_orderkey, {_REPO_NAME_SQL} AS full_name, {_REPO_DESC_SQL} AS description,
    CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'https://github.com/' || {_REPO_NAME_SQL} END AS html_url,
    trunc(o_totalprice)::BIGINT AS stars,
    unnest(list_distinct([{_PID.format(x='o_custkey')}, {_PID.format(x='(o_custkey + 1)')}])) AS ref_id
  FROM orders
), top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY stars DESC NULLS LAST,
                 html_url ASC NULLS LAST) AS rank FROM cands) WHERE rank <= 8
), firstok AS (
  SELECT ref_id, html_url FROM (
    SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY rank) rn FROM top
    WHERE NOT {_agg_sql('full_name', 'description')}) WHERE rn = 1
), links AS (SELECT ref_id, html_url AS github_url FROM firstok WHERE html_url <> ''),
papers AS (
  SELECT c_custkey, {_PID.format(x='c_custkey')} || 'v' || (c_custkey % 3 + 1)::VARCHAR AS arxiv_id FROM customer
), dim AS (
  SELECT owner, repo, max(st) AS stargazers_count FROM (
    SELECT split_part({_REPO_NAME_SQL}, '/', 1) AS owner, split_part({_REPO_NAME_SQL}, '/', 2) AS repo,
           floor(o_totalprice / 10)::BIGINT AS st FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY owner, repo
)"""


def _owner_repo_sql(u):
    p = f"string_split(string_split(rtrim({u}, '/'), 'github.com/')[-1], '/')"
    return (f"CASE WHEN len({p}) >= 2 THEN {p}[1] END", f"CASE WHEN len({p}) >= 2 THEN {p}[2] END")


_OW, _RP = _owner_repo_sql("l.github_url")


@register("link_top8", f"WITH {_CANDS} SELECT p.c_custkey, l.github_url FROM papers p "
          "JOIN links l ON l.ref_id = split_part(p.arxiv_id, 'v', 1)")
def q_link_top8(spark, sf):
    """J6 + W2 + F4: top 8 candidates by stars, drop aggregators, take the first."""
    return L.find_links(papers(spark, sf), candidates(spark, sf)).where(F.col("github_url").isNotNull()) \
        .select("c_custkey", "github_url")


@register("enrich_links", f"""WITH {_CANDS}
SELECT p.c_custkey, l.github_url, d.stargazers_count AS github_stars
FROM papers p LEFT JOIN links l ON l.ref_id = split_part(p.arxiv_id, 'v', 1)
LEFT JOIN dim d ON d.owner = {_OW} AND d.repo = {_RP}""")
def q_enrich_links(spark, sf):
    """J8 = J6 then J7 (stars by owner/repo) for linked papers."""
    out = L.enrich_papers(papers(spark, sf), candidates(spark, sf), repo_dim(spark, sf))
    return out.select("c_custkey", "github_url", "github_stars")


def _prelinked(spark, sf):
    p = papers(spark, sf)
    k = F.col("c_custkey")
    url = (F.when(k % 4 == 0, F.concat(F.lit("https://github.com/u"), k.cast("string"), F.lit("/awesome-list-x")))
           .when(k % 4 == 1, F.concat(F.lit("https://github.com/u"), k.cast("string"), F.lit("/own"))))
    return p.select("c_custkey", F.when(k % 10 == 9, F.lit(None)).otherwise(F.col("arxiv_id")).alias("arxiv_id"),
                    url.alias("github_url"), F.when(k % 4 <= 1, F.lit(5)).cast("bigint").alias("github_stars"))


_PRE = """pre AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE arxiv_id END AS arxiv_id,
    CASE c_custkey % 4 WHEN 0 THEN 'https://github.com/u' || c_custkey::VARCHAR || '/awesome-list-x'
                       WHEN 1 THEN 'https://github.com/u' || c_custkey::VARCHAR || '/own' END AS github_url,
    CASE WHEN c_custkey % 4 <= 1 THEN 5 END::BIGINT AS github_stars FROM papers
), cleared AS (
  SELECT c_custkey, arxiv_id,
    {agg} AS was_cleared,
    CASE WHEN {agg} THEN NULL ELSE github_url END AS github_url,
    CASE WHEN {agg} THEN NULL ELSE github_stars END AS github_stars FROM pre
), refilled AS (
  SELECT c.c_custkey, was_cleared, (c.github_url IS NULL OR c.github_url = '') AS rechecked,
    CASE WHEN (c.github_url IS NULL OR c.github_url = '') AND c.arxiv_id IS NOT NULL AND c.arxiv_id <> ''
              AND l.github_url IS NOT NULL THEN l.github_url ELSE c.github_url END AS github_url,
    CASE WHEN (c.github_url IS NULL OR c.github_url = '') AND c.arxiv_id IS NOT NULL AND c.arxiv_id <> ''
              AND l.github_url IS NOT NULL THEN d.stargazers_count ELSE c.github_stars END AS github_stars
  FROM cleared c LEFT JOIN links l ON l.ref_id = split_part(c.arxiv_id, 'v', 1)
  LEFT JOIN dim d ON d.owner = {ow} AND d.repo = {rp}
)""".format(agg="coalesce(github_url <> '' AND " + _agg_sql("github_url", "''") + ", false)",
            ow=_OW, rp=_RP)


@register("refill_links", f"WITH {_CANDS}, {_PRE} SELECT c_custkey, github_url, github_stars FROM refilled")
def q_refill_links(spark, sf):
    """Clear aggregator links, then re-link rows without a link."""
    out = L.refill_links(_prelinked(spark, sf), candidates(spark, sf), repo_dim(spark, sf))
    return out.select("c_custkey", "github_url", "github_stars")


@register("repair_counts", f"WITH {_CANDS}, {_PRE} SELECT count_if(was_cleared)::BIGINT AS cleared, "
          "count_if(rechecked)::BIGINT AS rechecked FROM refilled")
def q_repair_counts(spark, sf):
    """Counters of the clear-and-refill repair."""
    out = L.refill_links(_prelinked(spark, sf), candidates(spark, sf), repo_dim(spark, sf))
    return A.repair_counts(out, {"cleared": F.col("__cleared__"), "rechecked": F.col("__rechecked__")}) \
        .select(F.col("cleared").cast("bigint"), F.col("rechecked").cast("bigint"))


def _shared_urls(spark, sf):
    c = load(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey",
                    F.when(k % 3 == 0, F.lit(None)).otherwise(
                        F.concat(F.lit("https://github.com/r/"), (k % 500).cast("string"))).alias("github_url"),
                    F.col("c_nationkey").cast("bigint").alias("github_stars"))


_SHARED = ("(SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'https://github.com/r/' || "
           "(c_custkey % 500)::VARCHAR END AS github_url, c_nationkey::BIGINT AS github_stars FROM customer)")


@register("overmatch_clear", f"""
WITH s AS {_SHARED}, bad AS (
  SELECT github_url FROM s WHERE github_url IS NOT NULL AND github_url <> '' GROUP BY github_url HAVING count(*) > 2)
SELECT c_custkey, CASE WHEN b.github_url IS NULL THEN s.github_url END AS github_url,
       CASE WHEN b.github_url IS NULL THEN s.github_stars END AS github_stars
FROM s LEFT JOIN bad b ON b.github_url = s.github_url""")
def q_overmatch_clear(spark, sf):
    """J10 + A6: null url and stars where the url is on more than 2 rows."""
    return L.overmatch_clear(_shared_urls(spark, sf)).select("c_custkey", "github_url", "github_stars")


@register("repeated_links", f"SELECT github_url, count(*)::BIGINT AS count FROM {_SHARED} "
          "WHERE github_url <> '' GROUP BY github_url HAVING count(*) > 1")
def q_repeated_links(spark, sf):
    """A2: urls on more than one paper, most frequent first."""
    return A.repeated_values(_shared_urls(spark, sf), "github_url", 2)


@register("extract_refs", """
SELECT doc_id, unnest(list_distinct(regexp_extract_all(t, '\\b(\\d{4}\\.\\d{4,5})(v\\d+)?\\b', 1))) AS ref_id FROM (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'arXiv:2312.' || lpad((doc_id % 89)::VARCHAR, 4, '0') || ' ' ELSE '' END
         || text || ' cf. 2401.' || lpad((doc_id % 997)::VARCHAR, 5, '0') || 'v2' AS t FROM documents)""")
def q_extract_refs(spark, sf):
    """J6 (repo side): paper ids found anywhere in whole document texts."""
    d = load(spark, sf, "documents")
    k = F.col("doc_id")
    t = F.concat(F.when(k % 2 == 0, F.concat(F.lit("arXiv:2312."), F.lpad((k % 89).cast("string"), 4, "0"), F.lit(" ")))
                 .otherwise(F.lit("")),
                 F.col("text"), F.lit(" cf. 2401."), F.lpad((k % 997).cast("string"), 5, "0"), F.lit("v2"))
    return L.extract_refs(d.select("doc_id", t.alias("t")), "t").select("doc_id", "ref_id")


# ------------------------------------------------------------------ profile
def _profiled(spark, sf):
    d = load(spark, sf, "documents")
    lab = load(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    k = F.col("doc_id")
    return j.select(
        "doc_id",
        F.when(F.col("quality") == 1, F.concat(F.lit("https://github.com/q/"), (k % 40).cast("string"))).alias("github_url"),
        F.col("toxic").cast("bigint").alias("github_stars"),
        F.when(k % 10 == 0, F.lit("")).otherwise(F.col("source")).alias("title"),
        F.when(k % 7 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source")).alias("authors"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.current_date()).alias("published_date"),
        F.array("lang", "source").alias("categories"))


_PROFILED = """(SELECT d.doc_id,
  CASE WHEN l.quality = 1 THEN 'https://github.com/q/' || (d.doc_id % 40)::VARCHAR END AS github_url,
  l.toxic::BIGINT AS github_stars, CASE WHEN d.doc_id % 10 = 0 THEN '' ELSE d.source END AS title,
  CASE WHEN d.doc_id % 7 = 0 THEN [] ELSE [d.lang, d.source] END AS authors,
  CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE 1 END AS published_date,
  [d.lang, d.source] AS categories
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@register("quality_profile", f"""
SELECT total, with_link, with_stars, missing_title, missing_authors, missing_date,
  CASE WHEN total > 0 THEN round(100.0 * with_link / total, 1) END AS pct_link,
  CASE WHEN total > 0 THEN round(100.0 * with_stars / total, 1) END AS pct_stars
FROM (SELECT count(*)::BIGINT AS total,
  count_if(github_url IS NOT NULL AND github_url <> '')::BIGINT AS with_link,
  count_if(github_stars IS NOT NULL)::BIGINT AS with_stars,
  count_if(title IS NULL OR title = '')::BIGINT AS missing_title,
  count_if(coalesce(len(authors), 0) <= 0)::BIGINT AS missing_authors,
  count_if(published_date IS NULL)::BIGINT AS missing_date FROM {_PROFILED})""")
def q_quality_profile(spark, sf):
    """A3: completeness profile of a paper-like table (documents + labels)."""
    return A.completeness(_profiled(spark, sf))


@register("star_stats", "SELECT count(*)::BIGINT AS n, min(s) AS min_value, max(s) AS max_value, "
          "avg(s::DOUBLE) AS avg_value FROM (SELECT trunc(o_totalprice)::BIGINT AS s FROM orders) HAVING count(*) > 0")
def q_star_stats(spark, sf):
    """A4: min / max / mean of star counts."""
    o = load(spark, sf, "orders").select(F.col("o_totalprice").cast("bigint").alias("s"))
    return A.value_stats(o, "s")


@register("distinct_categories", "SELECT count(DISTINCT c)::BIGINT AS n_distinct FROM "
          "(SELECT unnest([lang, source]) AS c FROM documents)")
def q_distinct_categories(spark, sf):
    """A5: distinct elements of an exploded array column."""
    return A.distinct_elements(_profiled(spark, sf), "categories").select(F.col("n_distinct").cast("bigint"))


@register("table_counts", "SELECT 'customer' AS \"table\", count(*)::BIGINT AS rows FROM customer "
          "UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'documents', count(*) FROM documents")
def q_table_counts(spark, sf):
    """Row counts per table."""
    return A.table_counts({t: load(spark, sf, t) for t in ("customer", "orders", "documents")}) \
        .select("table", F.col("rows").cast("bigint"))
