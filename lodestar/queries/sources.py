"""Payload-source queries: event rows are landed as JSON / RSS / Atom
payload pages of at most 100 items (page = event_id div 100), then parsed
back and mapped to records.  Every page is one bounded group."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import records as P
from lodestar.operators.records import flatten
from lodestar.queries.common import AS_OF_SQL, events_as_of, load, ntz, paper_number, paper_number_sql, register
from lodestar.queries.records import underscored
from lodestar.sources import payloads as S

PAGE = 100


def _ev(spark, sf):
    e = load(spark, sf, "events")
    return e.withColumn("page", F.floor(F.col("event_id") / PAGE).cast("bigint"))


def landed(df):
    """Stand-in for a landed payload table (many files in production): the
    packed pages come out of a small shuffle that AQE would coalesce into
    one task, so they are spread over the configured parallelism before the
    CPU-heavy parsing."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64("page"))


def _pack_json(df, struct_col):
    """One JSON array payload per page, items ordered by event_id."""
    g = df.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("event_id", struct_col))).alias("a"))
    return landed(g.select("page", F.to_json(F.transform("a", lambda x: x[struct_col])).alias("payload")))


def _pack_text(df, text_col, head, tail):
    g = df.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("event_id", text_col))).alias("a"))
    return landed(g.select("page", F.concat(F.lit(head), F.array_join(F.transform("a", lambda x: x[text_col]), ""),
                                            F.lit(tail)).alias("payload")))


# ---------------------------------------------------------------- S5
@register("json_list_source", "SELECT event_id AS id, event_type || '-' || user_id::VARCHAR AS name, "
          "user_id AS team_size, value FROM events")
def q_json_list_source(spark, sf):
    """JSON array payloads -> element rows with their positions."""
    e = _ev(spark, sf)
    item = F.struct(F.col("event_id").alias("id"),
                    F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("name"),
                    F.col("user_id").alias("team_size"), F.col("value").alias("value"))
    pl = _pack_json(e.withColumn("item", item), "item")
    rows = S.json_array_rows(pl, "id BIGINT, name STRING, team_size BIGINT, value DOUBLE", keep=["page"])
    return rows.select("id", "name", "team_size", "value")


# ---------------------------------------------------------------- jobs
def _job_fields(e):
    k = F.col("event_id")
    title = (F.when(k % 4 == 0, F.lit("Senior ML Engineer"))
             .when(k % 4 == 1, F.concat(F.col("event_type"), F.lit(" AI lead")))
             .when(k % 4 == 2, F.lit("Sales Manager")).otherwise(F.lit("Data Scientist")))
    return e.select("*", title.alias("jt"), F.concat(F.lit("co"), F.col("user_id").cast("string")).alias("jc"),
                    F.concat(F.lit("https://jobs.example/"), k.cast("string")).alias("ju"),
                    F.array(F.col("event_type"), F.when(k % 5 == 0, F.lit("nlp")).otherwise(F.lit("misc"))).alias("jtags"))


_JOB_TITLE_SQL = ("CASE event_id % 4 WHEN 0 THEN 'Senior ML Engineer' WHEN 1 THEN event_type || ' AI lead' "
                  "WHEN 2 THEN 'Sales Manager' ELSE 'Data Scientist' END")
_JOB_TAGS_SQL = "event_type || ' ' || CASE WHEN event_id % 5 = 0 THEN 'nlp' ELSE 'misc' END"


def _kw_sql(texts):
    from lodestar.queries.sqlfrag import kw_any
    from lodestar.schemas import AI_KEYWORDS
    hay = "(' ' || concat_ws(' ', " + ", ".join(f"nullif(lower({t}), '')" for t in texts) + ") || ' ')"
    return kw_any(hay, AI_KEYWORDS)


def job_payloads(spark, sf):
    e = _job_fields(_ev(spark, sf))
    k = F.col("event_id")
    a = e.where(k % 3 == 0).withColumn("item", F.struct(
        k.alias("id"), F.when(k % 2 == 0, F.col("jt")).alias("position"), F.col("jt").alias("title"),
        F.col("jc").alias("company"), F.col("ju").alias("url"), F.lit("<p>Remote role</p>").alias("description"),
        F.lit(None).cast("string").alias("location"), F.col("jtags").alias("tags"),
        F.when(k % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"),
        F.unix_seconds("ts").alias("epoch")))
    pa = _pack_json(a, "item").select("page", F.concat(F.lit('[{"legal":"notice"},'),
                                                       F.expr("substr(payload, 2)")).alias("payload"))
    b = e.where(k % 3 == 1).withColumn("x", F.concat(
        F.lit("<item><title>"), F.col("jc"), F.lit(": "), F.col("jt"), F.lit("</title><link>"), F.col("ju"),
        F.lit("</link><description>&lt;p&gt;Build &lt;b&gt;things&lt;/b&gt;&lt;/p&gt;</description><pubDate>"),
        F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>")))
    pb = _pack_text(b, "x", "<rss><channel>", "</channel></rss>")
    c = e.where(k % 3 == 2).withColumn("item", F.struct(
        F.col("jt").alias("title"), F.col("jc").alias("company_name"), F.col("ju").alias("url"),
        F.lit("Hybrid").alias("description"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("Berlin")).alias("location"),
        F.col("jtags").alias("tags"), F.unix_seconds("ts").alias("created_at"), (k % 2 == 0).alias("remote")))
    pc = _pack_json(c, "item").select("page", F.concat(F.lit('{"data":'), F.col("payload"), F.lit("}")).alias("payload"))
    return pa, pb, pc


def jobs(spark, sf):
    as_of = events_as_of(spark, sf)
    pa, pb, pc = job_payloads(spark, sf)
    ra = P.job_records_a(S.json_mixed_rows(pa, S.JOB_A_FIELDS, keep=["page"]), as_of)
    rb = P.job_records_b(S.rss_items(pb, keep=["page"]), as_of)
    rc = P.job_records_c(S.json_data_rows(pc, S.JOB_C_FIELDS, keep=["page"]), as_of)
    return ra.unionByName(rb).unionByName(rc)


_JOBS_SQL = f"""
WITH e AS (SELECT *, date_trunc('second', ts) AS t, {_JOB_TITLE_SQL} AS jt, 'co' || user_id::VARCHAR AS jc,
                  'https://jobs.example/' || event_id::VARCHAR AS ju, {_JOB_TAGS_SQL} AS jtags FROM events),
a AS (SELECT 'RemoteOK' AS source_name, jt AS title, jc AS company, t, true AS is_remote, 'Remote' AS location, ju
      FROM e WHERE event_id % 3 = 0 AND {_kw_sql(['jt', 'jtags'])}),
b AS (SELECT 'WeWorkRemotely', jt, jc, t, true, 'Remote', ju FROM e WHERE event_id % 3 = 1 AND {_kw_sql(['jt'])}),
c AS (SELECT 'Arbeitnow', jt, jc, t, event_id % 2 = 0, CASE WHEN event_id % 4 = 0 THEN 'Not specified' ELSE 'Berlin' END, ju
      FROM e WHERE event_id % 3 = 2 AND {_kw_sql(['jt', 'jtags'])}),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT '1.0' AS schemaVersion, 'JOB' AS recordType, source_name, ju AS source_url, title AS content_title,
  company AS content_company, t AS content_date, is_remote AS content_is_remote,
  'Engineering' AS content_role_family, location AS content_location, ju AS content_job_url,
  {AS_OF_SQL} AS collectedAt
FROM u WHERE t >= {AS_OF_SQL} - INTERVAL 24 HOUR"""


@register("job_records", _JOBS_SQL)
def q_job_records(spark, sf):
    """S6 + S7 + S9 + P4a-c + F2 + F3 + U1: three job sources parsed from
    payload pages, keyword- and freshness-gated, unioned, flattened."""
    j = underscored(flatten(jobs(spark, sf), "jobs"))
    return j.withColumn("content_date", ntz("content_date"))


@register("json_mixed_list", "SELECT event_id AS id, (event_id % 2 = 0) AS has_position FROM events "
          "WHERE event_id % 3 = 0")
def q_json_mixed_list(spark, sf):
    """A notice element without ``id`` is skipped; every listing kept."""
    pa, _, _ = job_payloads(spark, sf)
    r = S.json_mixed_rows(pa, S.JOB_A_FIELDS, keep=["page"])
    return r.select(F.col("id").cast("bigint").alias("id"), F.col("position").isNotNull().alias("has_position"))


@register("json_data_source", "SELECT 'https://jobs.example/' || event_id::VARCHAR AS url, "
          "(event_id % 2 = 0) AS remote FROM events WHERE event_id % 3 = 2")
def q_json_data_source(spark, sf):
    """``{"data": [...]}`` payloads -> rows."""
    _, _, pc = job_payloads(spark, sf)
    return S.json_data_rows(pc, S.JOB_C_FIELDS, keep=["page"]).select("url", "remote")


@register("rss_jobs_source", "SELECT 'co' || user_id::VARCHAR || ': ' || " + _JOB_TITLE_SQL +
          " AS title, 'Build things' AS description FROM events WHERE event_id % 3 = 1")
def q_rss_jobs_source(spark, sf):
    """S9 + X10: RSS items with escaped HTML descriptions, markup stripped."""
    from lodestar.functions.text import strip_markup
    _, pb, _ = job_payloads(spark, sf)
    r = S.rss_items(pb, keep=["page"])
    return r.select("title", strip_markup("description").alias("description"))


# ---------------------------------------------------------------- news
def news_payloads(spark, sf):
    e = _ev(spark, sf)
    k = F.col("event_id")
    title = F.when(k % 11 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" News "), F.col("event_type"), F.lit(" "), k.cast("string")))
    link = F.concat(F.lit("https://news.example/"), k.cast("string"))
    rss = e.where(F.col("page") % 2 == 0).withColumn("x", F.concat(
        F.lit("<item><title>"), title, F.lit("</title><link> "), link, F.lit(" </link><description>Story "),
        k.cast("string"), F.lit("</description>"),
        F.when(k % 3 == 0, F.concat(F.lit("<dc:date>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</dc:date>")))
        .otherwise(F.concat(F.lit("<pubDate>"), F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate>"))),
        F.lit("</item>")))
    prss = _pack_text(rss, "x", '<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>', "</channel></rss>")
    atom = e.where(F.col("page") % 2 == 1).withColumn("x", F.concat(
        F.lit("<entry><title>"), title, F.lit('</title><link href="'), link, F.lit('"/><summary>Story '),
        k.cast("string"), F.lit("</summary><updated>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
        F.lit("</updated></entry>")))
    patom = _pack_text(atom, "x", '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")
    return prss.unionByName(patom)


@register("news_records", f"""
SELECT '1.0' AS schemaVersion, 'NEWS' AS recordType, 'Feed ' || (page % 5)::VARCHAR AS source_name,
  'https://news.example/' || event_id::VARCHAR AS source_url,
  'News ' || event_type || ' ' || event_id::VARCHAR AS content_title, 'Story ' || event_id::VARCHAR AS content_summary,
  t AS content_published_date, 'https://news.example/' || event_id::VARCHAR AS content_article_url,
  {AS_OF_SQL} AS collectedAt
FROM (SELECT *, event_id // 100 AS page,
             CASE WHEN (event_id // 100) % 2 = 1 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS t
      FROM events)
WHERE event_id % 11 <> 0 AND t >= {AS_OF_SQL} - INTERVAL 24 HOUR""")
def q_news_records(spark, sf):
    """S10 + U3 + P5 + F3: RSS and Atom feeds parsed with one schema, field
    fallbacks, freshness gate, flattened NEWS records."""
    as_of = events_as_of(spark, sf)
    items = S.feed_items(news_payloads(spark, sf), keep=["page"])
    items = items.withColumn("source_name", F.concat(F.lit("Feed "), (F.col("page") % 5).cast("string")))
    n = underscored(flatten(P.news_records(items, as_of), "news"))
    return n.withColumn("content_published_date", ntz("content_published_date"))


@register("rss_source", "SELECT count(*)::BIGINT AS items, count_if(event_id % 11 <> 0)::BIGINT AS titled "
          "FROM events")
def q_rss_source(spark, sf):
    """Every RSS item and Atom entry is read (titled = non-blank title)."""
    items = S.feed_items(news_payloads(spark, sf), keep=["page"])
    return items.agg(F.count(F.lit(1)).cast("bigint").alias("items"),
                     F.count_if(F.col("title").isNotNull()).cast("bigint").alias("titled"))


# ---------------------------------------------------------------- papers
_PAPER = paper_number_sql("event_id")


def paper_payloads(spark, sf):
    e = _ev(spark, sf)
    k = F.col("event_id")
    x = F.concat(
        F.lit("<entry><id>http://arxiv.org/abs/"), paper_number(k), F.lit("v1</id><title>  Paper\n  "),
        F.col("event_type"), F.lit("   "), k.cast("string"), F.lit("</title><summary>"),
        F.when(k % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit("About\n"), F.col("event_type"))),
        F.lit("</summary><published>"),
        F.when(k % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.lit("</published><author><name>A"), F.col("user_id").cast("string"),
        F.lit("</name></author><author><name></name></author><category term=\"cs.AI\"/><category term=\""),
        F.col("event_type"), F.lit("\"/></entry>"))
    return _pack_text(e.withColumn("x", x), "x", '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")


@register("atom_source", f"""
SELECT '1.0' AS schemaVersion, 'RESEARCH_PAPER' AS recordType, 'arXiv' AS source_name,
  'http://arxiv.org/abs/' || {_PAPER} || 'v1' AS source_url,
  'Paper ' || event_type || ' ' || event_id::VARCHAR AS content_title, 'A' || user_id::VARCHAR AS content_authors,
  'http://arxiv.org/abs/' || {_PAPER} || 'v1' AS content_paper_url,
  NULL::VARCHAR AS content_github_url, NULL::BIGINT AS content_github_stars,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS content_published_date,
  {_PAPER} || 'v1' AS content_arxiv_id, {AS_OF_SQL} AS collectedAt
FROM events""")
def q_atom_source(spark, sf):
    """S8 + P3: Atom paper feeds -> RESEARCH_PAPER records (titles
    whitespace-collapsed, empty authors dropped, strict dates)."""
    as_of = events_as_of(spark, sf)
    entries = S.atom_paper_entries(paper_payloads(spark, sf), keep=["page"])
    p = underscored(flatten(P.paper_records(entries, as_of), "research_papers"))
    return p.withColumn("content_published_date", ntz("content_published_date"))


@register("paper_abstracts", f"SELECT {_PAPER} || 'v1' AS arxiv_id, "
          "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'About ' || event_type END AS abstract, "
          "array_to_string(['cs.AI', event_type], ' ') AS categories FROM events")
def q_paper_abstracts(spark, sf):
    """P3 detail: abstract collapsed (blank -> null), categories kept in order."""
    as_of = events_as_of(spark, sf)
    entries = S.atom_paper_entries(paper_payloads(spark, sf), keep=["page"])
    p = P.paper_records(entries, as_of)
    return p.select(F.col("content.arxiv_id").alias("arxiv_id"), F.col("content.abstract").alias("abstract"),
                    F.array_join("content.categories", " ").alias("categories"))


# ---------------------------------------------------------------- salvage
@register("page_salvage", """
SELECT event_id AS id, event_id % 100 AS pos, event_id % 10 = 1 AS is_nan,
  CASE event_id % 10 WHEN 0 THEN 'last' WHEN 3 THEN '{"a":1,"a":2}' WHEN 4 THEN 'x],{"y"\\' WHEN 5 THEN NULL ELSE event_type END AS title
FROM events WHERE event_id % 10 NOT IN (2, 6)""")
def q_page_salvage(spark, sf):
    """S6 + S7: pages in which some elements have a repeated key, ``NaN``, a
    repeated key inside a field, brackets and a backslash in a text, a broken
    value, or are no object: only the last two are lost, and only they."""
    k = F.col("event_id")
    key = F.concat(F.lit('{"id":'), k.cast("string"))
    title = F.concat(F.lit(',"title":"'), F.col("event_type"), F.lit('"'))
    item = (F.when(k % 10 == 0, F.concat(key, title, F.lit(',"title":"last"}')))
            .when(k % 10 == 1, F.concat(key, title, F.lit(',"score":NaN}')))
            .when(k % 10 == 2, F.concat(key, F.lit(',"title": }')))
            .when(k % 10 == 3, F.concat(key, F.lit(',"title":{"a":1,"a":2}}')))
            .when(k % 10 == 4, F.concat(key, F.lit(',"title":"x],{\\"y\\"\\\\"}')))
            .when(k % 10 == 5, F.concat(key, F.lit(',"title":null}')))
            .when(k % 10 == 6, F.lit('"notice"'))
            .otherwise(F.concat(key, title, F.lit("}"))))
    e = _ev(spark, sf).withColumn("x", F.concat(F.when(k % PAGE == 0, "").otherwise(", "), item))
    fields = {"id": "bigint", "title": "string", "score": "double"}
    lists, objects = e.where(F.col("page") % 2 == 0), e.where(F.col("page") % 2 == 1)
    rows = S.json_mixed_rows(_pack_text(lists, "x", "[", "]"), fields, keep=["page"]).unionByName(
        S.json_data_rows(_pack_text(objects, "x", '{"data": 1, "data":[', '], "next":{"data":[]}}'), fields, keep=["page"]))
    return rows.select("id", F.col("pos").cast("bigint").alias("pos"), F.coalesce(F.isnan("score"), F.lit(False)).alias("is_nan"), "title")
