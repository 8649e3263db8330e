"""Record, filter, dedupe and resume queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.dates import is_fresh
from lodestar.operators import classify as C
from lodestar.operators import dedupe as W
from lodestar.operators import filters as FL
from lodestar.operators import profile as A
from lodestar.operators import records as P
from lodestar.queries.common import AS_OF_SQL, events_as_of, load, ntz, register

TAG_ORDER = ["view", "click", "signup", "purchase", "error"]
_TAG_SQL = "list_position(['view', 'click', 'signup', 'purchase', 'error'], event_type) - 1"


def _tag_idx():
    return F.array_position(F.array(*[F.lit(t) for t in TAG_ORDER]), F.col("event_type")) - 1


# ------------------------------------------------------------ F3 / A8
def _dated_events(spark, sf):
    e = load(spark, sf, "events")
    return e.withColumn("ts2", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("ts")))


@register("fresh_24h", f"SELECT event_id, ts FROM events WHERE event_id % 7 <> 0 "
          f"AND ts >= {AS_OF_SQL} - INTERVAL 24 HOUR")
def q_fresh_24h(spark, sf):
    """rows dated within 24 h of as_of (undated rows are not fresh)."""
    as_of = events_as_of(spark, sf)
    e = _dated_events(spark, sf)
    return e.where(is_fresh("ts2", as_of)).select("event_id", ntz("ts").alias("ts"))


@register("ingest_funnel", f"""
SELECT event_type, count(*)::BIGINT AS total, count_if(fresh)::BIGINT AS kept,
  count_if(ts2 IS NOT NULL AND NOT fresh)::BIGINT AS stale, count_if(ts2 IS NULL)::BIGINT AS undated,
  (count(*) - count(DISTINCT user_id))::BIGINT AS duplicates
FROM (SELECT *, coalesce(ts2 >= {AS_OF_SQL} - INTERVAL 24 HOUR, false) AS fresh
      FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts2 FROM events))
GROUP BY event_type""")
def q_ingest_funnel(spark, sf):
    """Per source: total, kept, stale, undated and duplicate keys, one pass."""
    as_of = events_as_of(spark, sf)
    e = _dated_events(spark, sf).withColumn("fresh", is_fresh("ts2", as_of))
    f = A.funnel(e, "event_type", {"kept": F.col("fresh"),
                                   "stale": F.col("ts2").isNotNull() & ~F.col("fresh"),
                                   "undated": F.col("ts2").isNull()})
    d = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("__u__"))
    return (f.join(d, "event_type")
            .select("event_type", F.col("total").cast("bigint"), F.col("kept").cast("bigint"),
                    F.col("stale").cast("bigint"), F.col("undated").cast("bigint"),
                    (F.col("total") - F.col("__u__")).cast("bigint").alias("duplicates")))


# ------------------------------------------------------------ F2 / F4 / F1 / V1
PART_KEYWORDS = ["anvil", " hot ", "promo", "l gear"]


@register("keyword_filter", "SELECT p_partkey FROM part WHERE " + " OR ".join(
    f"contains(' ' || concat_ws(' ', nullif(lower(p_name), ''), nullif(lower(p_type), '')) || ' ', '{k}')"
    for k in PART_KEYWORDS))
def q_keyword_filter(spark, sf):
    """padded, lower-cased title + tags substring test."""
    p = load(spark, sf, "part")
    return p.where(FL.keyword_match([F.col("p_name"), F.col("p_type")], PART_KEYWORDS)).select("p_partkey")


def _repo_cols(o):
    pr = F.col("o_orderpriority")
    name = F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("/"),
                    F.when(pr == "1-URGENT", F.concat(F.lit("awesome-list-"), F.col("o_orderkey").cast("string")))
                    .when(pr == "2-HIGH", F.lit("ml_papers"))
                    .otherwise(F.concat(F.lit("repo"), F.col("o_orderkey").cast("string"))))
    desc = F.when(F.col("o_orderstatus") == "F", F.lit("Daily-Paper digest"))
    return name, desc


_REPO_NAME_SQL = ("'u' || o_custkey::VARCHAR || '/' || CASE o_orderpriority "
                  "WHEN '1-URGENT' THEN 'awesome-list-' || o_orderkey::VARCHAR "
                  "WHEN '2-HIGH' THEN 'ml_papers' ELSE 'repo' || o_orderkey::VARCHAR END")
_REPO_DESC_SQL = "CASE WHEN o_orderstatus = 'F' THEN 'Daily-Paper digest' END"


def _agg_sql(name, desc):
    from lodestar.queries.sqlfrag import kw_any
    from lodestar.schemas import AGGREGATOR_KEYWORDS
    hay = f"(lower(coalesce({name}, '')) || ' ' || lower(coalesce({desc}, '')))"
    return kw_any(hay, AGGREGATOR_KEYWORDS)


@register("aggregator_flag", f"SELECT o_orderkey, {_agg_sql(_REPO_NAME_SQL, _REPO_DESC_SQL)} AS is_aggregator "
          "FROM orders")
def q_aggregator_flag(spark, sf):
    """list/digest repository test over name + description."""
    o = load(spark, sf, "orders")
    name, desc = _repo_cols(o)
    return o.select("o_orderkey", FL.is_aggregator(name, desc).alias("is_aggregator"))


@register("required_fields", """
SELECT event_id, title, url FROM (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE event_type END AS title,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE 'u' || event_id::VARCHAR END AS url FROM events)
WHERE title IS NOT NULL AND title <> '' AND url IS NOT NULL AND url <> ''""")
def q_required_fields(spark, sf):
    """null and empty identity / link reject the row."""
    e = load(spark, sf, "events")
    t = F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("event_id") % 5 == 1, F.lit("")) \
        .otherwise(F.col("event_type"))
    u = F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), F.col("event_id").cast("string")))
    return P.require(e.select("event_id", t.alias("title"), u.alias("url")), "title", "url")


def _job_like(spark, sf):
    e = load(spark, sf, "events")
    eid = F.col("event_id")
    content = P.content_struct(
        "JOB", title=F.col("event_type"),
        company=F.when(eid % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("user_id").cast("string"))),
        date=F.when(eid % 13 == 0, F.lit(None)).otherwise(F.col("ts")))
    url = F.when(eid % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), eid.cast("string")))
    return e.select("event_id", *P.envelope("JOB", "events", url, F.col("ts"), content))


@register("validate_quarantine", """
SELECT event_id, v AS violations FROM (
  SELECT event_id, concat_ws(',', CASE WHEN event_id % 17 = 0 THEN 'source.url:missing' END,
     CASE WHEN event_id % 11 = 0 THEN 'content.company:missing' END,
     CASE WHEN event_id % 13 = 0 THEN 'content.date:missing' END) AS v FROM events)
WHERE v <> ''""")
def q_validate_quarantine(spark, sf):
    """V1: rows failing the JOB schema go to quarantine with their codes."""
    _, bad = P.split_valid(_job_like(spark, sf), "JOB")
    return bad.select("event_id", F.array_join("violations", ",").alias("violations"))


# ------------------------------------------------------------ W1 / W4 / W3 / S11
def _companies_from_events(spark, sf):
    e = load(spark, sf, "events")
    eid = F.col("event_id")
    return e.select(
        F.when(eid % 50 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("id"),
        "event_id", _tag_idx().alias("tag_idx"),
        F.when(eid % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("n"), eid.cast("string"))).alias("name"),
        F.concat(F.lit("u"), eid.cast("string")).alias("url"))


@register("first_wins_dedupe", f"""
SELECT id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY tag_idx, event_id) AS rn FROM (
    SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS id, event_id,
           {_TAG_SQL} AS tag_idx FROM events WHERE event_id % 9 <> 0))
WHERE id IS NULL OR rn = 1""")
def q_first_wins_dedupe(spark, sf):
    """First valid row per id in tag order; null ids never deduped;
    invalid rows (no name) do not claim their id."""
    c = P.require(_companies_from_events(spark, sf), "name", "url")
    return W.first_wins(c, "id", ["tag_idx", "event_id"]).select("id", "event_id")


@register("category_dedupe", f"""
SELECT k, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY cat_idx, event_id // 100, event_id) AS rn FROM (
    SELECT user_id::VARCHAR || '-' || (floor(value)::BIGINT % 5)::VARCHAR AS k, event_id,
           {_TAG_SQL} AS cat_idx FROM events)) WHERE rn = 1""")
def q_category_dedupe(spark, sf):
    """One row per paper key across categories, first category wins."""
    e = load(spark, sf, "events")
    k = F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.floor("value").cast("bigint") % 5).cast("string"))
    d = e.select(k.alias("k"), "event_id", _tag_idx().alias("cat_idx"),
                 F.floor(F.col("event_id") / 100).alias("page"))
    return W.cross_group_dedupe(d, "k", ["cat_idx", "page", "event_id"]).select("k", "event_id")


# The first empty page: three quarters through the pages, whatever their number.
_EMPTY_PAGE_SQL = "(SELECT max(event_id // 100) * 3 // 4 FROM events)"
PAGE_TOTAL = 100


def _pages(spark, sf):
    """(items, page sizes): one page of every category is listed as empty."""
    e = load(spark, sf, "events").select("event_type", "event_id",
                                         F.floor(F.col("event_id") / 100).cast("bigint").alias("page"))
    empty = e.agg(F.floor(F.max("page") * 3 / 4).cast("bigint")).scalar()
    sizes = (e.groupBy("event_type", "page").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("n", F.when(F.col("page") == empty, F.lit(0)).otherwise(F.col("n"))))
    return e.where(F.col("page") != empty), sizes


@register("capped_pages", f"""
SELECT event_type, event_id FROM (
  SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id // 100, event_id) rn
  FROM events WHERE event_id // 100 < {_EMPTY_PAGE_SQL}) WHERE rn <= {PAGE_TOTAL}""")
def q_capped_pages(spark, sf):
    """S11 + W3: pages read in order until the first empty page or the first
    100 rows of the category, whichever comes first."""
    items, sizes = _pages(spark, sf)
    return W.cut_pages(items, "event_type", "page", "event_id", PAGE_TOTAL, sizes).select("event_type", "event_id")


@register("pages_until_empty", f"SELECT event_type, event_id FROM events WHERE event_id // 100 < {_EMPTY_PAGE_SQL}")
def q_pages_until_empty(spark, sf):
    """All rows of the pages before the first empty page."""
    items, sizes = _pages(spark, sf)
    return W.cut_pages(items, "event_type", "page", "event_id", None, sizes).select("event_type", "event_id")


# ------------------------------------------------------------ J1 / J2 / A10
def _versioned(spark, sf):
    e = load(spark, sf, "events")
    new = e.select("event_id", F.concat(F.lit("2401."), F.col("event_id").cast("string"), F.lit("v1")).alias("arxiv_id"))
    done = e.where(F.col("event_id") % 3 == 0).select(
        F.concat(F.lit("2401."), F.col("event_id").cast("string"),
                 F.when(F.col("event_id") % 2 == 0, F.lit("v1")).otherwise(F.lit("v2"))).alias("arxiv_id"))
    return new, done


@register("resume_anti", """
SELECT event_id FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events d WHERE d.event_id % 3 = 0
    AND '2401.' || d.event_id::VARCHAR || CASE WHEN d.event_id % 2 = 0 THEN 'v1' ELSE 'v2' END
        = '2401.' || e.event_id::VARCHAR || 'v1')""")
def q_resume_anti(spark, sf):
    """New papers minus those already in the sink (versions differ)."""
    new, done = _versioned(spark, sf)
    return W.resume_anti(new, done, "arxiv_id").select("event_id")


def _urls(spark, sf):
    e = load(spark, sf, "events")
    new = e.select("event_id", F.when(F.col("event_id") % 10 == 0, F.lit(None))
                   .otherwise(F.concat(F.lit("u"), F.col("event_id").cast("string"))).alias("url"))
    done = e.where(F.col("event_id") % 3 == 0).select(
        F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit("u"), F.col("event_id").cast("string"))).alias("url"))
    return new, done


_DONE_URLS = ("(SELECT CASE WHEN event_id % 4 = 0 THEN '' ELSE 'u' || event_id::VARCHAR END AS url "
              "FROM events WHERE event_id % 3 = 0)")


@register("resume_null_keys", f"""
SELECT event_id FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'u' || event_id::VARCHAR END AS url
                      FROM events) n
WHERE url IS NULL OR url NOT IN (SELECT url FROM {_DONE_URLS} WHERE url <> '')""")
def q_resume_null_keys(spark, sf):
    """Skip finished urls; null urls are never finished; empty done keys
    are ignored."""
    new, done = _urls(spark, sf)
    return W.resume_anti(new, done, "url").select("event_id")


@register("seen_keys", f"SELECT DISTINCT url AS k FROM {_DONE_URLS} WHERE url <> ''")
def q_seen_keys(spark, sf):
    """A10: distinct non-empty keys already in the sink."""
    _, done = _urls(spark, sf)
    return W.seen_keys(done, "url").select(F.col("__k__").alias("k"))


# ------------------------------------------------------------ U1 / L1 / F6
@register("union_sources", """
SELECT 'customers' AS source, c_name AS name FROM customer
UNION ALL SELECT 'suppliers', s_name FROM supplier
UNION ALL SELECT 'parts', p_name FROM part""")
def q_union_sources(spark, sf):
    """Bag union of three sources by name."""
    c = load(spark, sf, "customer").select(F.lit("customers").alias("source"), F.col("c_name").alias("name"))
    s = load(spark, sf, "supplier").select(F.lit("suppliers").alias("source"), F.col("s_name").alias("name"))
    p = load(spark, sf, "part").select(F.lit("parts").alias("source"), F.col("p_name").alias("name"))
    return c.unionByName(s).unionByName(p)


@register("limit_before_skip", "SELECT c_custkey FROM (SELECT c_custkey FROM customer ORDER BY c_custkey "
          "LIMIT 500) WHERE c_custkey % 3 <> 0")
def q_limit_before_skip(spark, sf):
    """L1 + J2: the first 500 inputs are taken before finished ones are skipped."""
    c = load(spark, sf, "customer").select("c_custkey")
    done = c.where(F.col("c_custkey") % 3 == 0)
    return W.resume_anti(FL.limit_first(c, 500, [F.col("c_custkey")]), done, "c_custkey")


NAMED = ["blue anvil", "hot rod", "Small Ring"]


@register("named_lookup", "SELECT p_partkey, p_name, p_type FROM part WHERE p_name IN ("
          + ", ".join(f"'{n}'" for n in NAMED) + ")")
def q_named_lookup(spark, sf):
    """exact, case-sensitive lookup of named records."""
    return FL.named_lookup(load(spark, sf, "part"), "p_name", NAMED, ["p_partkey", "p_name", "p_type"])


# ------------------------------------------------------------ P1 / P2 / P8 / P7
def companies(spark, sf):
    """Company payload rows derived from ``customer``."""
    c = load(spark, sf, "customer")
    k = F.col("c_custkey")
    seg = F.lower("c_mktsegment")
    return c.select(
        k.alias("id"), F.lit(0).alias("tag_idx"), k.alias("pos"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("https://example.com/c/"), k.cast("string"))).alias("url"),
        F.concat(seg, F.lit(" tools")).alias("one_liner"),
        F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.concat(F.lit("Free API for businesses in "), seg))
        .otherwise(F.lit("Premium subscription app for consumers")).alias("long_description"),
        F.concat(F.lit("https://"), seg, F.lit(".example")).alias("website"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))).alias("all_locations"),
        F.col("c_mktsegment").alias("industry"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).cast("bigint").alias("team_size"),
        F.when(k % 5 == 0, F.lit(0)).otherwise((F.col("c_acctbal") * 100000).cast("bigint")).alias("launched_at"))


COMPANIES_SQL = """(SELECT c_custkey AS id,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS name,
  CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'https://example.com/c/' || c_custkey::VARCHAR END AS url,
  lower(c_mktsegment) || ' tools' AS one_liner,
  CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Free API for businesses in ' || lower(c_mktsegment)
       ELSE 'Premium subscription app for consumers' END AS long_description,
  'https://' || lower(c_mktsegment) || '.example' AS website,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'NATION_' || c_nationkey::VARCHAR END AS all_locations,
  c_mktsegment AS industry,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey END::BIGINT AS team_size,
  CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE (c_acctbal * 100000)::BIGINT END AS launched_at
FROM customer)"""

STARTUPS_SQL = f"""(SELECT '1.0' AS schemaVersion, 'STARTUP' AS recordType,
  'Y Combinator (via yc-oss.github.io)' AS source_name, url AS source_url,
  name AS content_entityName, name AS content_rawName,
  coalesce(nullif(long_description, ''), nullif(one_liner, '')) AS content_description,
  website AS content_website, team_size AS content_data_employeeCount,
  CASE WHEN launched_at = 0 OR launched_at IS NULL THEN NULL
       ELSE year(make_timestamp((launched_at // 86400) * 86400000000)) END::BIGINT AS content_data_foundedYear,
  nullif(all_locations, '') AS content_data_hq, industry AS content_data_industry,
  {AS_OF_SQL} AS collectedAt
FROM {COMPANIES_SQL} WHERE name IS NOT NULL AND name <> '' AND url IS NOT NULL AND url <> '')"""


def startups(spark, sf):
    return P.startup_records(companies(spark, sf), events_as_of(spark, sf))


def underscored(flat):
    return flat.select(*[(ntz(F.col(f"`{c}`")) if c == "collectedAt" else F.col(f"`{c}`"))
                         .alias(c.replace(".", "_")) for c in flat.columns])


@register("startup_records", f"SELECT * FROM {STARTUPS_SQL}")
def q_startup_records(spark, sf):
    """P1 + P6 + P7: company rows -> STARTUP envelope -> flat columns."""
    return underscored(P.flatten(startups(spark, sf), "startups"))


def _rules_sql(x):
    def m(p):
        return f"regexp_matches({x}, '{p}')"
    return (f"CASE WHEN {m(C.FREE_CUES)} AND {m(C.PAID_CUES)} THEN 'FREEMIUM' "
            f"WHEN {m(C.FREE_CUES)} THEN 'FREE' WHEN {m(C.B2B_CUES)} THEN 'ENTERPRISE' "
            f"WHEN {m(C.PAID_CUES)} OR {m(C.CONSUMER_CUES)} THEN 'PAID' ELSE 'UNKNOWN' END")


PRODUCTS_SQL = f"""(SELECT '1.0' AS schemaVersion, 'PRODUCT' AS recordType, source_name, source_url,
  content_entityName AS content_startupName, content_rawName AS content_rawStartupName,
  content_entityName AS content_productName,
  {_rules_sql("lower(coalesce(content_description, ''))")} AS content_pricingModel,
  content_description, content_website, collectedAt FROM {STARTUPS_SQL})"""


@register("product_records", f"SELECT * FROM {PRODUCTS_SQL}")
def q_product_records(spark, sf):
    """P2 + C3: one PRODUCT per STARTUP with the rule-tier pricing class."""
    s = startups(spark, sf).withColumn("pricingModel", C.pricing_rules(F.col("content.description")))
    return underscored(P.flatten(P.product_records(s), "products"))


@register("nested_update", f"SELECT source_url, upper(content_entityName) AS entityName, "
          f"content_rawName AS rawName FROM {STARTUPS_SQL}")
def q_nested_update(spark, sf):
    """Overwrite ``content.entityName`` in place, other fields intact."""
    s = P.set_nested(startups(spark, sf), "content.entityName", F.upper(F.col("content.entityName")))
    return s.select(F.col("source.url").alias("source_url"), F.col("content.entityName").alias("entityName"),
                    F.col("content.rawName").alias("rawName"))


@register("pricing_rules", f"SELECT doc_id, {_rules_sql('lower(coalesce(text, ' + chr(39) * 2 + '))')} "
          "AS pricingModel FROM documents")
def q_pricing_rules(spark, sf):
    """The deterministic rule tier over whole document texts."""
    d = load(spark, sf, "documents")
    return d.select("doc_id", C.pricing_rules("text").alias("pricingModel"))
