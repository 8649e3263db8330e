"""Reply-parsing and classification queries: model replies are planted from
``conversations`` (record = conversation, tier = turn)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import replies as R
from lodestar.operators import classify as C
from lodestar.queries.common import load, register

WORDS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE", "UNKNOWN"]


def tier_responses(spark, sf):
    c = load(spark, sf, "conversations")
    k = (F.col("conv_id") + F.col("turn")) % 7
    status = F.when(k == 0, 429).when(k == 1, 500).when(k == 2, 401).when(k == 3, 413).otherwise(200)
    word = F.element_at(F.array(*[F.lit(w) for w in WORDS]), (F.length("text") % 5).cast("int") + 1)
    b = (F.col("conv_id") * 3 + F.col("turn")) % 6
    body = (F.when(b == 0, F.concat(F.lit("```json\n{\"pricingModel\": \""), F.lower(word), F.lit("\"}\n```")))
            .when(b == 1, F.concat(F.lit("{\"pricingModel\":\""), word, F.lit("\"}")))
            .when(b == 2, F.concat(F.lit("not json: "), F.col("text")))
            .when(b == 3, F.lit("[]"))
            .when(b == 4, F.lit("{\"pricingModel\":\"GRATIS\"}"))
            .otherwise(F.concat(F.lit("  ```{\"pricingModel\": \""), word, F.lit("\"}```  "))))
    ra = F.when(F.col("turn") % 3 == 0, F.col("conv_id").cast("string")) \
        .when(F.col("turn") % 3 == 1, F.lit(" 2.5 ")).otherwise(F.lit("soon"))
    return c.select(F.col("conv_id").cast("string").alias("record_key"),
                    F.col("turn").cast("int").alias("tier_idx"), status.cast("int").alias("status"),
                    ra.alias("retry_after"), body.alias("body"))


_REPLIES = """(SELECT conv_id::VARCHAR AS record_key, turn::INTEGER AS tier_idx,
  CASE (conv_id + turn) % 7 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 401 WHEN 3 THEN 413 ELSE 200 END AS status,
  CASE turn % 3 WHEN 0 THEN conv_id::VARCHAR WHEN 1 THEN ' 2.5 ' ELSE 'soon' END AS retry_after,
  CASE (conv_id * 3 + turn) % 6
    WHEN 0 THEN '```json' || chr(10) || '{"pricingModel": "' || lower(w) || '"}' || chr(10) || '```'
    WHEN 1 THEN '{"pricingModel":"' || w || '"}'
    WHEN 2 THEN 'not json: ' || text
    WHEN 3 THEN '[]'
    WHEN 4 THEN '{"pricingModel":"GRATIS"}'
    ELSE '  ```{"pricingModel": "' || w || '"}```  ' END AS body
FROM (SELECT *, (['FREE', 'FREEMIUM', 'PAID', 'ENTERPRISE', 'UNKNOWN'])[length(text) % 5 + 1] AS w
      FROM conversations))"""

_WS = "' ' || chr(9) || chr(10) || chr(13)"
_UNFENCE = (f"CASE WHEN starts_with(trim(body, {_WS}), '```') THEN "
            f"trim(regexp_replace(regexp_replace(trim(body, {_WS}), '^`+|`+$', '', 'g'), '^json', ''), {_WS}) "
            f"ELSE trim(body, {_WS}) END")
_OK = f"(status = 200 AND json_valid({_UNFENCE}))"
_ENUM = ("CASE WHEN upper(json_extract_string({x}, '$.pricingModel')) IN "
         "('FREE', 'FREEMIUM', 'PAID', 'ENTERPRISE', 'UNKNOWN') "
         "THEN upper(json_extract_string({x}, '$.pricingModel')) ELSE 'UNKNOWN' END")


@register("unfence_reply", f"SELECT record_key, tier_idx, {_UNFENCE} AS unfenced FROM {_REPLIES}")
def q_unfence_reply(spark, sf):
    """Strip code fences and a ``json`` tag from model replies."""
    t = tier_responses(spark, sf)
    return t.select("record_key", "tier_idx", R.unfence_reply("body").alias("unfenced"))


@register("parse_reply", f"SELECT record_key, tier_idx, {_ENUM.format(x=_UNFENCE)} AS pricingModel "
          f"FROM {_REPLIES} WHERE json_valid({_UNFENCE})")
def q_parse_reply(spark, sf):
    """Parseable replies -> enum value (unknown values -> UNKNOWN)."""
    t = tier_responses(spark, sf).withColumn("v", R.parse_reply("body"))
    return t.where(F.col("v").isNotNull()).select("record_key", "tier_idx",
                                                  R.reply_field_enum(F.col("v")).alias("pricingModel"))


@register("outcome_class", f"""SELECT record_key, tier_idx, status,
  CASE WHEN status = 200 THEN 'ok' WHEN status = 429 THEN 'retryable' WHEN status >= 500 THEN 'retryable'
       ELSE 'permanent' END AS outcome,
  TRY_CAST(trim(retry_after, {_WS}) AS DOUBLE) AS retry_after_s FROM {_REPLIES}""")
def q_outcome_class(spark, sf):
    """X24 + X25: response outcome class and numeric Retry-After."""
    t = tier_responses(spark, sf)
    return t.select("record_key", "tier_idx", "status", R.outcome_class("status").alias("outcome"),
                    R.retry_after_seconds("retry_after").alias("retry_after_s"))


_FIRST = f"""(SELECT record_key, tier_idx, body AS reply FROM (
  SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY tier_idx) rn FROM {_REPLIES} WHERE {_OK})
  WHERE rn = 1)"""


@register("first_success", f"SELECT * FROM {_FIRST}")
def q_first_success(spark, sf):
    """Per record, the lowest tier with an ok, parseable reply."""
    return C.first_success(tier_responses(spark, sf)).select("record_key", "tier_idx", "reply")


_UNF_REPLY = _UNFENCE.replace("body", "reply")


@register("pricing_from_replies", f"""
SELECT r.record_key, coalesce({_ENUM.format(x=_UNF_REPLY)}, 'UNKNOWN') AS pricingModel
FROM (SELECT DISTINCT conv_id::VARCHAR AS record_key FROM conversations) r
LEFT JOIN {_FIRST} f ON f.record_key = r.record_key""")
def q_pricing_from_replies(spark, sf):
    """Pricing class from the first successful tier, else UNKNOWN."""
    recs = load(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("record_key")).distinct()
    out = C.pricing_from_replies(recs, tier_responses(spark, sf))
    return out.select("record_key", "pricingModel")


@register("product_build", None)
def q_product_build(spark, sf):
    """C4: limit -> skip finished -> prompt -> first successful tier, else
    the rule tier -> PRODUCT records (replies keyed by source url)."""
    from lodestar.operators.records import flatten
    from lodestar.queries.records import startups, underscored
    s = startups(spark, sf)
    done = s.where(F.substring_index(F.col("source.url"), "/", -1).cast("bigint") % 4 == 0)
    rep = tier_responses(spark, sf).withColumn(
        "record_key", F.concat(F.lit("https://example.com/c/"), F.col("record_key")))
    out = C.build_products(s, done=done, replies=rep)
    return underscored(flatten(out, "products"))


def _by_length(todo):
    """A classifier that fails on every third document and judges by the length it is shown."""
    ok = F.col("record_key") % 3 != 0
    kind = F.when(F.length("prompt") % 2 == 0, F.lit("free")).otherwise(F.lit("PAID"))
    return todo.select("record_key", F.when(ok, 200).otherwise(503).alias("status"),
                       F.concat(F.lit('{"pricingModel": "'), kind, F.lit('"}')).alias("body"))


def _enterprise(todo):
    """A classifier whose replies to every fifth document are no JSON."""
    good = F.col("record_key") % 5 != 0
    return todo.select("record_key", F.lit(200).alias("status"),
                       F.when(good, F.lit('{"pricingModel": "ENTERPRISE"}')).otherwise(F.lit("no idea")).alias("body"))


@register("classifier_tiers", """
SELECT doc_id,
  CASE WHEN doc_id % 3 <> 0 THEN CASE WHEN least(length(coalesce(text, '')), 200) % 2 = 0 THEN 'FREE' ELSE 'PAID' END
       WHEN doc_id % 5 <> 0 THEN 'ENTERPRISE' ELSE 'UNKNOWN' END AS pricingModel,
  CASE WHEN doc_id % 3 <> 0 THEN 0 WHEN doc_id % 5 <> 0 THEN 1 END AS tier_idx
FROM documents""")
def q_classifier_tiers(spark, sf):
    """The caller's classifiers as a chain, the first with a budget of 200 characters."""
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("record_key"), F.col("text").alias("prompt"))
    answers = C.run_tiers(d, [C.Tier(_by_length, 200), C.Tier(_enterprise)])
    model = R.reply_field_enum(R.parse_reply(F.col("reply")))
    return (d.join(answers, "record_key", "left")
            .select(F.col("record_key").alias("doc_id"), F.coalesce(model, F.lit("UNKNOWN")).alias("pricingModel"), "tier_idx"))


def _product_build_sql():
    from lodestar.queries.records import STARTUPS_SQL, _rules_sql
    return f"""
WITH s AS {STARTUPS_SQL}, f AS {_FIRST}
SELECT '1.0' AS schemaVersion, 'PRODUCT' AS recordType, source_name, source_url,
  content_entityName AS content_startupName, content_rawName AS content_rawStartupName,
  content_entityName AS content_productName,
  coalesce(CASE WHEN f.reply IS NOT NULL THEN {_ENUM.format(x=_UNF_REPLY)} END,
           {_rules_sql("lower(coalesce(content_description, ''))")}) AS content_pricingModel,
  content_description, content_website, collectedAt
FROM s LEFT JOIN f ON 'https://example.com/c/' || f.record_key = s.source_url
WHERE NOT (split_part(source_url, '/', -1)::BIGINT % 4 = 0)"""


from lodestar.queries.common import ORACLES as _O  # noqa: E402
_O["product_build"] = _product_build_sql()
