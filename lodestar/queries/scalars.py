"""Scalar-function queries (X1-X25) over whole driver tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from lodestar.functions import dates as D
from lodestar.functions import replies as R
from lodestar.functions import text as X
from lodestar.queries import sqlfrag as Q
from lodestar.queries.common import AS_OF_SQL, events_as_of, load, ntz, register

SUFFIXES = [" Inc.", ", LLC", " Ltd", " Corp", " co.", " GmbH", " B.V.", ""]


def _suffixed_names(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = (F.col("c_custkey") % len(SUFFIXES)).cast("int")
    suf = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), k + 1)
    raw = F.concat(F.lower(F.col("c_mktsegment")), F.lit(". "), F.col("c_name"), F.lit("  "), suf)
    return c.select("c_custkey", raw.alias("raw"))


_SUFFIXED_SQL = ("(SELECT c_custkey, lower(c_mktsegment) || '. ' || c_name || '  ' || "
                 "([" + ", ".join(f"'{s}'" for s in SUFFIXES) + f"])[c_custkey % {len(SUFFIXES)} + 1] AS raw "
                 "FROM customer)")


@register("normalize_names", f"SELECT c_custkey, {Q.norm('raw')} AS norm FROM {_SUFFIXED_SQL}")
def q_normalize_names(spark, sf):
    """X1 over every customer name with a legal suffix picked by key."""
    return _suffixed_names(spark, sf).select("c_custkey", X.normalize_name("raw").alias("norm"))


@register("strip_suffix", f"SELECT c_custkey, {Q.self_canon('raw')} AS stripped FROM {_SUFFIXED_SQL}")
def q_strip_suffix(spark, sf):
    """One trailing legal suffix removed (empty result -> raw)."""
    return _suffixed_names(spark, sf).select("c_custkey", X.self_canonical("raw").alias("stripped"))


# ------------------------------------------------------------------ dates
def _rendered(spark, sf, compact_iso: bool):
    e = load(spark, sf, "events").select("event_id", "ts")
    k = F.col("event_id") % 6
    plus2 = F.timestamp_micros(F.unix_micros("ts") + F.lit(2 * 3600 * 10**6))
    minus5 = F.timestamp_micros(F.unix_micros("ts") - F.lit(5 * 3600 * 10**6))
    txt = (F.when(k == 0, F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
           .when(k == 1, F.concat(F.date_format(plus2, "d MMM yyyy HH:mm"), F.lit(" +0200")))
           .when(k == 2, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
           .when(k == 3, F.concat(F.date_format(minus5, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-05:00")))
           .when(k == 4, F.date_format("ts", "yyyyMMdd") if compact_iso
                 else F.unix_seconds("ts").cast("string"))
           .otherwise(F.concat(F.date_format(minus5, "EEE, dd MMM yy HH:mm:ss"), F.lit(" EST"))))
    return e.select("event_id", txt.alias("raw"))


def _expected_sql(compact_iso: bool) -> str:
    k4 = "date_trunc('day', ts)" if compact_iso else "date_trunc('second', ts)"
    return ("SELECT event_id, CASE event_id % 6 WHEN 1 THEN date_trunc('minute', ts) "
            "WHEN 3 THEN date_trunc('millisecond', ts) "
            f"WHEN 4 THEN {k4} ELSE date_trunc('second', ts) END AS parsed FROM events")


@register("parse_dates", _expected_sql(False))
def q_parse_dates(spark, sf):
    """Every event time rendered in one of six formats and parsed back."""
    as_of = events_as_of(spark, sf)
    return _rendered(spark, sf, False).select(
        "event_id", ntz(D.parse_flexible_date("raw", as_of)).alias("parsed"))


@register("parse_dates_no_epoch", _expected_sql(True))
def q_parse_dates_no_epoch(spark, sf):
    """The news variant (no epoch branch; ``yyyyMMdd`` is a date)."""
    as_of = events_as_of(spark, sf)
    return _rendered(spark, sf, True).select(
        "event_id", ntz(D.parse_news_date("raw", as_of)).alias("parsed"))


UNITS = [("second", 1), ("minute", 60), ("hour", 3600), ("day", 86400)]


@register("relative_dates", f"""
WITH a AS (SELECT {AS_OF_SQL} AS as_of),
e AS (SELECT event_id, ts, as_of, ([1, 60, 3600, 86400][event_id % 4 + 1])::BIGINT AS unit FROM events, a),
n AS (SELECT *, (epoch_us(as_of) - epoch_us(ts)) // (unit * 1000000) AS amount FROM e)
SELECT event_id, make_timestamp(epoch_us(as_of) - amount * unit * 1000000) AS parsed FROM n""")
def q_relative_dates(spark, sf):
    """``posted N <unit>s ago`` phrases resolved against as_of."""
    as_of = events_as_of(spark, sf)
    a = D.as_of_lit(as_of)
    e = load(spark, sf, "events").select("event_id", "ts")
    k = (F.col("event_id") % 4).cast("int")
    unit_s = F.element_at(F.array(*[F.lit(s) for _, s in UNITS]), k + 1).cast("bigint")
    unit_n = F.element_at(F.array(*[F.lit(n) for n, _ in UNITS]), k + 1)
    amount = F.floor((F.unix_micros(a) - F.unix_micros("ts")) / (unit_s * F.lit(1000000)))
    txt = F.concat(F.lit("posted "), amount.cast("string"), F.lit(" "), unit_n, F.lit("s ago"))
    return e.select("event_id", ntz(D.relative_date(txt, as_of)).alias("parsed"))


@register("strict_dates", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) "
          "END AS parsed FROM events")
def q_strict_dates(spark, sf):
    """Strict ``yyyy-MM-ddTHH:mm:ssZ``; fractional seconds give null."""
    e = load(spark, sf, "events").select("event_id", "ts")
    txt = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return e.select("event_id", ntz(D.strict_iso_ts(txt)).alias("parsed"))


@register("epoch_year", """
SELECT event_id, CASE WHEN v = 0 THEN NULL ELSE year(make_timestamp(v * 1000000)) END::BIGINT AS year
FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0
             ELSE epoch(date_trunc('second', ts))::BIGINT - user_id * 100000000 END AS v FROM events)""")
def q_epoch_year(spark, sf):
    """UTC year of epoch seconds (0 = missing), including pre-1970 values."""
    e = load(spark, sf, "events")
    v = F.when(F.col("event_id") % 5 == 0, F.lit(0).cast("bigint")) \
        .otherwise(F.unix_seconds("ts") - F.col("user_id") * F.lit(100000000))
    return e.select("event_id", D.epoch_year(v).alias("year"))


# ------------------------------------------------------------------ text
@register("strip_markup", "SELECT page_id, nullif(left(regexp_replace(coalesce(html, ''), "
          "'<[^>]+>', '', 'g'), 2000), '') AS text FROM pages")
def q_strip_markup(spark, sf):
    """X10 over every page: tags removed, cut to 2,000 characters."""
    return load(spark, sf, "pages").select("page_id", X.strip_markup("html").alias("text"))


_GH = ("'https://github.com/' || split_part(url, '/', 3) || '/' || split_part(url, '/', 4) || "
       "CASE page_id % 3 WHEN 0 THEN '/' WHEN 1 THEN '/tree/main' ELSE '' END")


@register("url_parts", f"""
SELECT page_id, string_split(url, '/')[-1] AS tail, split_part(string_split(url, '/')[-1], 'v', 1) AS bare,
  CASE WHEN len(p) >= 2 THEN p[1] END AS owner, CASE WHEN len(p) >= 2 THEN p[2] END AS repo
FROM (SELECT page_id, url, string_split(string_split(rtrim({_GH}, '/'), 'github.com/')[-1], '/') AS p
      FROM pages)""")
def q_url_parts(spark, sf):
    """X12 + X13: url tail, version-less id and owner/repo of a repository url."""
    p = load(spark, sf, "pages").select("page_id", "url")
    gh = F.concat(F.lit("https://github.com/"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("/"),
                  F.split_part("url", F.lit("/"), F.lit(4)),
                  F.element_at(F.array(F.lit("/"), F.lit("/tree/main"), F.lit("")),
                               (F.col("page_id") % 3).cast("int") + 1))
    owner, repo = X.repo_owner_repo(gh)
    tail = X.url_tail("url")
    return p.select("page_id", tail.alias("tail"), X.bare_id(tail).alias("bare"),
                    owner.alias("owner"), repo.alias("repo"))


@register("split_title", """
SELECT c_custkey,
  CASE WHEN strpos(t, ':') > 0 THEN trim(split_part(t, ':', 1)) ELSE 'Unknown' END AS company,
  CASE WHEN strpos(t, ':') > 0 THEN trim(substr(t, strpos(t, ':') + 1)) ELSE trim(t) END AS title
FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name
             ELSE c_mktsegment || ': ' || c_name || ' : lead' END AS t FROM customer)""")
def q_split_title(spark, sf):
    """X11: ``Company: Title`` split at the first colon; no colon -> Unknown."""
    c = load(spark, sf, "customer")
    t = F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")).otherwise(
        F.concat(F.col("c_mktsegment"), F.lit(": "), F.col("c_name"), F.lit(" : lead")))
    company, title = X.split_title(t)
    return c.select("c_custkey", company.alias("company"), title.alias("title"))


@register("array_text", """
SELECT c_custkey, array_to_string(a, '; ') AS authors, array_to_string(list_filter(a, lambda x: x <> ''), ' ') AS tags
FROM (SELECT c_custkey, [c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END,
             'N' || c_nationkey::VARCHAR] AS a FROM customer)""")
def q_array_text(spark, sf):
    """X14 + X15: arrays joined with ``; `` (empties kept) and, after
    dropping empty elements, with a space."""
    c = load(spark, sf, "customer")
    a = F.array(F.col("c_name"),
                F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment")),
                F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
    return c.select("c_custkey", X.array_text(a, "; ").alias("authors"),
                    X.array_text(X.drop_empty(a), " ").alias("tags"))


@register("collapse_space", f"SELECT doc_id, {Q.collapse('text')} AS collapsed FROM documents")
def q_collapse_space(spark, sf):
    """X9 over whole document texts."""
    return load(spark, sf, "documents").select("doc_id", X.collapse_space("text").alias("collapsed"))


@register("token_sort", f"SELECT doc_id, {Q.token_sort(Q.collapse('lower(text)'))} AS sorted "
          "FROM documents")
def q_token_sort(spark, sf):
    """X16 over whole document texts (lower-cased, whitespace-collapsed)."""
    d = load(spark, sf, "documents")
    return d.select("doc_id", X.token_sort(X.collapse_space(F.lower("text"))).alias("sorted"))


@register("truncate_text", """
SELECT doc_id, CASE WHEN length(text) <= 6000 THEN text
       ELSE left(text, 4200) || ' ...[truncated]... ' || right(text, 1781) END AS truncated
FROM documents""")
def q_truncate_text(spark, sf):
    """Head 4,200 + marker + tail 1,781 for texts over 6,000 characters."""
    return load(spark, sf, "documents").select("doc_id", R.truncate_text("text").alias("truncated"))


@register("token_estimate", "SELECT doc_id, (length(text) // 4)::BIGINT AS tokens FROM documents")
def q_token_estimate(spark, sf):
    """Characters // 4."""
    return load(spark, sf, "documents").select("doc_id", R.estimate_tokens("text").alias("tokens"))


@register("build_prompt", """
SELECT doc_id, CASE WHEN length(p) <= 6000 THEN p
       ELSE left(p, 4200) || ' ...[truncated]... ' || right(p, 1781) END AS prompt
FROM (SELECT doc_id, 'Startup name: Doc ' || doc_id::VARCHAR || chr(10) || 'Description: ' ||
             coalesce(nullif(CASE WHEN doc_id % 5 = 0 THEN '' ELSE text END, ''),
                      '(no description available)') AS p FROM documents)""")
def q_build_prompt(spark, sf):
    """X20 + X18: classification prompt per document, truncated to budget."""
    d = load(spark, sf, "documents")
    desc = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("text"))
    p = X.build_prompt(F.concat(F.lit("Doc "), F.col("doc_id").cast("string")), desc)
    return d.select("doc_id", R.truncate_text(p).alias("prompt"))
