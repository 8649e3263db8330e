"""Resolution queries: seed = part names by a membership rule, raw names =
every part row with a case / suffix / word-swap / dropped-letter / extra-token
variant chosen by key; second record type = supplier names."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators.filters import head_sample, seed_matched
from lodestar.operators.profile import frequency
from lodestar.operators.resolve import mapping_log, resolve
from lodestar.operators.resolve_kept import refresh, resolve_kept
from lodestar.queries import sqlfrag as Q
from lodestar.queries.common import load, register
from lodestar.session import scratch_path


def part_seed(spark, sf):
    """Seed: distinct part names whose first character code is even;
    canonical = first letter upper-cased; aliases = ``<name> Inc`` and the
    hyphenated name.  Order key = the name itself."""
    p = load(spark, sf, "part").select("p_name").where(F.col("p_name").isNotNull()).distinct()
    p = p.where(F.ascii("p_name") % 2 == 0)
    canon = F.concat(F.upper(F.substr("p_name", F.lit(1), F.lit(1))), F.substr("p_name", F.lit(2)))
    return p.select(F.col("p_name").alias("seed_idx"), canon.alias("canonical"),
                    F.array(F.concat(F.col("p_name"), F.lit(" Inc")),
                            F.regexp_replace("p_name", " ", "-")).alias("aliases"))


def raw_part_names(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    w = F.split("p_name", " ")
    k = F.col("p_partkey") % 6
    raw = (F.when(k == 0, F.col("p_name"))
           .when(k == 1, F.concat(F.upper("p_name"), F.lit(", Inc.")))
           .when(k == 2, F.concat_ws(" ", F.get(w, 1), F.get(w, 0)))
           .when(k == 3, F.concat(F.substr("p_name", F.lit(1), F.lit(1)), F.substr("p_name", F.lit(3))))
           .when(k == 4, F.concat(F.upper(F.substr("p_name", F.lit(1), F.lit(1))),
                                  F.substr("p_name", F.lit(2)), F.lit(" Corp.")))
           .otherwise(F.concat(F.col("p_name"), F.lit(" x"))))
    return p.select("p_partkey", raw.alias("raw_name"))


def resolved_parts(spark, sf):
    return resolve(raw_part_names(spark, sf), "raw_name", part_seed(spark, sf))


def full_log(spark, sf):
    parts = resolved_parts(spark, sf)
    sup = load(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("raw_name"))
    sup = resolve(sup, "raw_name", part_seed(spark, sf))
    a = mapping_log(parts, "STARTUP", "raw_name",
                    F.concat(F.lit("https://example.com/part/"), F.col("p_partkey").cast("string")))
    b = mapping_log(sup, "PRODUCT", "raw_name",
                    F.concat(F.lit("https://example.com/supplier/"), F.col("s_suppkey").cast("string")))
    return a.unionByName(b)


# ----------------------------------------------------------------- oracle SQL
_SEED = """seed AS (
  SELECT p_name AS seed_idx, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS canonical,
         [p_name || ' Inc', replace(p_name, ' ', '-')] AS aliases
  FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL) WHERE ascii(p_name) % 2 = 0
), forms AS (
  SELECT seed_idx, canonical, pos - 1 AS form_pos, ([canonical] || aliases)[pos] AS form
  FROM seed, range(1, 4) r(pos)
), nforms AS (
  SELECT *, {norm_form} AS norm FROM forms
), nforms2 AS (SELECT *, {ts_form} AS sorted_norm FROM nforms),
exact AS (
  SELECT norm, canonical FROM (
    SELECT norm, canonical, row_number() OVER (PARTITION BY norm ORDER BY seed_idx DESC, form_pos DESC) rn
    FROM nforms) WHERE rn = 1
)""".format(norm_form=Q.norm("form"), ts_form=Q.token_sort("norm"))

_RAW = """raw AS (
  SELECT p_partkey,
    CASE p_partkey % 6
      WHEN 0 THEN p_name
      WHEN 1 THEN upper(p_name) || ', Inc.'
      WHEN 2 THEN concat_ws(' ', split_part(p_name, ' ', 2), split_part(p_name, ' ', 1))
      WHEN 3 THEN substr(p_name, 1, 1) || substr(p_name, 3)
      WHEN 4 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' Corp.'
      ELSE p_name || ' x' END AS raw_name
  FROM part
)"""


def _resolve_sql(src: str, key: str) -> str:
    """Full resolution of ``src(key, raw_name)`` against ``nforms2``/``exact``."""
    return """names AS (
  SELECT DISTINCT {norm_raw} AS norm FROM {src} WHERE raw_name IS NOT NULL
), rest AS (
  SELECT norm FROM names WHERE norm NOT IN (SELECT norm FROM exact)
), qs AS (SELECT norm, {ts_q} AS q FROM rest),
pairs AS (
  SELECT qs.norm, f.canonical, f.seed_idx, f.form_pos,
         length(qs.q) + length(f.sorted_norm) AS total,
         {lcs} AS l
  FROM qs, nforms2 f
  WHERE 100 * abs(length(qs.q) - length(f.sorted_norm)) <= 10 * (length(qs.q) + length(f.sorted_norm))
    AND levenshtein(qs.q, f.sorted_norm) <= ((length(qs.q) + length(f.sorted_norm)) * 10) // 100
), scored AS (
  SELECT *, total - 2 * l AS indel,
         CASE WHEN total = 0 THEN 100.0 ELSE (1.0 - (total - 2 * l)::DOUBLE / total) * 100.0 END AS score
  FROM pairs
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY score DESC, seed_idx, form_pos) rn
                 FROM scored) WHERE rn = 1 AND 100 * indel <= 10 * total
), mm AS (
  SELECT norm, canonical, 'exact_seed_match' AS method, 100.0 AS confidence FROM exact
  UNION ALL SELECT norm, canonical, 'fuzzy_seed_match', score FROM best
), resolved AS (
  SELECT s.{key}, s.raw_name,
         coalesce(mm.canonical, {self_raw}) AS canonical_name,
         coalesce(mm.method, 'no_seed_match') AS method,
         coalesce(mm.confidence, 0.0)::DOUBLE AS confidence
  FROM {src} s LEFT JOIN mm ON mm.norm = {norm_s}
)""".format(src=src, key=key, norm_raw=Q.norm("raw_name"), ts_q=Q.token_sort("norm"),
            lcs=Q.lcs("qs.q", "f.sorted_norm"), self_raw=Q.self_canon("s.raw_name"),
            norm_s=Q.norm("s.raw_name"))


RESOLVE_FULL_SQL = f"WITH {_SEED}, {_RAW}, {_resolve_sql('raw', 'p_partkey')} SELECT * FROM resolved"
_LOG_SQL = (f"WITH {_SEED}, {_RAW}, {_resolve_sql('raw', 'p_partkey')}, "
            f"sup AS (SELECT s_suppkey, s_name AS raw_name FROM supplier), "
            f"{_resolve_sql('sup', 's_suppkey').replace('names AS', 'names2 AS').replace('FROM names', 'FROM names2').replace('rest AS', 'rest2 AS').replace('FROM rest', 'FROM rest2').replace('qs AS', 'qs2 AS').replace('FROM qs,', 'FROM qs2 qs,').replace('pairs AS', 'pairs2 AS').replace('FROM pairs', 'FROM pairs2').replace('scored AS', 'scored2 AS').replace('FROM scored', 'FROM scored2').replace('best AS', 'best2 AS').replace('FROM best', 'FROM best2').replace('mm AS', 'mm2 AS').replace('JOIN mm ON mm.', 'JOIN mm2 mm ON mm.').replace('resolved AS', 'resolved2 AS')}, "
            "log AS ("
            "SELECT 'STARTUP' AS entityType, raw_name AS rawName, canonical_name AS canonicalName, method, "
            "confidence, 'https://example.com/part/' || p_partkey::VARCHAR AS sourceUrl FROM resolved "
            "UNION ALL SELECT 'PRODUCT', raw_name, canonical_name, method, confidence, "
            "'https://example.com/supplier/' || s_suppkey::VARCHAR FROM resolved2)")


@register("resolve_full", RESOLVE_FULL_SQL)
def q_resolve_full(spark, sf):
    """J5 over every part row: exact, then fuzzy, then self canonical."""
    return resolved_parts(spark, sf).select("p_partkey", "raw_name", "canonical_name", "method",
                                            "confidence")


@register("resolve_exact", f"WITH {_SEED}, {_RAW}, {_resolve_sql('raw', 'p_partkey')} "
          "SELECT p_partkey, raw_name, canonical_name FROM resolved WHERE method = 'exact_seed_match'")
def q_resolve_exact(spark, sf):
    """Rows resolved by the exact normalised lookup."""
    r = resolved_parts(spark, sf)
    return r.where(F.col("method") == "exact_seed_match").select("p_partkey", "raw_name", "canonical_name")


@register("resolve_fuzzy", f"WITH {_SEED}, {_RAW}, {_resolve_sql('raw', 'p_partkey')} "
          "SELECT p_partkey, raw_name, canonical_name, confidence FROM resolved "
          "WHERE method = 'fuzzy_seed_match'")
def q_resolve_fuzzy(spark, sf):
    """Rows resolved by the fuzzy top-1 (token-sort ratio >= 90)."""
    r = resolved_parts(spark, sf)
    return r.where(F.col("method") == "fuzzy_seed_match").select(
        "p_partkey", "raw_name", "canonical_name", "confidence")


@register("resolve_blocked", RESOLVE_FULL_SQL)
def q_resolve_blocked(spark, sf):
    """J4 through the no-broadcast segment-blocking path (same result)."""
    return resolved_parts(spark, sf).select(
        "p_partkey", "raw_name", "canonical_name", "method", "confidence")


@register("mapping_log", f"{_LOG_SQL} SELECT * FROM log")
def q_mapping_log(spark, sf):
    """Mapping log of two record types (parts as startups, suppliers as products)."""
    return full_log(spark, sf)


@register("method_breakdown", f"{_LOG_SQL} SELECT method, count(*)::BIGINT AS count FROM log GROUP BY method")
def q_method_breakdown(spark, sf):
    """A1 over the mapping log."""
    return frequency(full_log(spark, sf), "method")


@register("matched_sample", f"{_LOG_SQL} SELECT * FROM log WHERE method <> 'no_seed_match' "
          "ORDER BY entityType, rawName, sourceUrl LIMIT 15")
def q_matched_sample(spark, sf):
    """F7 + L2: first 15 seed-matched log rows by an explicit order."""
    return head_sample(seed_matched(full_log(spark, sf)), 15, ["entityType", "rawName", "sourceUrl"])


def raw_lineitem_names(spark, sf):
    """One raw name per lineitem row: the part's name in one of six variants,
    the dropped-letter variant at a position that varies with the order."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    j = li.join(p, "l_partkey", "inner")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 6
    pos = (F.col("l_orderkey") % 4 + 2).cast("int")
    w = F.split("p_name", " ")
    raw = (F.when(k == 0, F.col("p_name"))
           .when(k == 1, F.concat(F.upper("p_name"), F.lit(" LLC")))
           .when(k == 2, F.concat_ws(" ", F.get(w, 1), F.get(w, 0)))
           .when(k == 3, F.concat(F.substr("p_name", F.lit(1), pos - 1), F.substr("p_name", pos + 1)))
           .when(k == 4, F.concat(F.col("p_name"), F.lit("s")))
           .otherwise(F.concat(F.col("p_name"), F.lit(" "), (F.col("l_orderkey") % 3).cast("string"))))
    return j.select("l_orderkey", "l_linenumber", raw.alias("raw_name"))


_RAW_LI = """rawli AS (
  SELECT l_orderkey, l_linenumber,
    CASE (l_orderkey + l_linenumber) % 6
      WHEN 0 THEN p_name
      WHEN 1 THEN upper(p_name) || ' LLC'
      WHEN 2 THEN concat_ws(' ', split_part(p_name, ' ', 2), split_part(p_name, ' ', 1))
      WHEN 3 THEN substr(p_name, 1, (l_orderkey % 4 + 2)::INTEGER - 1) || substr(p_name, (l_orderkey % 4 + 2)::INTEGER + 1)
      WHEN 4 THEN p_name || 's'
      ELSE p_name || ' ' || (l_orderkey % 3)::VARCHAR END AS raw_name
  FROM lineitem JOIN part ON p_partkey = l_partkey
)"""


@register("resolve_lineitem",
          f"WITH {_SEED}, {_RAW_LI}, {_resolve_sql('rawli', 'l_orderkey, s.l_linenumber')} "
          "SELECT l_orderkey, l_linenumber, canonical_name, method, confidence FROM resolved")
def q_resolve_lineitem(spark, sf):
    """J5 over every lineitem row (600k at sf0.1): few distinct names, each
    repeated thousands of times, so the plan must collapse them before the
    fuzzy step and join the small match map back."""
    r = resolve(raw_lineitem_names(spark, sf), "raw_name", part_seed(spark, sf))
    return r.select("l_orderkey", "l_linenumber", "canonical_name", "method", "confidence")


def raw_generated_names(spark, sf):
    """About one distinct name per order: a part name with one letter
    replaced at an order-dependent position, half of them with an extra
    numeric token (these fail the threshold after the cheap tests)."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    span = p.agg(F.max("p_partkey") - F.min("p_partkey") + 1).scalar()
    j = o.join(p, o.o_orderkey % span + p.agg(F.min("p_partkey")).scalar() == p.p_partkey, "inner")
    pos = (F.col("o_orderkey") % F.length("p_name")).cast("int") + 1
    letter = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), (F.floor(F.col("o_orderkey") / 7) % 26).cast("int") + 1, F.lit(1))
    typo = F.concat(F.substr("p_name", F.lit(1), pos - 1), letter, F.substr("p_name", pos + 1))
    raw = F.when(F.col("o_orderkey") % 2 == 0, typo).otherwise(
        F.concat(typo, F.lit(" "), (F.col("o_custkey") % 1000).cast("string")))
    return j.select("o_orderkey", raw.alias("raw_name"))


_RAW_GEN = """rawgen AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN t ELSE t || ' ' || (o_custkey % 1000)::VARCHAR END AS raw_name
  FROM (SELECT o_orderkey, o_custkey,
          substr(p_name, 1, (o_orderkey % length(p_name))::INTEGER) ||
          substr('abcdefghijklmnopqrstuvwxyz', ((o_orderkey // 7) % 26)::INTEGER + 1, 1) ||
          substr(p_name, (o_orderkey % length(p_name))::INTEGER + 2) AS t
        FROM orders JOIN part ON p_partkey =
          o_orderkey % (SELECT max(p_partkey) - min(p_partkey) + 1 FROM part) + (SELECT min(p_partkey) FROM part))
)"""


@register("resolve_generated",
          f"WITH {_SEED}, {_RAW_GEN}, {_resolve_sql('rawgen', 'o_orderkey')} "
          "SELECT o_orderkey, canonical_name, method, confidence FROM resolved")
def q_resolve_generated(spark, sf):
    """J4/J5 with many distinct names (one per order): the fuzzy theta join
    runs on every distinct name that misses the exact lookup."""
    r = resolve(raw_generated_names(spark, sf), "raw_name", part_seed(spark, sf))
    return r.select("o_orderkey", "canonical_name", "method", "confidence")


def earlier_part_seed(spark, sf):
    """A seed from before ``part_seed``: names of every fifth length are not in it yet, some
    names of the other half still are, and the names of every third length have other aliases."""
    p = load(spark, sf, "part").select("p_name").where(F.col("p_name").isNotNull()).distinct()
    n = F.length("p_name")
    p = p.where(F.when(F.ascii("p_name") % 2 == 0, n % 5 != 0).otherwise(n % 4 == 0))
    canon = F.concat(F.upper(F.substr("p_name", F.lit(1), F.lit(1))), F.substr("p_name", F.lit(2)))
    return p.select(F.col("p_name").alias("seed_idx"), canon.alias("canonical"),
                    F.when(n % 3 == 0, F.array(F.concat(F.col("p_name"), F.lit(" gone"))))
                    .otherwise(F.array(F.concat(F.col("p_name"), F.lit(" Inc")),
                                       F.regexp_replace("p_name", " ", "-"))).alias("aliases"))


@register("resolve_incremental", RESOLVE_FULL_SQL)
def q_resolve_incremental(spark, sf):
    """J5 by the stored map: a version of an earlier seed over the part rows with an even key,
    then one that brings in all rows, then one that follows the seed.  Equal to a full run."""
    base = scratch_path(spark, "resolve-kept")
    names = raw_part_names(spark, sf)
    refresh(spark, base, earlier_part_seed(spark, sf), names.where("p_partkey % 2 = 0"), "raw_name")
    refresh(spark, base, earlier_part_seed(spark, sf), names, "raw_name")
    refresh(spark, base, part_seed(spark, sf))
    return resolve_kept(names, "raw_name", base).select("p_partkey", "raw_name", "canonical_name", "method", "confidence")
