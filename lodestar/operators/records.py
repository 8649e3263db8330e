"""Record builders (P1-P6), required-field filter (F1), flatten (P7), nested
update (P8) and schema validation with quarantine (V1).

Builders take the inlined element rows of a landed payload and return
envelope rows ``schemaVersion, recordType, source, collectedAt, content``.
Rows without identity or source link are dropped (F1) before the record is
built, as in the contract; use :func:`validate` to keep them in quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.dates import as_of_lit, epoch_year, parse_flexible_date, strict_iso_ts
from lodestar.functions.text import (array_text, col_of, collapse_space, cut_text, drop_empty,
                                     first_nonempty, split_title, strip_markup, url_tail, ustrip)
from lodestar.schemas import (CONTENT_BY_TYPE, FLAT_COLUMNS, JOB_SOURCE_A, JOB_SOURCE_B, JOB_SOURCE_C,
                              PAPER_SOURCE_NAME, PRICING_MODELS, RECORD_TYPES, REQUIRED_CONTENT,
                              SCHEMA_VERSION, STARTUP_SOURCE_NAME)


def truthy(c) -> Column:
    """F1 test: not null and not the empty string."""
    c = col_of(c)
    return c.isNotNull() & (c.cast("string") != "")


def require(df: DataFrame, *cols) -> DataFrame:
    """keep rows whose every listed field is present and non-empty."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & truthy(c)
    return df.where(cond)


def typed_struct(schema, fields: dict) -> Column:
    """Struct of ``schema`` built field by field (given fields, null
    elsewhere; nested dicts for nested structs).  Casting each field, not
    the whole struct, keeps ``content.x`` references foldable by Catalyst."""
    from pyspark.sql import types as T
    cols = []
    for f in schema.fields:
        v = fields.get(f.name)
        if isinstance(v, dict) and isinstance(f.dataType, T.StructType):
            cols.append(typed_struct(f.dataType, v).alias(f.name))
        else:
            c = F.lit(None) if v is None else v
            # A value of the wrong type becomes null (``validate`` reports it), never an error.
            cols.append(c.try_cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def content_struct(record_type: str, **fields) -> Column:
    """A full content struct of ``record_type``: given fields, null elsewhere."""
    return typed_struct(CONTENT_BY_TYPE[record_type], fields)


def envelope(record_type: str, source_name, source_url, collected_at, content: Column,
             keep=()) -> list:
    """Envelope columns (constants, provenance, collection time)."""
    name = F.lit(source_name) if isinstance(source_name, str) else source_name
    return [F.lit(SCHEMA_VERSION).alias("schemaVersion"),
            F.lit(record_type).alias("recordType"),
            F.struct(name.alias("name"), col_of(source_url).alias("url")).alias("source"),
            as_of_lit(collected_at).alias("collectedAt"),
            content.alias("content"), *keep]


def startup_records(companies: DataFrame, collected_at, source_name: str = STARTUP_SOURCE_NAME,
                    keep=()) -> DataFrame:
    """Raw company rows -> STARTUP records (rows without name/url dropped)."""
    c = require(companies, "name", "url")
    content = content_struct(
        "STARTUP", entityName=F.col("name"), rawName=F.col("name"),
        description=first_nonempty("long_description", "one_liner"), website=F.col("website"),
        data={"employeeCount": F.col("team_size"), "foundedYear": epoch_year("launched_at"),
              "hq": first_nonempty("all_locations"), "industry": F.col("industry")})
    return c.select(*envelope("STARTUP", source_name, F.col("url"), collected_at, content,
                              keep=[F.col(k) for k in keep]))


def product_records(startups: DataFrame, pricing_col: str = "pricingModel", keep=()) -> DataFrame:
    """STARTUP records + a pricing column -> PRODUCT records, 1:1."""
    content = content_struct(
        "PRODUCT", startupName=F.col("content.entityName"), productName=F.col("content.entityName"),
        rawStartupName=F.col("content.rawName"), pricingModel=F.col(pricing_col),
        description=F.col("content.description"), website=F.col("content.website"))
    return startups.select(F.lit(SCHEMA_VERSION).alias("schemaVersion"),
                           F.lit("PRODUCT").alias("recordType"),
                           F.col("source"), F.col("collectedAt"),
                           content.alias("content"),
                           *[F.col(k) for k in keep])


def paper_records(entries: DataFrame, collected_at, keep=()) -> DataFrame:
    """Inlined Atom entries ``(id, title, summary, published, authors
    ARRAY<STRING>, categories ARRAY<STRING>)`` -> RESEARCH_PAPER records."""
    e = entries.select(
        "*",
        F.when(truthy("id"), url_tail(F.col("id"))).alias("__aid__"),
        collapse_space(F.coalesce(F.col("title"), F.lit(""))).alias("__title__"),
        F.coalesce(F.col("id"), F.lit("")).alias("__url__"))
    e = require(e, "__aid__", "__title__", "__url__")
    content = content_struct(
        "RESEARCH_PAPER", title=F.col("__title__"),
        authors=drop_empty(F.coalesce(F.col("authors"), F.array().cast("array<string>"))),
        abstract=F.nullif(collapse_space(F.coalesce(F.col("summary"), F.lit(""))), F.lit("")),
        paper_url=F.col("__url__"), published_date=strict_iso_ts(F.col("published")),
        arxiv_id=F.col("__aid__"),
        categories=drop_empty(F.coalesce(F.col("categories"), F.array().cast("array<string>"))))
    return e.select(*envelope("RESEARCH_PAPER", PAPER_SOURCE_NAME, F.col("__url__"), collected_at,
                              content, keep=[F.col(k) for k in keep]))


def _job_content(title, company, date, is_remote, location, url, description) -> Column:
    return content_struct("JOB", title=title, company=company, date=date, is_remote=is_remote,
                          role_family=F.lit("Engineering"), location=location, job_url=url,
                          description=description)


def job_flags_a(items: DataFrame, as_of) -> DataFrame:
    """Source A listing rows -> (title, company, url, tags_text, published)."""
    return items.select(
        "*",
        first_nonempty("position", "title").alias("__title__"),
        array_text("tags", " ").alias("__tags__"),
        parse_flexible_date(F.coalesce(F.nullif(F.col("date"), F.lit("")),
                                       F.when(F.col("epoch") != 0, F.col("epoch").cast("string"))),
                            as_of).alias("__date__"))


def job_records_a(items: DataFrame, as_of, collected_at=None, keywords=None, max_chars: int | None = 2000) -> DataFrame:
    """Remote-only JSON listing -> JOB records (keyword + freshness gated)."""
    from lodestar.operators.filters import keyword_match
    from lodestar.functions.dates import is_fresh
    e = job_flags_a(items, as_of)
    e = require(e, "__title__", "company", "url")
    e = e.where(keyword_match([F.col("__title__"), F.col("__tags__")], keywords))
    e = e.where(is_fresh(F.col("__date__"), as_of))
    content = _job_content(F.col("__title__"), F.col("company"), F.col("__date__"), F.lit(True),
                           F.coalesce(F.nullif(F.col("location"), F.lit("")), F.lit("Remote")),
                           F.col("url"), cut_text(F.coalesce(F.col("description"), F.lit("")), max_chars))
    return e.select(*envelope("JOB", JOB_SOURCE_A, F.col("url"), collected_at or as_of, content))


def job_records_b(items: DataFrame, as_of, collected_at=None, keywords=None, max_chars: int | None = 2000) -> DataFrame:
    """RSS items ``(title, link, description, pubDate)`` -> JOB records.
    Titles read ``Company: Title``; the description has its markup stripped."""
    from lodestar.operators.filters import keyword_match
    from lodestar.functions.dates import is_fresh
    e = require(items, "title", "link")
    company, title = split_title(F.col("title"))
    e = e.select("*", company.alias("__company__"), title.alias("__t__"),
                 parse_flexible_date(F.col("pubDate"), as_of).alias("__date__"))
    e = e.where(keyword_match([F.col("__t__")], keywords))
    e = e.where(is_fresh(F.col("__date__"), as_of))
    content = _job_content(F.col("__t__"), F.col("__company__"), F.col("__date__"), F.lit(True),
                           F.lit("Remote"), F.col("link"), strip_markup(F.col("description"), max_chars))
    return e.select(*envelope("JOB", JOB_SOURCE_B, F.col("link"), collected_at or as_of, content))


def whole_seconds(c: Column) -> Column:
    """A number in text form without its fraction; other text as it is."""
    return F.coalesce(c.try_cast("double").try_cast("bigint").cast("string"), c)


def job_records_c(items: DataFrame, as_of, collected_at=None, keywords=None, max_chars: int | None = 2000) -> DataFrame:
    """JSON ``data[]`` listing -> JOB records; ``is_remote`` from ``remote``."""
    from lodestar.operators.filters import keyword_match
    from lodestar.functions.dates import is_fresh
    e = require(items, "title", "company_name", "url")
    e = e.select("*", array_text("tags", " ").alias("__tags__"),
                 parse_flexible_date(whole_seconds(F.col("created_at").cast("string")), as_of).alias("__date__"))
    e = e.where(keyword_match([F.col("title"), F.col("__tags__")], keywords))
    e = e.where(is_fresh(F.col("__date__"), as_of))
    content = _job_content(F.col("title"), F.col("company_name"), F.col("__date__"),
                           F.coalesce(F.col("remote"), F.lit(False)),
                           F.coalesce(F.nullif(F.col("location"), F.lit("")), F.lit("Not specified")),
                           F.col("url"), cut_text(F.coalesce(F.col("description"), F.lit("")), max_chars))
    return e.select(*envelope("JOB", JOB_SOURCE_C, F.col("url"), collected_at or as_of, content))


def news_flags(items: DataFrame, as_of) -> DataFrame:
    """Adds ``__title__``, ``__link__``, ``__summary__``, ``__date__`` (parsed,
    news variant) to projected feed items ``(title, link, summary, date_raw)``."""
    from lodestar.functions.dates import parse_news_date
    return items.select(
        "*",
        F.nullif(ustrip(F.col("title")), F.lit("")).alias("__title__"),
        F.nullif(ustrip(F.col("link")), F.lit("")).alias("__link__"),
        F.nullif(ustrip(F.col("summary")), F.lit("")).alias("__summary__"),
        parse_news_date(F.col("date_raw"), as_of).alias("__date__"))


def news_records(items: DataFrame, as_of, collected_at=None, max_chars: int | None = 2000) -> DataFrame:
    """P5: feed items (``source_name``, ``title``, ``link``, ``summary``,
    ``date_raw``) -> NEWS records, keeping fresh, dated items only."""
    from lodestar.functions.dates import is_fresh
    e = require(news_flags(items, as_of), "__title__", "__link__")
    e = e.where(is_fresh(F.col("__date__"), as_of))
    content = content_struct("NEWS", title=F.col("__title__"),
                             summary=cut_text(F.coalesce(F.col("__summary__"), F.lit("")), max_chars),
                             published_date=F.col("__date__"), article_url=F.col("__link__"),
                             entities_mentioned=F.array().cast("array<string>"))
    return e.select(*envelope("NEWS", F.col("source_name"), F.col("__link__"),
                              collected_at or as_of, content))


# ---------------------------------------------------------------- P7 / P8


def flatten(df: DataFrame, table: str) -> DataFrame:
    """Nested record -> the table's dotted flat columns (authors joined by ``; ``)."""
    cols = []
    for name in FLAT_COLUMNS[table]:
        c = F.col(name)
        if name == "content.authors":
            c = array_text(c, "; ")
        cols.append(c.alias(name))
    return df.select(*cols)


def set_nested(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Replace one nested field in place, e.g. ``content.entityName``."""
    top, _, rest = path.partition(".")
    return df.withColumn(top, F.col(top).withField(rest, value))


# ---------------------------------------------------------------- V1
def validate(df: DataFrame, record_type: str, raw: dict | None = None) -> DataFrame:
    """V1: add ``violations ARRAY<STRING>`` (empty = valid): envelope fields,
    required content fields, enum values, and wrong types: ``raw`` maps content
    fields (dotted if nested) to columns of ``df`` with the values they were
    built from, and a value that did not survive the cast is ``:type``."""
    checks = [
        F.when(F.col("schemaVersion").isNull(), F.lit("schemaVersion:missing")),
        F.when(~F.col("recordType").isin(*RECORD_TYPES) | F.col("recordType").isNull(),
               F.lit("recordType:enum")),
        F.when(F.col("source.name").isNull(), F.lit("source.name:missing")),
        F.when(F.col("source.url").isNull(), F.lit("source.url:missing")),
        F.when(F.col("collectedAt").isNull(), F.lit("collectedAt:missing")),
    ]
    for f in REQUIRED_CONTENT[record_type]:
        checks.append(F.when(F.col(f"content.{f}").isNull(), F.lit(f"content.{f}:missing")))
    if record_type == "PRODUCT":
        checks.append(F.when(~F.col("content.pricingModel").isin(*PRICING_MODELS),
                             F.lit("content.pricingModel:enum")))
    for f, c in (raw or {}).items():
        checks.append(F.when(truthy(c) & F.col(f"content.{f}").isNull(), F.lit(f"content.{f}:type")))
    return df.withColumn("violations", F.filter(F.array(*checks), lambda x: x.isNotNull()))


def split_valid(df: DataFrame, record_type: str, raw: dict | None = None):
    """V1: (valid rows, quarantine rows with their violation codes)."""
    v = validate(df, record_type, raw)
    return (v.where(F.size("violations") == 0).drop("violations"),
            v.where(F.size("violations") > 0))
