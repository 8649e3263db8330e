"""Landed-payload readers.

Fetching is not part of the engine: payloads are landed as rows
``(source, fetched_at, payload STRING)`` plus any position columns (tag
index, page start).  JSON pages are cut into elements by a structural scan
(``elements``), each parsed by ``from_json``; feeds are read by ``from_xml``.
Each payload row is handled inside one task and the
element rows keep their position for order-dependent operators.
A payload that does not parse yields no rows (never a failed job); a broken
element of a JSON page is lost alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element schemas of the landed payloads.
COMPANY_ELEMENT = ("id BIGINT, name STRING, url STRING, one_liner STRING, "
                   "long_description STRING, website STRING, all_locations STRING, "
                   "industry STRING, team_size BIGINT, launched_at BIGINT")
JOB_A_FIELDS = {"id": "string", "position": "string", "title": "string", "company": "string",
                "url": "string", "description": "string", "location": "string",
                "tags": "array<string>", "date": "string", "epoch": "bigint"}
JOB_C_FIELDS = {"title": "string", "company_name": "string", "url": "string", "description": "string",
                "location": "string", "tags": "array<string>", "created_at": "string", "remote": "boolean"}
RSS_ITEM = "title STRING, link STRING, description STRING, pubDate STRING"
NEWS_RSS_ITEM = ("title STRING, link STRING, `atom:link` ARRAY<STRUCT<_href: STRING>>, description STRING, summary STRING, "
                 "`content:encoded` STRING, pubDate STRING, published STRING, updated STRING, "
                 "`dc:date` STRING")
NEWS_ATOM_ENTRY = ("title STRING, link ARRAY<STRUCT<_href: STRING, _rel: STRING>>, "
                   "summary STRING, content STRING, published STRING, updated STRING, "
                   "`dc:date` STRING")
ATOM_PAPER_ENTRY = ("id STRING, title STRING, summary STRING, published STRING, "
                    "author ARRAY<STRUCT<name: STRING>>, category ARRAY<STRUCT<_term: STRING>>")


def page_elements(payloads: DataFrame, payload_col: str = "payload", keep=(), member: str | None = None) -> DataFrame:
    """``keep``, ``pos`` and the text ``element`` of each element of the JSON
    lists (see ``elements``); a payload of another shape gives no rows."""
    from pyspark import cloudpickle

    from lodestar.sources import elements
    cloudpickle.register_pickle_by_value(elements)
    pages = payloads.select(*[F.col(k) for k in keep], F.col(payload_col).cast("string").alias("__payload__"))
    out = T.StructType([*pages.schema.fields[:-1], T.StructField("pos", T.IntegerType()), T.StructField("element", T.StringType())])
    return pages.mapInArrow(elements.split_pages(member), out)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_objects(df: DataFrame, text: Column, fields: dict, present: str | None = None) -> DataFrame:
    """``df`` with the JSON objects of ``text`` parsed: ``__is_object__``, and
    what ``object_fields`` reads.  With ``present`` an object counts only if it
    has that key, be it null.

    Only the named fields are parsed, each as a variant of its own.  Where a
    field's own value has a repeated key inside (no variant), and only there,
    the object is parsed again with its fields as texts."""
    bad = "__bad__"
    names = list(dict.fromkeys([*fields, *([present] if present else [])]))
    opts = {"columnNameOfCorruptRecord": bad}

    def parsed(kind):
        return F.from_json(text, ", ".join(f"{quoted(n)} {kind}" for n in names) + f", {bad} string", opts)

    o, raw = F.col("__o__"), F.col("__raw__")
    out = df.withColumn("__o__", parsed("variant"))
    good = o.isNotNull() & o[bad].isNull()
    out = out.withColumn("__raw__", F.when(~good, parsed("string")))
    is_object = good | (raw.isNotNull() & raw[bad].isNull())
    if present:
        is_object = is_object & F.when(good, o[present].isNotNull()).otherwise(
            F.array_contains(F.json_object_keys(text), present))
    return out.withColumn("__is_object__", F.coalesce(is_object, F.lit(False)))


def object_fields(fields: dict) -> list[Column]:
    """Fields of the objects of ``with_objects``.  A value of another type is
    converted if it can be (a number as text, 1 as true) and null otherwise.  Of
    a repeated key the last value counts; ``NaN`` and ``Infinity`` are numbers."""
    o, raw = F.col("__o__"), F.col("__raw__")
    cols = []
    for n, t in fields.items():
        plain = raw[n] if t == "string" else F.from_json(raw[n], t) if "<" in t else raw[n].try_cast(t)
        cols.append(F.when(raw.isNull(), F.try_variant_get(o[n], "$", t)).otherwise(plain).alias(n))
    return cols


def _element_rows(elements: DataFrame, fields: dict, keep, present: str | None = None) -> DataFrame:
    objects = with_objects(elements, F.col("element"), fields, present).where("__is_object__")
    # A generator on purpose: Catalyst merges no projection across it, so that the
    # expressions of later steps (dates) read columns and not the parser's output.
    return objects.select(*keep, "pos", F.inline(F.array(F.struct(*object_fields(fields)))))


def json_array_rows(payloads: DataFrame, element_ddl: str, payload_col: str = "payload",
                    keep=()) -> DataFrame:
    """JSON array payload -> one row per element with its position ``pos``.
    Elements that are no objects are skipped."""
    schema = T.StructType.fromDDL(element_ddl)
    fields = {f.name: f.dataType.simpleString() for f in schema.fields}
    return _element_rows(page_elements(payloads, payload_col, keep), fields, keep)


def json_mixed_rows(payloads: DataFrame, fields: dict, key: str = "id",
                    payload_col: str = "payload", keep=()) -> DataFrame:
    """Heterogeneous JSON list: non-objects and objects without ``key``
    are skipped (``"id": null`` still counts as present); a payload that is
    not a list gives no rows."""
    return _element_rows(page_elements(payloads, payload_col, keep), fields, keep, present=key)


def json_data_rows(payloads: DataFrame, fields: dict, payload_col: str = "payload",
                   keep=()) -> DataFrame:
    """JSON object with a ``data`` array -> rows; other shapes -> none.
    Each field is read by itself (``object_fields``) and never takes other
    fields or the element with it."""
    return _element_rows(page_elements(payloads, payload_col, keep, member="data"), fields, keep)


def atom_paper_entries(payloads: DataFrame, payload_col: str = "payload", keep=()) -> DataFrame:
    """Atom paper feed -> ``(pos, id, title, summary, published, authors,
    categories)``."""
    doc = F.from_xml(inline_text(F.col(payload_col)), f"entry ARRAY<STRUCT<{ATOM_PAPER_ENTRY}>>")
    e = payloads.select(*[F.col(k) for k in keep], F.posexplode(doc["entry"]).alias("pos", "__e__"))
    return e.select(*keep, "pos", F.col("__e__.id").alias("id"), F.col("__e__.title").alias("title"),
                    F.col("__e__.summary").alias("summary"),
                    F.col("__e__.published").alias("published"),
                    F.transform(F.col("__e__.author"), lambda a: a["name"]).alias("authors"),
                    F.transform(F.col("__e__.category"), lambda c: c["_term"]).alias("categories"))


def rss_items(payloads: DataFrame, payload_col: str = "payload", item_ddl: str = RSS_ITEM,
              keep=()) -> DataFrame:
    """RSS ``item`` elements at any depth -> rows, in document order; an
    element's text is the joined text below it; malformed XML -> no rows.

    The page is parsed once to see that it is well-formed; its items are cut
    out by their tags (CDATA sections are turned into escaped text before, so
    that tags inside them are text) and parsed one by one."""
    bad = "__bad__"
    text = inline_text(F.col(payload_col))
    page = F.from_xml(text, f"channel STRING, {bad} STRING", {"columnNameOfCorruptRecord": bad, "mode": "PERMISSIVE"})
    pages = payloads.select(*[F.col(k) for k in keep], F.when(page[bad].isNull(), escaped_sections(text)).alias("__page__"))
    items = F.regexp_extract_all("__page__", F.lit(r"(?s)(<item(?:\s[^<>]*)?(?:/>|(?<!/)>.*?</item\s*>))"))
    return (pages.select(*keep, F.posexplode(items).alias("pos", "__item__"))
            .select(*keep, "pos", F.from_xml("__item__", item_ddl).alias("__e__"))
            .select(*keep, "pos", "__e__.*"))


# Element names of (X)HTML text markup; feeds have none of them as structure.
TEXT_MARKUP = ("a|abbr|b|blockquote|br|code|dd|del|div|dl|dt|em|figure|h[1-6]|hr|i|img|ins|li|ol|p|pre|q|s|small|"
               "span|strong|sub|sup|table|tbody|td|th|thead|tr|tt|u|ul")


def inline_text(payload) -> Column:
    """XML with inline markup elements opened up, so that an element's text is
    the joined text of its children.  Works on the tags of the document:
    escaped markup and CDATA sections stay as they are."""
    parts = F.split(payload, r"(?=<!\[CDATA\[)|(?<=\]\]>)", -1)
    tag = rf"</?(?:\w+:)?(?:{TEXT_MARKUP})(?:\s[^<>]*)?/?>"
    opened = F.transform(parts, lambda x: F.when(x.startswith("<![CDATA["), x).otherwise(F.regexp_replace(x, tag, "")))
    return F.array_join(opened, "")


def escaped_sections(payload) -> Column:
    """XML whose CDATA sections are escaped text, without comments."""
    parts = F.split(payload, r"(?=<!\[CDATA\[)|(?<=\]\]>)", -1)

    def plain(x):
        body = F.regexp_replace(x, r"(?s)^<!\[CDATA\[(.*)\]\]>$", "$1")
        return F.replace(F.replace(F.replace(body, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    return F.array_join(F.transform(parts, lambda x: F.when(x.startswith("<![CDATA["), plain(x))
                                    .otherwise(F.regexp_replace(x, r"(?s)<!--.*?-->", ""))), "")


def feed_items(payloads: DataFrame, payload_col: str = "payload", keep=()) -> DataFrame:
    """S10 + U3: one parse with both RSS items and Atom entries; each is
    projected to ``(kind, pos, title, link, summary, date_raw)`` and the two
    are concatenated (RSS first), as one array per payload.

    Field fallbacks (P5): link = text or the Atom ``href`` (``atom:link`` in
    RSS); summary =
    description / summary / content:encoded; date = pubDate / published /
    updated / dc:date (first non-empty)."""
    from lodestar.functions.text import first_nonempty, ustrip
    schema = (f"channel STRUCT<item: ARRAY<STRUCT<{NEWS_RSS_ITEM}>>>, "
              f"entry ARRAY<STRUCT<{NEWS_ATOM_ENTRY}>>")
    doc = F.from_xml(inline_text(F.col(payload_col)), schema)

    def clean(c):
        return F.nullif(ustrip(c), F.lit(""))

    rss = F.transform(F.coalesce(doc["channel"]["item"], F.array()), lambda i: F.struct(
        F.lit("rss").alias("kind"), clean(i["title"]).alias("title"),
        first_nonempty(clean(i["link"]), clean(F.get(i["atom:link"], 0)["_href"])).alias("link"),
        first_nonempty(clean(i["description"]), clean(i["summary"]),
                       clean(i["content:encoded"])).alias("summary"),
        first_nonempty(clean(i["pubDate"]), clean(i["published"]), clean(i["updated"]),
                       clean(i["dc:date"])).alias("date_raw")))
    atom = F.transform(F.coalesce(doc["entry"], F.array()), lambda e: F.struct(
        F.lit("atom").alias("kind"), clean(e["title"]).alias("title"),
        clean(F.get(e["link"], 0)["_href"]).alias("link"),
        first_nonempty(clean(e["summary"]), clean(e["content"])).alias("summary"),
        first_nonempty(clean(e["published"]), clean(e["updated"]),
                       clean(e["dc:date"])).alias("date_raw")))
    both = F.concat(rss, atom)
    return (payloads.select(*[F.col(k) for k in keep], F.posexplode(both).alias("pos", "__e__"))
            .select(*keep, "pos", "__e__.*"))
