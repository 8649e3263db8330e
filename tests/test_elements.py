"""Element splitter of JSON pages, lenient objects, feeds' texts, null keys."""

import json
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from lodestar.operators.dedupe import resume_anti
from lodestar.operators.keys import with_spread_key
from lodestar.sources import payloads as P
from lodestar.sources.elements import list_elements
from lodestar.sources.files import read_jsonl_tolerant
from pyspark.sql import functions as F

VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text(alphabet='ab"\\[]{},: é\n日', max_size=8),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet='ab"\\[]{},:d', max_size=4), x, max_size=4), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(VALUES, max_size=6), st.booleans(), st.dictionaries(st.text(alphabet='ab"\\{', max_size=3), VALUES, max_size=3))
def test_elements_are_those_of_the_parser(items, spaced, others):
    sep = (" , ", " : ") if spaced else (",", ":")
    page = json.dumps(items, separators=sep, ensure_ascii=False).encode()
    assert [json.loads(x) for x in list_elements(page)] == items
    assert list_elements(page, "data") == []
    others.pop("data", None)
    whole = json.dumps({**others, "data": items, "z": {"data": [1, 2]}}, separators=sep).encode()
    assert [json.loads(x) for x in list_elements(whole, "data")] == items
    assert list_elements(whole) == []


def test_broken_pages_keep_what_is_whole():
    assert list_elements(b'[{"a":1},{"b": },3') == [b'{"a":1}', b'{"b": }']
    assert list_elements(b' [ ] ') == [] and list_elements(b'') == [] and list_elements(b'"[1]"') == []
    assert list_elements(b'{"data":[1],"data":[2,3]}', "data") == [b"2", b"3"]
    assert list_elements(b'{"data":[1],"data":null}', "data") == []
    assert list_elements(b'{"d\\u0061ta":[1]}', "data") == [b"1"]
    assert list_elements(b'["\\\\",2,"\\\\\\"",3]') == [b'"\\\\"', b"2", b'"\\\\\\""', b"3"]


def test_a_page_of_50_mb_is_split_in_one_go():
    rng = random.Random(1)
    one = json.dumps({"id": 1, "text": "".join(rng.choices('abc "[]{},\\', k=2000))})
    page = ("[" + ",".join([one] * (50_000_000 // len(one))) + "]").encode()
    start = time.time()
    parts = list_elements(page)
    assert len(parts) == 50_000_000 // len(one) and set(parts) == {one.encode()} and time.time() - start < 60


def test_only_the_broken_element_of_a_page_is_lost(spark):
    page = '[{"legal":1},{"id":1,"title":"a","title":"b"},{"id":2,"n":NaN},{"id":3,"title": },{"id":null,"title":{"a":1,"a":2}},7,{"id":5,"tags":["x"],"ok":1}]'
    df = spark.createDataFrame([(1, page), (2, '{"data":' + page + "}"), (3, "nope"), (4, None)], "page int, payload string")
    fields = {"id": "bigint", "title": "string", "n": "double", "tags": "array<string>", "ok": "boolean"}
    got = [(r.page, r.pos, r.id, r.title, r.ok, r.tags) for r in P.json_mixed_rows(df, fields, keep=["page"]).orderBy("pos").collect()]
    assert got == [(1, 1, 1, "b", None, None), (1, 2, 2, None, None, None), (1, 4, None, '{"a":1,"a":2}', None, None),
                   (1, 6, 5, None, True, ["x"])]
    data = P.json_data_rows(df, fields, keep=["page"]).collect()
    assert {(r.page, r.pos) for r in data} == {(2, k) for k in (0, 1, 2, 4, 6)}


def test_tolerant_lines_take_what_the_strict_scan_takes(spark, tmp_path):
    lines = ['{"k":"a","k":"b","v":1}', '{"k":"c","v":NaN}', '{"k":"d","c.d":"dot","e f":"blank"}', "oops", '{"k": }', "[1]", "", "5"]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    from pyspark.sql import types as T
    schema = T.StructType().add("k", "string").add("v", "double").add("c.d", "string").add("e f", "string")
    good, rejects = read_jsonl_tolerant(spark, str(tmp_path / "x.jsonl"), schema, with_rejects=True)
    rows = {r[0]: tuple(r)[1:] for r in good.collect()}
    assert set(rows) == {"b", "c", "d"} and rows["d"] == (None, "dot", "blank") and rows["c"][0] != rows["c"][0]
    assert rejects.first()[0] == 4


def test_titles_of_feeds_are_joined_text_and_items_lie_anywhere(spark):
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>1</id><title>A <b>bold</b> t</title><summary>s<sub>2</sub></summary></entry></feed>'
    assert [(r.title, r.summary) for r in P.atom_paper_entries(spark.createDataFrame([(atom,)], "payload string")).collect()] == [("A bold t", "s2")]
    rss = ('<rss><wrap><x><item a="1"><title>ML <b>Eng</b></title><link>u</link></item></x></wrap><item><title><![CDATA[<item>A & B</item>]]></title></item>'
           "<!-- <item><title>no</title></item> --><channel><item><title>C</title><description>&lt;p&gt;</description></item></channel></rss>")
    df = spark.createDataFrame([(1, rss), (2, "<rss><item><title>x</title></rss>"), (3, None)], "page int, payload string")
    got = [(r.page, r.pos, r.title, r.link, r.description) for r in P.rss_items(df, keep=["page"]).orderBy("pos").collect()]
    assert got == [(1, 0, "ML Eng", "u", None), (1, 1, "<item>A & B</item>", None, None), (1, 2, "C", None, "<p>")]


def test_null_keys_are_dealt_evenly_whatever_the_columns(spark):
    equal = spark.range(10_000).select(F.lit(None).cast("string").alias("k")).repartition(4)
    keys = with_spread_key(equal, "key", F.col("k"))
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] <= 8
    maps = spark.createDataFrame([(None, {"a": 1}), ("x", {"b": 2}), ("y", None)], "k string, m map<string,int>").withColumn(
        "v", F.parse_json(F.lit('{"a":1}')))
    done = spark.createDataFrame([("x",)], "k string")
    assert sorted((r.k or "") for r in resume_anti(maps, done, "k").collect()) == ["", "y"]
