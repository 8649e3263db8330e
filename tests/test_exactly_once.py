"""Crashes and retries: outputs stay whole and nothing is written twice."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar import sinks, streaming
from lodestar.operators import classify, linkage, records
from lodestar.sources import files, payloads

AB = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def test_half_written_version_is_not_current(spark, tmp_path):
    base = str(tmp_path / "v")
    df = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], AB)
    sinks.write_jsonl(df, f"{base}/v000000")
    os.makedirs(f"{base}/v000001/_temporary")
    out = sinks.rewrite_versioned(spark, base, AB, lambda d: d.withColumn("b", F.col("b") + 1))
    assert out.endswith("v000002")
    assert sorted(map(tuple, spark.read.schema(AB).json(out).collect())) == [(1, 3), (3, 5), (5, 7)]


def test_publish_fails_on_a_bad_line(spark, tmp_path):
    (tmp_path / "sink.json").write_text('{"a":1,"b":2}\n{"a":\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        sinks.publish(spark, str(tmp_path / "sink.json"), AB, str(tmp_path / "out"))


def test_tolerant_scan_does_not_depend_on_the_columns(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a":1,"b":1}\n{"a":2\n\n{"a":3,"b":"zz"}\n[]\n')
    good, bad = files.read_jsonl_tolerant(spark, str(tmp_path / "x.json"), AB, with_rejects=True)
    assert sorted(map(tuple, good.collect())) == [(1, 1), (3, None)]
    assert good.count() == 2 and good.select("a").count() == 2 and bad.first()[0] == 2


def test_retried_batch_replaces_itself(spark, tmp_path, as_of):
    base = str(tmp_path)
    batch = spark.createDataFrame([("1 hours ago", "s"), ("5 days ago", "s"), (None, "t")], "d string, g string")
    fn = streaming.fresh_gate(spark, f"{base}/k", f"{base}/r", f"{base}/f", "d", as_of, group="g")
    for _ in range(2):
        fn(batch, 0)
    fn(batch, 1)
    assert spark.read.parquet(f"{base}/k").count() == 2 and spark.read.parquet(f"{base}/r").count() == 4
    assert spark.read.parquet(f"{base}/f").where("batch_id = 0").count() == 2


def test_retried_dedupe_batch_keeps_its_rows(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    fn = streaming.dedupe_into(spark, str(tmp_path / "sink"), "k", ["n"], schema)
    one = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], schema)
    two = spark.createDataFrame([("b", 5), ("c", 6), (None, 7)], schema)
    for batch, i in ((one, 0), (one, 0), (two, 1), (two, 1)):
        fn(batch, i)
    got = spark.read.parquet(str(tmp_path / "sink")).select("k", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 1), ("b", 4), ("c", 6), (None, 3), (None, 7)], key=str)


def test_repository_listed_twice_gives_one_row(spark):
    papers = spark.createDataFrame([("https://github.com/o/r",), (None,)], "github_url string")
    dim = spark.createDataFrame([("o", "r", 5), ("o", "r", 9)], "owner string, repo string, stargazers_count long")
    got = linkage.star_lookup(papers, dim).collect()
    assert sorted(((r.github_url, r.github_stars) for r in got), key=str) == [("https://github.com/o/r", 9), (None, None)]


def test_tie_on_one_tier_is_settled(spark):
    rows = [("x", 0, 200, '{"pricingModel":"PAID"}', 2), ("x", 0, 200, '{"pricingModel":"FREE"}', 1)]
    df = spark.createDataFrame(rows, "record_key string, tier_idx int, status int, body string, attempt int")
    for d in (df, df.orderBy("attempt")):
        assert classify.first_success(d).first().reply == rows[1][3]
    assert classify.first_success(df.drop("attempt")).first().reply == min(r[3] for r in rows)


def test_old_style_paper_ids_are_found(spark):
    repos = spark.createDataFrame([("see hep-th/9901234v2 and 2401.00001v1, math.GT/0309136",)], "text string")
    assert sorted(r.ref_id for r in linkage.extract_refs(repos).collect()) == ["0309136", "2401.00001", "9901234"]


def test_wrong_types_go_to_quarantine(spark, as_of):
    raw = spark.createDataFrame([("5", "A"), ("abc", "B"), (None, "C")], "size string, name string")
    content = records.content_struct("STARTUP", entityName=F.col("name"), data={"employeeCount": F.col("size")})
    env = raw.select("size", *records.envelope("STARTUP", "src", F.lit("u"), as_of, content))
    good, bad = records.split_valid(env, "STARTUP", raw={"data.employeeCount": "size"})
    assert good.count() == 2
    assert [list(r.violations) for r in bad.collect()] == [["content.data.employeeCount:type"]]


def test_job_dates_and_flags_of_any_type(spark):
    body = """{"data":[{"title":"a","created_at":1757930400,"remote":1},{"title":"b","created_at":1757930400.5},
      {"title":"c","created_at":"2025-09-15T10:00:00Z","remote":"true","tags":["x"]},{"title":"d","tags":"no"},5]}"""
    rows = payloads.json_data_rows(spark.createDataFrame([(body,)], "payload string"), payloads.JOB_C_FIELDS)
    rows = rows.withColumn("s", records.whole_seconds(F.col("created_at"))).orderBy("title").collect()
    assert [r.s for r in rows] == ["1757930400", "1757930400", "2025-09-15T10:00:00Z", None]
    assert [r.remote for r in rows] == [True, None, True, None] and rows[2].tags == ["x"] and rows[3].tags is None


def test_feed_text_with_inline_markup_and_atom_link(spark):
    xml = """<rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><item><title>A <b>bold</b> t</title>
      <atom:link href="http://x/1"/><description><![CDATA[<p>kept</p>]]></description></item>
      <item><title>&lt;i&gt;esc&lt;/i&gt;</title><link>http://x/2</link></item></channel></rss>"""
    atom = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="xhtml"><div
      xmlns="http://www.w3.org/1999/xhtml">Less: <em>more</em></div></title><link href="http://x/3"/></entry></feed>"""
    df = spark.createDataFrame([(xml,), (atom,)], "payload string")
    got = {r.link: (r.title, r.summary) for r in payloads.feed_items(df).collect()}
    assert got["http://x/1"] == ("A bold t", "<p>kept</p>")
    assert got["http://x/2"][0] == "<i>esc</i>" and got["http://x/3"][0] == "Less: more"


def test_export_prefers_resolved_records_that_are_there(spark, tmp_path, as_of):
    from lodestar.plans.export import export_all

    def startups(name):
        df = spark.createDataFrame([(name,)], "name string")
        content = records.content_struct("STARTUP", entityName=F.col("name"))
        return df.select(*records.envelope("STARTUP", "s", F.lit("u"), as_of, content))

    for resolved, want in ((startups("resolved"), "resolved"), (startups("x").where("false"), "raw"), (None, "raw")):
        out = export_all({"startups": resolved}, str(tmp_path / want / str(resolved is None)), {"startups": startups("raw")})
        got = spark.read.option("header", True).csv(out["startups"]).collect()
        assert [r["content.entityName"] for r in got] == [want]
