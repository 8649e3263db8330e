"""Vectors and properties for filters, dedupe, linkage, replies and sinks."""

from pyspark.sql import functions as F

from lodestar.functions.replies import parse_reply, reply_field_enum, truncate_text
from lodestar.operators import dedupe as W
from lodestar.operators import linkage as L
from lodestar.operators.classify import first_success
from lodestar.operators.filters import keyword_match
from lodestar.operators.profile import funnel
from lodestar.operators.records import require


def test_keyword_vectors(spark):
    df = spark.createDataFrame([("AI Lead", None, True), ("Maid", "", False), ("Fullmoon", "", True),
                                ("NLPish", None, True), ("Partner Manager", "", False)],
                               "title string, tags string, want boolean")
    got = df.select(keyword_match([F.col("title"), F.col("tags")]).alias("k"), "want").collect()
    assert all(r.k == r.want for r in got)


def test_first_wins_vector(spark):
    df = spark.createDataFrame([(0, 0, 1, None, "u"), (0, 1, 1, "A", "u1"), (1, 0, 1, "B", "u2"),
                                (1, 1, None, "C", "u3"), (1, 2, None, "C", "u3")],
                               "tag_idx int, pos int, id int, name string, url string")
    out = W.first_wins(require(df, "name", "url"), "id", ["tag_idx", "pos"])
    assert sorted(r.name for r in out.collect()) == ["A", "C", "C"]


def test_resume_twice_equals_once(spark):
    new = spark.range(100).select(F.col("id").cast("string").alias("k"))
    done = spark.range(0, 100, 3).select(F.col("id").cast("string").alias("k"))
    once = W.resume_anti(new, done, "k")
    twice = W.resume_anti(once, done, "k")
    assert sorted(once.collect()) == sorted(twice.collect())


def _cands(spark, eighth_plain):
    rows = [(f"https://github.com/o/awesome-{i}", f"o/awesome-{i}", "", 100 - i) for i in range(8)]
    if eighth_plain:
        rows[7] = ("https://github.com/o/impl", "o/impl", "code", 93)
    rows.append(("https://github.com/o/late", "o/late", "code", 1))
    return spark.createDataFrame([("2401.00001",) + r for r in rows],
                                 "ref_id string, html_url string, full_name string, description string, stars bigint")


def test_top8_then_filter(spark):
    papers = spark.createDataFrame([("2401.00001v1",)], "arxiv_id string")
    none = L.find_links(papers, _cands(spark, False)).first().github_url
    some = L.find_links(papers, _cands(spark, True)).first().github_url
    assert none is None and some == "https://github.com/o/impl"


def test_overmatch_idempotent(spark):
    df = spark.createDataFrame([(i, f"u{i % 3}" if i % 4 else None, i) for i in range(20)],
                               "k int, github_url string, github_stars bigint")
    once = L.overmatch_clear(df).drop("__overmatched__")
    twice = L.overmatch_clear(once).drop("__overmatched__")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_truncation_vectors(spark):
    df = spark.createDataFrame([("x" * 6000,), ("x" * 6001,), ("y" * 11,)], "t string")
    a = [len(r.t) for r in df.select(truncate_text("t").alias("t")).collect()]
    assert a[:2] == [6000, 6000]
    b = df.select(truncate_text("t", 10).alias("t")).collect()[2].t
    assert b == "y" * 7 + " ...[truncated]... " and len(b) == 26


def test_reply_vectors(spark):
    replies = spark.createDataFrame([
        ("a", 0, 200, '```json\n{"pricingModel":"free"}\n```'),
        ("b", 0, 200, '{"pricingModel":"GRATIS"}'), ("b", 1, 200, '{"pricingModel":"PAID"}'),
        ("c", 0, 200, "not json"), ("c", 1, 200, '{"pricingModel":"PAID"}'),
        ("d", 0, 200, "[]"), ("e", 0, 429, '{"pricingModel":"FREE"}'), ("e", 1, 200, None)],
        "record_key string, tier_idx int, status int, body string")
    fs = first_success(replies).select("record_key", reply_field_enum(parse_reply("reply")).alias("p"))
    assert dict((r.record_key, r.p) for r in fs.collect()) == {"a": "FREE", "b": "UNKNOWN", "c": "PAID",
                                                               "d": "UNKNOWN"}


def test_funnel_total_is_kept_plus_rejected(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 5 == 0).alias("kept"))
    r = funnel(df, "g", {"kept": F.col("kept"), "rejected": ~F.col("kept")}).collect()
    assert all(x.total == x.kept + x.rejected for x in r)


def test_csv_round_trip(spark, tmp_path):
    from lodestar.sinks import write_csv
    df = spark.createDataFrame([(1, "a, \"quoted\"", None, True), (2, "", "line\nbreak", False)],
                               "id int, s string, t string, b boolean")
    p = write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(p)
    rows = sorted((r.id, r.s, r.t, r.b) for r in back.collect())
    assert rows == [("1", 'a, "quoted"', None, "True"), ("2", None, "line\nbreak", "False")]


def test_required_scan_errors_on_missing_path(spark, tmp_path):
    import pytest as _pt
    from pyspark.sql import types as T

    from lodestar.sources.files import read_jsonl
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert read_jsonl(spark, str(tmp_path / "nope"), schema).count() == 0
    with _pt.raises(Exception):
        read_jsonl(spark, str(tmp_path / "nope"), schema, missing_ok=False).count()


def test_strict_scan_fails_on_bad_line(spark, tmp_path):
    import pytest as _pt
    from pyspark.sql import types as T

    from lodestar.sources.files import read_jsonl
    p = tmp_path / "bad.jsonl"
    p.write_text('{"a": 1}\n\n{"a": oops\n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    with _pt.raises(Exception):
        read_jsonl(spark, str(p), schema).collect()


def test_bounded_stream_dedupe(spark, tmp_path):
    from pyspark.sql import types as T

    from lodestar import streaming as ST
    src = tmp_path / "in"
    rows = [(1, "2026-09-15 10:00:00"), (1, "2026-09-15 10:00:05"), (2, "2026-09-15 10:01:00")]
    spark.createDataFrame(rows, "k long, t string").write.json(str(src))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    s = ST.landed_stream(spark, str(src), schema).withColumn("ts", F.to_timestamp("t"))
    d = ST.dedupe_within_watermark(s, ["k"], "ts", "1 hour")
    ST.run_available(d, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_stream_rerun_adds_nothing(spark, tmp_path):
    from pyspark.sql import types as T

    from lodestar import streaming as ST
    src = tmp_path / "in"
    spark.range(10).write.json(str(src))
    schema = T.StructType([T.StructField("id", T.LongType())])
    for _ in range(2):
        ST.run_available(ST.landed_stream(spark, str(src), schema), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_stateful_stream_dedupe_across_runs(spark, tmp_path):
    from pyspark.sql import types as T

    from lodestar import streaming as ST
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    src = tmp_path / "in"
    for i, rows in enumerate([[(1, "a"), (2, "b"), (1, "c")], [(2, "d"), (3, "e")]]):
        spark.createDataFrame(rows, schema).write.json(str(src / f"drop{i}"))
        s = ST.dedupe_stateful(ST.landed_stream(spark, str(src / "*"), schema), ["k"])
        ST.run_available(s, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_cross_category_dedupe_strict_parity(spark):
    df = spark.createDataFrame([("p1", 0, 0), ("p1", 0, 1), ("p1", 1, 0), ("p2", 1, 3), ("p2", 2, 0)],
                               "k string, cat int, pos int")
    dedup = W.cross_group_dedupe(df, "k", ["cat", "pos"])
    assert sorted((r.k, r.cat, r.pos) for r in dedup.collect()) == [("p1", 0, 0), ("p2", 1, 3)]
    strict = W.cross_group_dedupe(df, "k", ["cat", "pos"], group="cat", strict_parity=True)
    assert sorted((r.k, r.cat, r.pos) for r in strict.collect()) == [("p1", 0, 0), ("p1", 0, 1), ("p2", 1, 3)]


def test_product_enum_quarantine(spark):
    from lodestar.operators.records import product_records, split_valid
    s = spark.createDataFrame([("u1", "A", "FREE"), ("u2", "B", "CHEAP")], "url string, name string, p string")
    s = s.select(F.struct(F.lit("src").alias("name"), F.col("url").alias("url")).alias("source"),
                 F.current_timestamp().alias("collectedAt"),
                 F.struct(F.col("name").alias("entityName"), F.col("name").alias("rawName"),
                          F.lit(None).cast("string").alias("description"),
                          F.lit(None).cast("string").alias("website")).alias("content"), "p")
    good, bad = split_valid(product_records(s, "p"), "PRODUCT")
    assert [r.content.productName for r in good.collect()] == ["A"]
    assert [list(r.violations) for r in bad.collect()] == [["content.pricingModel:enum"]]
