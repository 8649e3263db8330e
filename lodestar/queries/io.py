"""Sink, file-source and streaming queries: data is written under the
shared checkpoint folder (a fresh path per call), read back, and compared
with the SQL of the rows that were written."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar import sinks as K
from lodestar import streaming as ST
from lodestar.operators import records as P
from lodestar.operators.records import flatten
from lodestar.queries import sources as _sources  # noqa: F401 - registers the records that are exported
from lodestar.queries.common import AS_OF_SQL, ORACLES, QUERIES, events_as_of, load, ntz, register
from lodestar.queries.records import STARTUPS_SQL, startups, underscored
from lodestar.queries.resolution import _LOG_SQL, full_log
from lodestar.schemas import MAPPING_LOG, envelope_schema
from lodestar.session import scratch_path
from lodestar.sources import files as FS


@register("jsonl_round_trip", f"SELECT * FROM {STARTUPS_SQL}")
def q_jsonl_round_trip(spark, sf):
    """K1 + S1: nested STARTUP records -> JSONL (nulls written) -> strict
    scan with the record schema -> same flat rows."""
    path = K.write_jsonl(startups(spark, sf), scratch_path(spark, "startups-jsonl"))
    back = FS.read_jsonl(spark, path, envelope_schema("STARTUP"))
    return underscored(flatten(back, "startups"))


@register("csv_round_trip", f"{_LOG_SQL} SELECT * FROM log")
def q_csv_round_trip(spark, sf):
    """K4 + K5: mapping log exported as CSV with a header, read back with its schema."""
    out = K.export_tables({"entity_mapping_log": full_log(spark, sf)}, scratch_path(spark, "export"))
    return (spark.read.schema(MAPPING_LOG).option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(out["entity_mapping_log"]))


@register("flatten_export", f"""SELECT source_url, CASE WHEN content_data_employeeCount IS NULL THEN NULL
  ELSE content_data_employeeCount::VARCHAR END AS employeeCount, content_data_hq AS hq FROM {STARTUPS_SQL}""")
def q_flatten_export(spark, sf):
    """P7 + K4: flat CSV export of STARTUP records with dotted headers;
    null and empty values both come back as missing."""
    out = K.export_tables({"startups": startups(spark, sf)}, scratch_path(spark, "export"))
    back = spark.read.option("header", True).option("escape", '"').csv(out["startups"])
    return back.select(F.col("`source.url`").alias("source_url"),
                       F.col("`content.data.employeeCount`").alias("employeeCount"),
                       F.col("`content.data.hq`").alias("hq"))


@register("line_count", "SELECT count(*)::BIGINT AS lines FROM customer")
def q_line_count(spark, sf):
    """Line count of a written JSONL dataset."""
    c = load(spark, sf, "customer")
    path = K.write_jsonl(c, scratch_path(spark, "lines"))
    return FS.line_count(spark, path).select(F.col("lines").cast("bigint"))


_CUST_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])


def _with_bad_lines(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    path = K.write_jsonl(c, scratch_path(spark, "good"))
    lines = spark.read.text(path)
    bad = (load(spark, sf, "customer").where(F.col("c_custkey") % 10 == 0)
           .select(F.concat(F.lit('{"c_custkey": '), F.col("c_custkey").cast("string"), F.lit(", broken")).alias("value")))
    blank = load(spark, sf, "customer").where(F.col("c_custkey") % 25 == 0).select(F.lit("").alias("value"))
    mixed = scratch_path(spark, "mixed")
    lines.unionByName(bad).unionByName(blank).write.text(mixed)
    return mixed


@register("tolerant_scan", "SELECT c_custkey, c_name FROM customer")
def q_tolerant_scan(spark, sf):
    """Malformed lines are skipped, blank lines ignored, good rows kept."""
    return FS.read_jsonl_tolerant(spark, _with_bad_lines(spark, sf), _CUST_SCHEMA)


@register("tolerant_rejects", "SELECT count(*)::BIGINT AS rejected FROM customer WHERE c_custkey % 10 = 0")
def q_tolerant_rejects(spark, sf):
    """PERMISSIVE scan with ``_corrupt_record`` gives the reject count."""
    _, rej = FS.read_jsonl_tolerant(spark, _with_bad_lines(spark, sf), _CUST_SCHEMA, with_rejects=True)
    return rej


@register("prefer_nonempty", "SELECT c_custkey, c_name FROM customer")
def q_prefer_nonempty(spark, sf):
    """An existing but empty first choice falls through to the second."""
    empty = K.write_jsonl(load(spark, sf, "customer").select("c_custkey", "c_name").where(F.lit(False)),
                          scratch_path(spark, "empty"))
    full = K.write_jsonl(load(spark, sf, "customer").select("c_custkey", "c_name"), scratch_path(spark, "full"))
    return FS.prefer_nonempty(FS.read_jsonl(spark, empty, _CUST_SCHEMA), FS.read_jsonl(spark, full, _CUST_SCHEMA))


@register("versioned_rewrite", "SELECT c_custkey, upper(c_name) AS c_name FROM customer")
def q_versioned_rewrite(spark, sf):
    """K6: backup-then-rewrite into a new version; v0 stays intact."""
    base = scratch_path(spark, "versions")
    K.write_jsonl(load(spark, sf, "customer").select("c_custkey", "c_name"), f"{base}/v000000")
    nxt = K.rewrite_versioned(spark, base, _CUST_SCHEMA, lambda d: d.withColumn("c_name", F.upper("c_name")))
    return spark.read.schema(_CUST_SCHEMA).json(nxt)


# ------------------------------------------------------------------ streaming
_EV_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
                           T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])


def _two_drops(spark, sf):
    """Events landed as two JSON drops (even ids, then odd ids)."""
    base = scratch_path(spark, "stream")
    e = load(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), "user_id", "event_type")
    return base, [e.where(F.col("event_id") % 2 == 0), e.where(F.col("event_id") % 2 == 1)]


@register("stream_resume", "SELECT event_id, user_id, event_type FROM events")
def q_stream_resume(spark, sf):
    """Two availableNow runs over two drops; the second adds only new rows."""
    base, drops = _two_drops(spark, sf)
    for i, d in enumerate(drops):
        d.write.json(f"{base}/in/drop{i}")
        s = ST.landed_stream(spark, f"{base}/in/*", _EV_SCHEMA)
        ST.run_available(s, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type")


@register("stream_dedupe", """
SELECT event_type, user_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id % 2, event_id) rn FROM events)
WHERE rn = 1""")
def q_stream_dedupe(spark, sf):
    """Exact dedupe on (event_type, user_id) across runs: in-batch first
    wins, keys already in the sink are dropped."""
    base, drops = _two_drops(spark, sf)
    sink = f"{base}/dedup"
    schema = T.StructType(list(_EV_SCHEMA.fields) + [T.StructField("k", T.StringType())])
    for i, d in enumerate(drops):
        d.write.json(f"{base}/in/drop{i}")
        s = ST.landed_stream(spark, f"{base}/in/*", _EV_SCHEMA).withColumn(
            "k", F.concat_ws("|", "event_type", F.col("user_id").cast("string")))
        ST.run_available(s, None, f"{base}/ckpt", foreach_batch=ST.dedupe_into(spark, sink, "k", ["event_id"], schema))
    return spark.read.parquet(sink).select("event_type", "user_id", "event_id")


@register("stream_first_wins", """
SELECT event_type, user_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) rn FROM events WHERE user_id % 7 <> 0)
WHERE rn = 1 UNION ALL SELECT event_type, user_id, event_id FROM events WHERE user_id % 7 = 0""")
def q_stream_first_wins(spark, sf):
    """First row per key over all batches in any order of arrival, by keyed
    state; the drop with the odd ids comes first, so that later batches take
    keys over.  Rows without a key all stay."""
    base, drops = _two_drops(spark, sf)

    def upsert(batch, batch_id):
        batch.write.mode("overwrite").parquet(ST.batch_path(f"{base}/first", batch_id))

    for i, d in enumerate(reversed(drops)):
        d.write.json(f"{base}/in/drop{i}")
        s = ST.landed_stream(spark, f"{base}/in/*", _EV_SCHEMA).withColumn(
            "k", F.when(F.col("user_id") % 7 != 0, F.concat_ws("|", "event_type", F.col("user_id").cast("string"))))
        ST.run_available(ST.first_wins_stream(s, "k", ["event_id"]), None, f"{base}/ckpt", foreach_batch=upsert, mode="update")
    rows = spark.read.parquet(f"{base}/first")
    return ST.first_rows(rows, "k", ["event_id"]).select("event_type", "user_id", "event_id")


def _deduped(spark, sf, dedupe):
    base, drops = _two_drops(spark, sf)
    for i, d in enumerate(drops):
        d.write.json(f"{base}/in/drop{i}")
        s = dedupe(ST.landed_stream(spark, f"{base}/in/*", _EV_SCHEMA))
        ST.run_available(s, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").select("event_type", "user_id")


@register("stream_dedupe_state", "SELECT DISTINCT event_type, user_id FROM events")
def q_stream_dedupe_state(spark, sf):
    """T2 with the keys in the state store: one row per key over both drops."""
    return _deduped(spark, sf, lambda s: ST.dedupe_stateful(s, ["event_type", "user_id"]))


@register("stream_dedupe_bounded", "SELECT DISTINCT event_type, user_id FROM events")
def q_stream_dedupe_bounded(spark, sf):
    """T2 with a watermark that leaves all events of the table in reach."""
    return _deduped(spark, sf, lambda s: ST.dedupe_within_watermark(
        s.withColumn("at", F.to_timestamp("ts")), ["event_type", "user_id"], "at", "10000 days"))


def _gated(spark, sf):
    base, drops = _two_drops(spark, sf)
    as_of = events_as_of(spark, sf)
    for i, d in enumerate(drops):
        d.write.json(f"{base}/in/drop{i}")
        s = ST.landed_stream(spark, f"{base}/in/*", _EV_SCHEMA)
        fn = ST.fresh_gate(spark, f"{base}/kept", f"{base}/rej", f"{base}/funnel", "ts", as_of,
                           group="event_type")
        ST.run_available(s, None, f"{base}/ckpt", foreach_batch=fn)
    return base


@register("stream_fresh", f"SELECT event_id, date_trunc('second', ts) AS ts FROM events "
          f"WHERE date_trunc('second', ts) >= {AS_OF_SQL} - INTERVAL 24 HOUR")
def q_stream_fresh(spark, sf):
    """The freshness gate at arrival; late rows go to a side table."""
    base = _gated(spark, sf)
    return spark.read.parquet(f"{base}/kept").select("event_id", ntz("__ts__").alias("ts"))


@register("stream_funnel", f"""
SELECT (event_id % 2)::BIGINT AS batch_id, event_type, count(*)::BIGINT AS total,
  count_if(date_trunc('second', ts) >= {AS_OF_SQL} - INTERVAL 24 HOUR)::BIGINT AS kept,
  count_if(date_trunc('second', ts) < {AS_OF_SQL} - INTERVAL 24 HOUR)::BIGINT AS stale, 0::BIGINT AS undated
FROM events GROUP BY ALL""")
def q_stream_funnel(spark, sf):
    """T4: per-batch, per-source funnel counts written by the stream."""
    base = _gated(spark, sf)
    f = spark.read.parquet(f"{base}/funnel")
    return f.select(F.col("batch_id").cast("bigint").alias("batch_id"), "event_type", *[F.col(c).cast("bigint") for c in ("total", "kept", "stale", "undated")])


# ------------------------------------------------- K5: every table, every column
def _export_query(name: str, source: str):
    @register(name, ORACLES[source])
    def q(spark, sf):
        flat = QUERIES[source](spark, sf)
        path = K.write_csv(flat, scratch_path(spark, name))
        return (spark.read.schema(flat.schema).option("header", True).option("escape", '"').option("multiLine", True)
                .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    q.__doc__ = f"K4 + K5: the rows of {source} through a CSV export, all columns read back."


for _table, _source in (("startups", "startup_records"), ("products", "product_records"), ("jobs", "job_records"),
                        ("news", "news_records"), ("papers", "atom_source")):
    _export_query(f"export_{_table}", _source)


@register("csv_odd_values", r"""
SELECT event_id, event_type || ' "q", ' || chr(10) || ' l2' AS quoted, event_id % 3 = 0 AS flag,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE '  ' || user_id::VARCHAR || ' ' END AS spaced FROM events""")
def q_csv_odd_values(spark, sf):
    """K4: quotes, commas, line ends, booleans, outer blanks and nulls survive."""
    e = load(spark, sf, "events")
    k = F.col("event_id")
    odd = e.select(k, F.concat("event_type", F.lit(' "q", \n l2')).alias("quoted"), (k % 3 == 0).alias("flag"),
                   F.when(k % 4 != 0, F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" "))).alias("spaced"))
    path = K.write_csv(odd, scratch_path(spark, "odd"))
    return (spark.read.schema(odd.schema).option("header", True).option("escape", '"').option("multiLine", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


@register("required_file", "SELECT c_custkey, c_name FROM customer")
def q_required_file(spark, sf):
    """S3: a required JSONL file, read strictly."""
    path = K.write_jsonl(load(spark, sf, "customer").select("c_custkey", "c_name"), scratch_path(spark, "required"))
    return FS.read_jsonl(spark, path, _CUST_SCHEMA, missing_ok=False)


@register("stream_retry", f"""SELECT event_id, date_trunc('second', ts) AS ts FROM events
WHERE event_id % 2 = 0 AND date_trunc('second', ts) >= {AS_OF_SQL} - INTERVAL 24 HOUR""")
def q_stream_retry(spark, sf):
    """The same batch delivered twice leaves its rows once."""
    base, drops = _two_drops(spark, sf)
    fn = ST.fresh_gate(spark, f"{base}/kept", f"{base}/rej", f"{base}/funnel", "ts", events_as_of(spark, sf))
    for _ in range(2):
        fn(drops[0], 0)
    return spark.read.parquet(f"{base}/kept").select("event_id", ntz("__ts__").alias("ts"))


@register("validate_types", """
SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END::BIGINT AS size,
  CASE WHEN p_partkey % 7 = 0 THEN 'content.data.employeeCount:type' ELSE '' END AS violations FROM part""")
def q_validate_types(spark, sf):
    """V1: a value of the wrong type is a violation, not a failed job."""
    p = load(spark, sf, "part")
    raw = F.when(F.col("p_partkey") % 7 == 0, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    content = P.content_struct("STARTUP", entityName=F.col("p_name"), data={"employeeCount": F.col("raw_size")})
    env = p.withColumn("raw_size", raw).select(
        "p_partkey", "raw_size", *P.envelope("STARTUP", "part", F.lit("u"), F.lit("2026-01-01").cast("timestamp"), content))
    v = P.validate(env, "STARTUP", raw={"data.employeeCount": "raw_size"})
    return v.select("p_partkey", F.col("content.data.employeeCount").alias("size"),
                    F.array_join("violations", ",").alias("violations"))
