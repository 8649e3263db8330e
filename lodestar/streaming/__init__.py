"""Structured Streaming operators (T1-T4): incremental landing with resume,
exact cross-run dedupe, freshness gate at arrival and per-batch funnels.

All streams use ``trigger(availableNow=True)`` by default: each run drains
what has landed and stops, and the checkpoint makes the next run resume
with only new files (T1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.dates import is_fresh, parse_flexible_date
from lodestar.operators.dedupe import first_wins
from lodestar.session import path_exists
from lodestar.streaming.keyed_first import first_rows, first_wins_stream  # noqa: F401


def landed_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                  max_files: int | None = None) -> DataFrame:
    """Streaming file source with an explicit schema."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def run_available(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                  foreach_batch=None, query_name: str | None = None, mode: str = "append") -> None:
    """Drain everything landed so far, then stop (resumable by checkpoint)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).outputMode(mode).start()
    else:
        q = w.format(fmt).option("path", sink).outputMode(mode).start()
    q.awaitTermination()


def batch_path(base: str, batch_id: int) -> str:
    """``foreachBatch`` is at-least-once: each batch owns one partition of the
    output and overwrites it, so a retried batch replaces what it wrote."""
    return f"{base.rstrip('/')}/batch_id={batch_id}"


def dedupe_into(spark: SparkSession, sink: str, key: str, order, schema: T.StructType, buckets: int = 64):
    """T2 (exact, unbounded): a ``foreachBatch`` function that keeps the first
    row per key inside the batch (by ``order``), drops keys that earlier
    batches have put into the sink, and writes the rest.

    The keys of the sink are kept next to it (``<sink>_keys``), partitioned by
    a hash of the key: a batch reads the partitions of its own keys only.
    Rows with a null key are never duplicates.  :func:`first_wins_stream` does
    not depend on the history, and lets an earlier row win that arrives later."""
    keys = f"{sink.rstrip('/')}_keys"
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    key_type = next(f.dataType for f in schema.fields if f.name == key)
    key_schema = T.StructType([T.StructField(key, key_type), T.StructField("batch", T.LongType()),
                               T.StructField("bucket", T.IntegerType())])

    def fn(batch: DataFrame, batch_id: int) -> None:
        b = first_wins(batch, key, order)
        if path_exists(spark, keys):
            used = [r[0] for r in batch.select(at.alias("bucket")).distinct().collect()]  # at most ``buckets``
            done = (spark.read.schema(key_schema).parquet(keys)
                    .where(F.col("bucket").isin(used) & (F.col("batch") != batch_id)).select(key))
            b = b.join(done, key, "left_anti")
        b.write.mode("overwrite").parquet(batch_path(sink, batch_id))
        new = spark.read.schema(batch.schema).parquet(batch_path(sink, batch_id)).where(F.col(key).isNotNull())
        (new.select(key, F.lit(batch_id).cast("long").alias("batch"), at.alias("bucket"))
         .write.mode("append").partitionBy("bucket").parquet(keys))
    return fn


def dedupe_stateful(df: DataFrame, keys) -> DataFrame:
    """T2 (exact, incremental): keys live in the state store (use the RocksDB
    provider for large key sets), so each batch costs O(batch), not a scan
    of the sink.  Which duplicate *within one batch* survives is arrival
    order, not a column order; use :func:`dedupe_into` when the first row by
    an explicit order must win."""
    return df.dropDuplicates(list(keys))


def dedupe_within_watermark(df: DataFrame, keys, event_time: str, delay: str) -> DataFrame:
    """T2 (bounded): state kept only until the watermark passes; a key seen
    again after that is emitted again (documented approximation)."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def fresh_gate(spark: SparkSession, kept: str, rejected: str, funnel: str, date_col: str,
               as_of, hours: int = 24, group: str | None = None):
    """T3 + T4: a ``foreachBatch`` function that parses the raw date, keeps
    fresh rows, sends late/undated rows to a side table with a reason, and
    writes one funnel row per batch (and group).  Each output has a partition
    per batch (``batch_id``), which a retried batch overwrites."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("__ts__", parse_flexible_date(F.col(date_col), as_of))
        b = b.withColumn("__fresh__", is_fresh(F.col("__ts__"), as_of, hours))
        b.persist()
        try:
            b.where(F.col("__fresh__")).drop("__fresh__").write.mode("overwrite").parquet(batch_path(kept, batch_id))
            (b.where(~F.col("__fresh__"))
             .withColumn("reason", F.when(F.col("__ts__").isNull(), F.lit("undated")).otherwise(F.lit("stale")))
             .drop("__fresh__").write.mode("overwrite").parquet(batch_path(rejected, batch_id)))
            keys = [group] if group else []
            (b.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"),
                                  F.count_if(F.col("__fresh__")).alias("kept"),
                                  F.count_if(~F.col("__fresh__") & F.col("__ts__").isNotNull()).alias("stale"),
                                  F.count_if(F.col("__ts__").isNull()).alias("undated"))
             .write.mode("overwrite").parquet(batch_path(funnel, batch_id)))
        finally:
            b.unpersist()
    return fn
