"""File scans (S1-S4, S13).  Always with an explicit schema, never inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import path_exists
from lodestar.sources.payloads import object_fields, with_objects


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               missing_ok: bool = True) -> DataFrame:
    """Strict JSONL scan; a malformed line fails the job; blank lines are
    skipped; a missing path gives an empty DataFrame of ``schema`` (S3 when
    ``missing_ok=False``: the normal path error)."""
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: T.StructType,
                        with_rejects: bool = False):
    """Resume scan that skips lines which are not JSON objects; blank lines
    do not count.  Which lines are rows does not depend on the columns that
    are selected: a field of another type is null and its line stays.  Of a
    repeated key the last value counts, and ``NaN`` is a number (as in S1).

    With ``with_rejects`` returns ``(good, rejected_count_df)``."""
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], schema)
        return (empty, spark.range(1).select(F.lit(0).cast("bigint").alias("rejected"))) \
            if with_rejects else empty
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    fields = {f.name: f.dataType.simpleString() for f in schema.fields}
    objects = with_objects(lines, F.col("value"), fields)
    good = objects.where("__is_object__").select(*object_fields(fields))
    if not with_rejects:
        return good
    return good, objects.agg(F.count_if(~F.col("__is_object__")).cast("bigint").alias("rejected"))


def prefer_nonempty(first: DataFrame, second: DataFrame) -> DataFrame:
    """``first`` unless it has no rows (missing or empty), else ``second``.
    ``isEmpty`` reads at most one row."""
    return first if not first.isEmpty() else second


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines of a text dataset (one-row DataFrame)."""
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"))
