"""Sinks (K1-K6): JSONL, CSV export, versioned rewrite."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.records import flatten
from lodestar.schemas import FLAT_COLUMNS
from lodestar.session import list_names, path_exists
from lodestar.sources.files import read_jsonl


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K1 / K2: JSON lines; null fields are written (Spark drops them by default).
    ``mode="append"`` adds one finished unit per call (visible once complete:
    the job commit publishes all files of the unit at once)."""
    (df.write.mode(mode).option("ignoreNullFields", False)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
    return path


def publish(spark: SparkSession, sink_path: str, schema: T.StructType, final_path: str) -> str:
    """K3: the sink (all runs, resumed ones included) is the source of truth;
    copy it to the final location.  A malformed line fails the job (S1)."""
    return write_jsonl(read_jsonl(spark, sink_path, schema, missing_ok=False), final_path)


def csv_ready(df: DataFrame) -> DataFrame:
    """K4 value rendering: booleans as ``True``/``False`` (Python style)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(c, F.lit("True")).when(~c, F.lit("False"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, columns=None, mode: str = "overwrite") -> str:
    """K4: header row, fixed column list (extra columns ignored), null and
    empty both written as nothing, quotes doubled, whitespace kept."""
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    (csv_ready(df).write.mode(mode)
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .csv(path))
    return path


def export_tables(tables: dict, out_dir: str) -> dict:
    """K5: one CSV directory per table; nested records are flattened."""
    out = {}
    for name, df in tables.items():
        flat = df if name == "entity_mapping_log" else flatten(df, name)
        out[name] = write_csv(flat, f"{out_dir.rstrip('/')}/{name}", FLAT_COLUMNS[name])
    return out


def next_version(spark: SparkSession, base: str) -> tuple[str | None, str]:
    """K6: (current version path or None, next version path) under ``base``.
    A version is current only if its write has finished (``_SUCCESS``); the
    next number is above every folder there is, so what a crashed write left
    is neither read nor written to."""
    base = base.rstrip("/")
    found = sorted(int(n[1:]) for n in list_names(spark, base) if re.fullmatch(r"v\d{6}", n))
    done = [n for n in found if path_exists(spark, f"{base}/v{n:06d}/_SUCCESS")]
    return (f"{base}/v{done[-1]:06d}" if done else None), f"{base}/v{(found[-1] + 1 if found else 0):06d}"


def rewrite_versioned(spark: SparkSession, base: str, schema: T.StructType, transform) -> str:
    """K6: backup-then-rewrite without ever overwriting the path being read:
    read the current version, apply ``transform``, write the next version.
    The previous version stays as the backup."""
    cur, nxt = next_version(spark, base)
    df = read_jsonl(spark, cur, schema) if cur else spark.createDataFrame([], schema)
    write_jsonl(transform(df), nxt)
    return nxt
