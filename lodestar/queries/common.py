"""Shared helpers for the registered queries over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a ``(spark, sf_dir) -> DataFrame`` query and its
    DuckDB oracle SQL (None = no SQL twin)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Read a driver table.  Naive parquet timestamps (TIMESTAMP_NTZ) are
    read as UTC instants; the session zone is pinned to UTC for that."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def ntz(c):
    """Output form of an instant: UTC wall time without zone (compares equal
    to DuckDB's naive TIMESTAMP whatever the client time zone)."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def events_as_of(spark: SparkSession, sf: str):
    """``as_of`` for the dated fixtures: the latest event time.  A value, as
    callers of the flows pass one (the date parser binds it inside lambdas,
    where Spark takes no scalar subquery); one column is read for it."""
    v = load(spark, sf, "events").agg(F.max("ts").cast("timestamp_ntz")).first()[0]
    return v.replace(tzinfo=dt.timezone.utc)


def paper_number(n):
    """A paper id (yymm.number) for any number below ten million."""
    n = F.col(n) if isinstance(n, str) else n
    return F.concat((F.lit(2401) + F.floor(n / 100000)).cast("string"), F.lit("."),
                    F.lpad((n % 100000).cast("string"), 5, "0"))


def paper_number_sql(n: str) -> str:
    return f"((2401 + ({n}) // 100000)::BIGINT::VARCHAR || '.' || lpad((({n}) % 100000)::VARCHAR, 5, '0'))"


AS_OF_SQL = "(SELECT max(ts) FROM events)"
