"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import ensure_checkpoint_dir

# A word is a maximal run of anything but these six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def ship(df: DataFrame) -> DataFrame:
    """Make this package importable in the Python workers of the session of
    ``df``, once per application; a package run from a zip is shipped already."""
    sc = df.sparkSession.sparkContext
    root = Path(__file__).parent.parent
    if root.is_dir() and not getattr(sc, "_llm_shipped", False):
        base = Path(tempfile.mkdtemp(prefix="ship-")) / root.name
        sc.addPyFile(shutil.make_archive(str(base), "zip", root.parent, root.name))
        sc._llm_shipped = True
    return df


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared checkpoint folder.

    Reliable, so it outlives any executor, and Spark removes the files once
    the frame is no longer referenced (``cleanCheckpoints``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, with the scheme and host
    that Hadoop resolves it to: a plain path is on the default file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def small(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows; beyond
    that the hint is left off and the join is a shuffled one, which AQE
    splits where a key is skewed.  ``df`` should be checkpointed (it is counted)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def join_on(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys``; they come from the left side."""
    right = right.select(*[F.col(c).alias("r_" + c) if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col("r_" + k))
    return left.join(right, on, how).drop(*["r_" + k for k in keys])


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as decimal text, modulo ``n`` (null id: null text, fold 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


_CACHES: list[dict] = []


def sole(cache: dict) -> dict:
    """``cache``, an operator's cache in this Python worker; the caches that other
    operators have left there are emptied, so that stages do not add them up."""
    for other in _CACHES:
        if other is not cache:
            other.clear()
    if not any(other is cache for other in _CACHES):
        _CACHES.append(cache)
    return cache


def has_rows(df: DataFrame) -> bool:
    return len(df.take(1)) > 0
