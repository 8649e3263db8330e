"""Exact de-duplication with a heavy-hitter split.

Texts are equal when identical after replacing each run of ASCII blanks by
one space; their key is the SHA-256 of that normalised text.

1. One pass computes a narrow table (id, digest), which is checkpointed.
2. Every task keeps a Misra-Gries summary of its digests (``counters``
   counters); summaries are added up and the largest ``counters`` kept.  Every
   digest with more than ``2 N / (counters + 1)`` of the ``N`` rows is among
   them, so what is left has no group above that share.
3. The candidates are verified: one exact count and one winner per digest,
   aggregated map-side.  At most ``counters`` rows: this bounds the broadcast.
4. Rows of heavy digests are settled map-side against the broadcast winners;
   the rest goes through an ordinary shuffle on the digest.

Defined results: a null text counts as empty; of equal texts the smallest
non-null id stays, a null id only if no other is there; of rows with the same
id and text exactly one stays; an empty table gives an empty result; other
columns of any name pass through untouched.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestar.llm.common import BLANKS, cut, fresh, ship

COUNTERS = 1024


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def shrink(counts: dict, k: int) -> dict:
    """Merge step of Misra-Gries: subtract the (k+1)-th largest counter."""
    if len(counts) <= k:
        return counts
    least = heapq.nlargest(k + 1, counts.values())[-1]
    return {d: n - least for d, n in counts.items() if n > least}


def summaries(k: int):
    """One Misra-Gries summary per task, from Arrow batches of digests."""
    def run(batches):
        counts: dict = {}
        for b in batches:
            for x in pc.value_counts(b.column(0)).to_pylist():
                counts[x["values"]] = counts.get(x["values"], 0) + x["counts"]
            counts = shrink(counts, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "n"])
    return run


def heavy_digests(keys: DataFrame, k: int) -> DataFrame:
    """Candidates for frequent digests: at most ``k`` rows (digest)."""
    parts = ship(keys).select("digest").mapInArrow(summaries(k), "digest binary, n long")
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k).select("digest")


def winners(keys: DataFrame, order: list[str], k: int) -> DataFrame:
    """Verified winners of the heavy digests: (digest, w, group_size), at most
    ``k`` rows; ``w`` is the smallest ``order`` struct of the group."""
    found = keys.join(F.broadcast(heavy_digests(keys, k)), "digest")
    return cut(found.groupBy("digest")
               .agg(F.min(F.struct(*order)).alias("w"), F.count(F.lit(1)).alias("group_size"))
               .where("group_size > 1"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    keys = cut(docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"),
                           F.monotonically_increasing_id().alias("row")))
    keys = keys.withColumn("no_id", F.col("id").isNull())
    order = ["no_id", "id", "row"]
    won = F.broadcast(winners(keys, order, counters))
    heavy = keys.join(won, "digest").select(
        "id", F.col("w.id").alias("keep_id"), "group_size", (F.col("row") == F.col("w.row")).alias("kept"), "digest")
    group = Window.partitionBy("digest")
    rest = (keys.join(won, "digest", "left_anti")
            .withColumn("w", F.min(F.struct(*order)).over(group))
            .withColumn("group_size", F.count(F.lit(1)).over(group))
            .select("id", F.col("w.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("w.row")).alias("kept"), "digest"))
    return heavy.unionByName(rest).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of the type (no maps and variants inside)."""
    return not any(x in kind.simpleString() for x in ("map<", "variant"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``.

    Losers of heavy groups are dropped map-side, before any whole row is
    shuffled.  Rows equal in id and text but not in other columns are ordered
    by a hash of the row (without map and variant columns), so reruns agree; of
    rows equal in all that is hashed one stays."""
    d, r, n, wd, w = fresh(docs, "digest", "row_hash", "nth", "w_digest", "w")
    wide = (docs.withColumn(d, digest(F.col(text_col)))
            .withColumn(r, F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if hashable(f.dataType)])))
    keys = cut(wide.select(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(r).alias("row"),
                           F.col(d).alias("digest")))
    won = F.broadcast(winners(keys, ["no_id", "id", "row"], counters)
                      .select(F.col("digest").alias(wd), F.col("w").alias(w)))
    same = F.col(d) == F.col(wd)
    heavy = (wide.join(won, same).where(F.col(f"{w}.id").eqNullSafe(F.col(id_col)) & (F.col(f"{w}.row") == F.col(r)))
             .dropDuplicates([id_col, r, d]).select(*docs.columns))
    first = Window.partitionBy(d).orderBy(F.col(id_col).asc_nulls_last(), r)
    rest = (wide.join(won, same, "left_anti").withColumn(n, F.row_number().over(first))
            .where(F.col(n) == 1).select(*docs.columns))
    return heavy.unionByName(rest)
