"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per component (1 if it is positive).  Codes are
cut into segments of ``SEGMENT`` bits, and each segment has its own index.  In
round s every open query looks up, in every segment, all values at distance
exactly s from its own, and verifies the full Hamming distance of what it
finds.  After round s every code within ``segments * (s + 1) - 1`` has been
seen (by the pigeonhole principle), so a query is closed as soon as its k-th
verified distance is not above that; the other queries grow their radius.

Equal codes are one entry with their k smallest ids (no other id can be among
the first k), so a vector that holds a large share of all rows is one entry;
equal queries are answered once.  The index is dealt out once: each entry lies,
per segment, in the bucket of its value's first bits, with buckets for about
``INDEX_BLOCK`` entries.  In a round a query goes to the buckets that hold values
it looks up, at most as many as it has values, so that what is shuffled grows in
proportion to the rows.  A task looks the values up, verifies and returns at
most k candidates per query; no pairs are shuffled.  A bucket in which many codes
share a value is split by a hash of the code, and its queries go to every part.

Defined results: neighbours are ordered by distance, then id, and a query is
its own neighbour; null vectors and null ids are neither indexed nor queries;
null or NaN components count as not positive, missing trailing components too;
a query has fewer than k neighbours only if there are fewer rows; repeated ids
are counted once per code; empty tables give an empty result; other columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.common import cut, ship

SEGMENT = 16
INDEX_BLOCK = 1 << 14     # entries of a bucket, about
PAIRS = 1 << 20           # codes verified at a time


def encode_signs(dims: int):
    """(id, vector) -> (id, code): packed signs, whole segments."""
    size = -(-dims // SEGMENT) * SEGMENT

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            bits = np.zeros((len(ids), size), bool)
            lists = batch.column(1)
            n = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(len(ids)), n)
            place = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
            bits[row, place] = values > 0  # False for NaN, which stands for null too
            codes = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays([ids, pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "code"])
    return run


def segment_value(code, segment, bits: int):
    """First ``bits`` bits of a segment of a code."""
    value = F.conv(F.hex(F.substring(code, segment * (SEGMENT // 8) + 1, F.lit(SEGMENT // 8))), 16, 10).cast("int")
    return F.shiftright(value, SEGMENT - bits)


def sign_codes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, code) of all vectors, and the number of segments."""
    v = ship(vectors).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).dropna()
    dims = v.agg(F.max(F.size("v"))).first()[0] or 1
    return cut(v.mapInArrow(encode_signs(dims), "id long, code binary")), -(-dims // SEGMENT)


def masks(distance: int) -> np.ndarray:
    """All SEGMENT-bit numbers with ``distance`` bits set."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), distance)], np.uint16)


def as_words(codes) -> np.ndarray:
    return np.frombuffer(b"".join(codes), ">u2").reshape(len(codes), -1).astype(np.uint16) if len(codes) else np.zeros((0, 1), np.uint16)


def deal_queries(m: int, distance: int, bits: int):
    """(query, bound) -> (query, bound, segment, bucket) for every bucket of
    segment values that holds a value at ``distance`` from the query's own."""
    tops = np.unique(masks(distance) >> (SEGMENT - bits)) if bits else np.zeros(1, np.uint16)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                words = as_words(part.column(0).to_pylist()) >> (SEGMENT - bits) if bits else np.zeros((part.num_rows, m), np.uint16)
                buckets = (words[:, :, None] ^ tops).astype(np.int32)
                row, segment, _ = np.indices(buckets.shape)
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(pa.array(row.ravel())) for c in part.columns], pa.array(segment.ravel().astype(np.int32)),
                     pa.array(buckets.ravel())], ["query", "bound", "segment", "bucket"])
    return run


def probe(k: int, distance: int):
    """A bucket of a segment's index against the queries that look into it:
    per query at most ``k`` entries, the nearest of the smallest ids."""
    flips = masks(distance)

    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(queries):
            segment = int(entries["segment"].iloc[0])
            codes, asked = as_words(entries["code"].tolist()), as_words(queries["query"].tolist())
            first = entries["first_id"].to_numpy()
            order = np.argsort(codes[:, segment], kind="stable")
            starts = np.searchsorted(codes[order, segment], np.arange((1 << SEGMENT) + 1))
            bound = queries["bound"].to_numpy()
            step = max(1, (1 << 20) // len(flips))
            for q0 in range(0, len(asked), step):
                values = (asked[q0:q0 + step, segment, None] ^ flips).astype(np.int64)
                a, n = starts[values].ravel(), (starts[values + 1] - starts[values]).ravel()
                look = np.flatnonzero(n)
                ends = np.cumsum(n[look])
                for i, j in spans_of(ends, PAIRS):
                    some = look[i:j]
                    m, total = n[some], int(n[some].sum())
                    place = np.repeat(a[some] - (np.cumsum(m) - m), m) + np.arange(total)
                    hit, q = order[place], np.repeat(some // len(flips), m) + q0
                    d = np.bitwise_count(codes[hit] ^ asked[q]).sum(1).astype(np.int64)
                    near = d <= bound[q]
                    hit, q, d = hit[near], q[near], d[near]
                    best = np.lexsort((first[hit], d, q))
                    hit, q, d = hit[best], q[best], d[best]
                    nth = np.arange(len(q)) - np.searchsorted(q, q)
                    keep = nth < k
                    out.append((q[keep], d[keep], hit[keep]))
        q, d, hit = (np.concatenate(x) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame({"query": queries["query"].to_numpy()[q], "distance": d, "code": entries["code"].to_numpy()[hit],
                             "first_id": entries["first_id"].to_numpy()[hit], "n": entries["n"].to_numpy()[hit]})
    return run


def spans_of(ends: np.ndarray, size: int):
    """Index ranges of about ``size`` in sum, at least one item each."""
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
        yield i, j
        i = j


FOUND = "query binary, distance long, code binary, first_id long, n long"


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per query and neighbour: id_col, rank (from 1), neighbor_id,
    distance.  ``is_query`` is a condition on ``F.col("id")``."""
    spark = vectors.sparkSession
    codes, m = sign_codes(vectors, id_col, vec_col)
    smallest = Window.partitionBy("code").orderBy("id")
    entries = cut(codes.distinct().withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k)
                  .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                  .select("code", "ids", F.element_at("ids", 1).alias("first_id"), F.size("ids").cast("long").alias("n")))
    n_entries, n_ids = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = codes.where(is_query)
    queries = cut(asked.select(F.col("code").alias("query")).distinct())
    want = min(k, n_ids)  # ids an answer can have; n_ids counts up to k a code
    bits = min(max(n_entries - 1, 0) // INDEX_BLOCK, (1 << SEGMENT) - 1).bit_length()

    # The index: every entry once per segment, in the bucket of its value's first bits.
    index = (entries.select("code", "first_id", "n").withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
             .withColumn("bucket", segment_value(F.col("code"), F.col("segment"), bits)))
    # A bucket of more entries than usual (a value that many codes share) is split; its queries go to all parts.
    parts = cut(index.groupBy("segment", "bucket").agg(
        F.ceil(F.count(F.lit(1)) / (2 * INDEX_BLOCK)).cast("int").alias("parts")))
    index = cut(index.join(parts, ["segment", "bucket"]).withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
                .drop("parts"))
    keys = ["segment", "bucket", "part"]
    found = spark.createDataFrame([], FOUND)
    active = queries.withColumn("bound", F.lit(m * SEGMENT).cast("long"))
    for s in range(SEGMENT + 1):
        spread = (active.select("query", "bound").mapInArrow(
            deal_queries(m, s, bits), "query binary, bound long, segment int, bucket int")
            .join(parts, ["segment", "bucket"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
        new = index.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(probe(k, s), FOUND)
        # Ids at smaller distances come first; at its own distance any entry can hold the next smallest id.
        nearer = Window.partitionBy("query").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        level = Window.partitionBy("query", "distance").orderBy("first_id")
        found = cut(found.union(new).distinct()
                    .withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
                    .withColumn("nth", F.row_number().over(level))
                    .where((F.col("before") < k) & (F.col("nth") <= k)).drop("before", "nth"))
        state = found.groupBy(F.col("query").alias("of")).agg(F.sum("n").alias("have"), F.max("distance").alias("kth"))
        covered = m * (s + 1) - 1
        active = cut(queries.join(state, F.col("query") == F.col("of"), "left")
                     .where(F.col("have").isNull() | (F.col("have") < want) | (F.col("kth") > covered))
                     .select("query", F.when(F.col("have") >= want, F.col("kth")).otherwise(m * SEGMENT).cast("long").alias("bound")))
        if not active.take(1):
            break
    ids = entries.select(F.col("code").alias("entry"), "ids")
    place = Window.partitionBy("query").orderBy("distance", "neighbor_id")
    answers = (found.join(ids, F.col("code") == F.col("entry"))
               .select("query", "distance", F.explode("ids").alias("neighbor_id"))
               .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
               .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "neighbor_id", "distance"))).alias("top")))
    return (asked.join(answers, F.col("code") == F.col("query")).select("id", F.explode("top").alias("t"))
            .select(F.col("id").alias(id_col), "t.rank", "t.neighbor_id", "t.distance"))
