"""Candidate pairs of long strings under the Indel ratio, by a positional
prefix filter on q-grams.

Let two strings of lengths ``l1`` and ``l2`` reach the ratio ``threshold``:
``l1`` becomes ``l2`` by ``dels`` deletions and ``ins`` insertions, together at
most ``tau = (100 - threshold)% of l1 + l2``, with ``dels - ins = l1 - l2``.  A
deletion breaks at most ``q`` grams of the first string, an insertion ``q - 1``;
all others stand in the second string too, in the same order.  Sort the grams of
both strings by (how many the forms have, gram, place).  The first gram that
survives has at most the broken ones before it, on either side, so both strings
hold it among their first ``(2q - 1) * dels - (q - 1) * (l1 - l2) + 1`` grams, and
its places differ by at most ``dels`` one way and ``ins`` the other.

A string therefore gives rows linear in its length, rare grams first; a gram
that no form has gives none.  How often the forms have a gram is counted in
``BUCKETS`` counters by its hash: an array of fixed size, a scalar subquery.  A
shared counter only changes the order, which is the same for names and forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.similarity import chars

BUCKETS = 1 << 14


def gram_size(threshold: int) -> int:
    """The longest grams (up to 4) of which the edits leave a good share whole."""
    return max(q for q in (1, 2, 3, 4) if q == 1 or (2 * q - 1) * (100 - threshold) <= 60)


def _grams(text: Column, q: int, used: Column) -> Column:
    """Hashes of all q-grams in order of place; none where not ``used``."""
    all_grams = F.transform(F.array(chars(text)), lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - q), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(q)])))[0]
    return F.when(used & (F.length(text) >= q), all_grams).otherwise(F.array().cast("array<bigint>"))


def _bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def _counts(grams: DataFrame) -> Column:
    """Scalar subquery: the forms' grams per bucket, all buckets in order."""
    spark = grams.sparkSession
    seen = (grams.select(F.explode_outer("grams").alias("g")).where("g is not null")
            .select(_bucket(F.col("g")).alias("b"), F.lit(1).alias("n")))
    all_buckets = spark.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("b"), F.lit(0).alias("n"))
    n = seen.unionByName(all_buckets).groupBy("b").agg(F.sum("n").alias("n"))
    return n.agg(F.sort_array(F.collect_list(F.struct("b", "n"))).alias("c")).select("c.n").scalar()


def _prefix(df: DataFrame, key: str, length: str, counts: Column, q: int, threshold: int) -> DataFrame:
    """(key, length, g, first, last): the distinct grams of each string's prefix with
    their first and last place there; grams without a count are left out."""
    l = F.col(length)
    t = F.lit(100 - threshold)
    lo = F.floor(l * threshold / (200 - threshold)).cast("int") - 1
    hi = F.ceil(l * (200 - threshold) / F.lit(threshold)).cast("int") + 1

    def broken(other: Column) -> Column:
        tau, gap = F.floor((l + other) * t / F.lit(100)), l - other
        return F.when(F.abs(gap) <= tau, (2 * q - 1) * F.floor((tau + gap) / F.lit(2)) - (q - 1) * gap).otherwise(0)
    df = df.withColumn("most", F.array_max(F.transform(F.sequence(F.greatest(lo, F.lit(0)), hi), broken)).cast("int"))
    # One use of ``counts``, so that Catalyst puts the subquery where it is read and no row carries it.
    df = df.withColumn("counts", counts)
    df = df.withColumn("prefix", F.slice(F.sort_array(F.transform("grams", lambda g, i: F.struct(
        F.get("counts", _bucket(g)).alias("n"), g.alias("g"), i.alias("at")))), F.lit(1), F.col("most") + 1))
    p = F.col("prefix")
    starts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1)["g"] != x["g"]))
    ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1)["g"] != x["g"]))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a["n"].alias("n"), a["g"].alias("g"),
                                                          a["at"].alias("first"), b["at"].alias("last")))
    return (df.select(key, length, F.explode_outer(runs).alias("r")).where("r.n > 0")
            .select(key, length, "r.g", "r.first", "r.last"))


def prefixes(names: DataFrame, forms: DataFrame, threshold: int, above: int) -> tuple[DataFrame, DataFrame]:
    """Prefix rows of the names (nid, q_sorted, l1) and the forms (fid, sorted_norm,
    l2) that can make a pair whose form is longer than ``above`` (16 or more, so that
    a gram survives).  The choice is made in the arrays, not by a filter, and exploded
    by ``explode_outer``: a filter, also the one Catalyst infers from ``explode``, would
    be pushed below the caller's exchange, which all branches are to share."""
    q = gram_size(threshold)
    f = forms.select("fid", "l2", _grams(F.col("sorted_norm"), q, F.col("l2") > above).alias("grams"))
    reach = F.col("l1") * (200 - threshold) / F.lit(threshold) + 2
    n = names.select("nid", "l1", _grams(F.col("q_sorted"), q, reach > above).alias("grams"))
    counts = _counts(f)
    return (_prefix(n, "nid", "l1", counts, q, threshold),
            _prefix(f, "fid", "l2", counts, q, threshold)
            .withColumnsRenamed({"first": "first2", "last": "last2"}))


def long_pairs(names: DataFrame, forms: DataFrame, threshold: int, above: int) -> DataFrame:
    """(nid, fid), with repeats: every pair that can reach the threshold and whose
    form is longer than ``above``."""
    n, f = prefixes(names, forms, threshold, above)
    l1, l2 = F.col("l1"), F.col("l2")
    tau = F.floor((l1 + l2) * F.lit(100 - threshold) / F.lit(100))
    dels, ins = F.floor((tau + l1 - l2) / F.lit(2)), F.floor((tau - l1 + l2) / F.lit(2))
    return (n.join(f, "g")
            .where((F.abs(l1 - l2) <= tau)
                   & (F.col("first") - F.col("last2") <= dels) & (F.col("first2") - F.col("last") <= ins))
            .select("nid", "fid"))
