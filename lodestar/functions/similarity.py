"""Similarity scalars (X16, X17): token sort and the Indel similarity ratio.

The ratio is ``100 * (1 - indel / (len1 + len2))`` with
``indel = len1 + len2 - 2 * LCS``: a substitution costs 2, unlike
``levenshtein``.  LCS is a dynamic program written with nested
``aggregate`` so it stays inside the JVM (no Python worker round trip).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.text import col_of, token_sort

__all__ = ["chars", "lcs_length", "lcs_length_batched", "indel_distance", "indel_ratio", "token_sort_ratio",
           "passes_threshold", "cheap_bound_ok"]


def chars(c) -> Column:
    """Array of the code points of a string (as 1-char strings)."""
    c = col_of(c)
    return F.when(F.length(c) > 0,
                  F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substr(c, i, F.lit(1)))) \
        .otherwise(F.array().cast("array<string>"))


def lcs_length(a, b) -> Column:
    """Length of the longest common subsequence, row-by-row DP in O(len(a)*len(b))."""
    a, b = col_of(a), col_of(b)
    bc = chars(b)
    lb = F.size(bc)

    def row(prev, ca):
        return F.aggregate(
            F.sequence(F.lit(1), lb), F.array(F.lit(0)),
            lambda cur, j: F.concat(cur, F.array(
                F.when(ca == bc[j - 1], prev[j - 1] + 1)
                .otherwise(F.greatest(prev[j], cur[j - 1])))))

    dp = F.aggregate(chars(a), F.array_repeat(F.lit(0), lb + 1), row, lambda last: last[lb])
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(dp)


def indel_distance(a, b, lcs=None) -> Column:
    a, b = col_of(a), col_of(b)
    lcs = lcs_length(a, b) if lcs is None else lcs
    return F.length(a) + F.length(b) - 2 * lcs


def indel_ratio(a, b, lcs=None) -> Column:
    """Similarity 0..100; two empty strings score 100."""
    a, b = col_of(a), col_of(b)
    total = F.length(a) + F.length(b)
    dist = indel_distance(a, b, lcs)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        (F.lit(1.0) - dist / total) * F.lit(100.0))


def token_sort_ratio(a, b) -> Column:
    """Indel ratio of the token-sorted strings."""
    return indel_ratio(token_sort(a), token_sort(b))


def cheap_bound_ok(a, b, threshold: int = 90) -> Column:
    """Lossless pre-tests for ``ratio >= threshold`` on already-sorted strings:
    the length gap and Levenshtein (never above Indel) must both fit the
    Indel budget ``(len1+len2) * (100-threshold) / 100``."""
    a, b = col_of(a), col_of(b)
    total = F.length(a) + F.length(b)
    budget = F.floor(total * F.lit(100 - threshold) / F.lit(100)).cast("int")
    return ((F.abs(F.length(a) - F.length(b)) <= budget)
            & (F.call_function("levenshtein", a, b, budget) >= 0))


def passes_threshold(a, b, threshold: int = 90, lcs=None) -> Column:
    """Exact integer form of ``indel_ratio(a, b) >= threshold``:
    ``100 * indel <= (100 - threshold) * (len1 + len2)``."""
    a, b = col_of(a), col_of(b)
    total = F.length(a) + F.length(b)
    return (F.lit(100) * indel_distance(a, b, lcs)) <= F.lit(100 - threshold) * total


_LCS_UDF = None


def lcs_length_batched(a, b) -> Column:
    """LCS length via an Arrow-batched pandas UDF (bit-parallel, any length;
    see ``lcs_batch``).  Same values as :func:`lcs_length`; far cheaper when
    many pairs need an exact score.  The helper module is pickled by value,
    so executors need only pandas, not this package."""
    global _LCS_UDF
    if _LCS_UDF is None:
        from pyspark import cloudpickle
        from pyspark.sql.functions import pandas_udf

        from lodestar.functions import lcs_batch
        cloudpickle.register_pickle_by_value(lcs_batch)
        _LCS_UDF = pandas_udf(lcs_batch.lcs_lengths, "long")
    return _LCS_UDF(col_of(a), col_of(b))
