"""LCS lengths for Arrow batches of string pairs.

The bit-parallel recurrence of Crochemore, Iliopoulos, Pinzon and Reid (2001)
on integers of any length: with ``V`` all ones and ``M[c]`` the bit mask of the
places of ``c`` in ``a``, for each character ``c`` of ``b``:
``U = V & M[c]; V = (V + U) | (V - U)``; the length is the number of zero bits
among the low ``len(a)`` bits of ``V``.  A character of ``b`` costs
``len(a) / 64`` word operations, and a pair needs memory for its masks only.
"""

from __future__ import annotations

import pandas as pd


def lcs_length(a: str, b: str) -> int:
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    bit = 1
    for c in a:
        places[c] = places.get(c, 0) | bit
        bit <<= 1
    full = v = bit - 1
    for c in b:
        if m := places.get(c):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def lcs_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    """LCS length per pair (nulls count as empty strings)."""
    return pd.Series([lcs_length(x, y) for x, y in zip(a.fillna(""), b.fillna(""))], dtype="int64")
