"""The LCS scorer against the plain dynamic program, for short and long strings."""

import random

import pandas as pd

from lodestar.functions.lcs_batch import lcs_length, lcs_lengths


def plain(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_of_any_length():
    rng = random.Random(1)
    for longest in (3, 20, 64, 65, 200):
        for _ in range(40):
            a, b = ("".join(rng.choices("abcé\U0001f642", k=rng.randint(0, longest))) for _ in range(2))
            assert lcs_length(a, b) == plain(a, b)


def test_long_texts_and_nulls():
    text = "".join(random.Random(2).choices("abcdefgh ", k=20_000))
    assert lcs_length(text, text[:9_000] + text[9_010:]) == 19_990
    assert lcs_lengths(pd.Series([None, "ab", ""]), pd.Series(["x", "b", None])).tolist() == [0, 1, 0]
