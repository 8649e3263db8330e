"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from lodestar.llm import spelling


def brute_words(rows, every=199, min_length=6, min_count=5):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{w}".encode())
            if h % every == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if k >= min_count and len(w) >= min_length}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_groups(n, ratio=5):
    forms, out = {}, {}
    for w in n:
        near = [x for x in n if abs(len(x) - len(w)) <= 1 and one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best and n[best] >= ratio * n[w] else None
        out[w] = len(near)
    rows = set()
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n[w], out[w], n.get(forms[w])))
    return rows


def test_counts_and_groups_equal_brute_force(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choices("abéx", k=rng.randint(5, 9))) for _ in range(60)]
    words = stems + [w[:k] + c + w[k + d:] for w in stems[:20] for k, c, d in
                     [(rng.randrange(5), rng.choice("abz"), rng.choice((0, 1))) for _ in range(6)]]
    weights = [rng.choice((1, 5, 40)) for _ in words]
    rows = [(k, " ".join(w.title() if rng.random() < .3 else w for w in rng.choices(words, weights, k=120))) for k in range(60)]
    rows += [(None, rows[0][1]), (1, rows[1][1]), (99, None), (100, ""), (101, "x" * 50_000 + " " + "×÷ÀÿŁ1a")]
    rows += [(200 + k, "chainaaaa " * 60 + "chainaaab " * 9 + "chainaabb") for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS key").repartition(5)
    want = brute_groups(brute_words(rows, every=7))
    got = {tuple(r) for r in spelling.spelling_groups(docs, every=7).collect()}
    assert got == want and any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


@pytest.mark.parametrize("block", [2, 4, 512])
def test_small_blocks_are_halved_and_lose_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    rng = random.Random(block)
    words = {"".join(rng.choices("ab", k=rng.randint(5, 9))) for _ in range(300)} | {"prefixes" + x for x in "abcdefghij"}
    words |= {"same" + x + y for x in "abcdefgh" for y in "abcdefgh"}
    n = {w: rng.choice((5, 6, 40, 300)) for w in words}
    got = {r.word: (r.n_near, r.near, r.near_n) for r in
           spelling.near_words(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    want = {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-n[x], x))
            want[w] = len(near), best, n[best]
    assert got == want


def test_typo_rule():
    hits = [k for k in range(2000) if zlib.crc32(f"{k}:lettering".encode()) % 199 == 0]
    for k in hits:
        at = zlib.crc32(f"{k}:lettering".encode()) % 9
        assert spelling.typo(k, "lettering", 199) == "lettering"[:at] + "lettering"[at + 1:]
    assert hits and spelling.typo(hits[0] + 1, "lettering", 199) == "lettering"


def test_odd_rows_and_empty_table(spark, odd, empty):
    want = brute_groups(brute_words([(r.doc_id, r.text) for r in odd.collect()], min_count=1))
    assert {tuple(r) for r in spelling.spelling_groups(odd, min_count=1).collect()} == want
    assert spelling.spelling_groups(empty).count() == 0
