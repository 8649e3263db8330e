"""Exact and near-duplicates against brute force, and their defined edge cases."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from lodestar.llm import exact_dedup as ex
from lodestar.llm import near_dedup as nd
from lodestar.llm.graph import components

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def normal(t):
    return BLANK.sub(" ", t or "")


def test_misra_gries_finds_every_frequent_digest():
    random.seed(3)
    counts, seen = {}, defaultdict(int)
    for _ in range(200):
        part = [random.choice("abc") if random.random() < 0.5 else str(random.random()) for _ in range(50)]
        for x in part:
            seen[x] += 1
            counts[x] = counts.get(x, 0) + 1
        counts = ex.shrink(counts, 9)
    total = sum(seen.values())
    assert {x for x, n in seen.items() if n > total / 10} <= counts.keys() and len(counts) <= 9


def test_exact_groups_with_and_without_heavy_hitters(spark, odd):
    rows = [r.asDict() for r in odd.collect()]
    by = defaultdict(list)
    for r in rows:
        by[normal(r["text"])].append(r["doc_id"])
    for counters in (1, 2, 1024):
        got = ex.exact_groups(odd, counters=counters).collect()
        assert len(got) == len(rows)
        for g in got:
            ids = next(v for k, v in by.items() if hashlib.sha256(k.encode()).hexdigest() == g.text_sha256)
            assert g.group_size == len(ids) and g.keep_id == min((i for i in ids if i is not None), default=None)
        kept = [g.text_sha256 for g in got if g.kept]
        assert len(kept) == len(set(kept)) == len(by)


def test_exact_dedup_keeps_one_row_each_with_all_columns(spark, odd, empty):
    by = {normal(r.text) for r in odd.collect()}
    for counters in (1, 1024):
        got = ex.exact_dedup(odd, counters=counters)
        assert got.columns == odd.columns
        assert sorted(normal(r.text) for r in got.collect()) == sorted(by)
    assert ex.exact_dedup(empty).count() == 0 and ex.exact_groups(empty).count() == 0


def test_exact_dedup_of_one_huge_group(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'same  text', concat('t', id % 300)) AS text")
    got = {r.doc_id for r in ex.exact_dedup(docs).collect()}
    assert got == {0} | set(range(1, 300, 2))


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60)] + [("500", f"{i}") for i in range(501, 540)] + [("700", "700")]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == {f"{i:03d}": "000" for i in range(1, 61)} | {f"{i}": "500" for i in range(501, 540)}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def shingles(t):
    w = [x for x in BLANK.split(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


def test_near_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    base = [random.choices(words, k=n) for n in (6, 30, 60, 120)]
    rows = []
    for b in base:
        for _ in range(45):  # a dense group around each base, at and around the limit
            w = list(b)
            for _ in range(random.randint(0, max(1, len(w) // 20))):
                w[random.randrange(len(w))] = random.choice(words)
            rows.append(" ".join(w))
    rows += [" ".join(random.choices(words, k=50)) for _ in range(60)] + ["w1", "w1 w2", "W1  w2", "", None, "w1 w2 w3 w4 w5"]
    random.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_groups(docs).collect())
    assert got == [(d, n, c, d == c) for d, n, c in brute(rows)]
    kept = {d for d, _, c, k in got if k}
    assert {r.doc_id for r in nd.near_dedup(docs).collect()} == kept


def test_near_groups_of_odd_rows(spark, odd, empty):
    got = nd.near_groups(odd).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    key = lambda r: tuple((x is None, x) for x in r[:3])
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(brute(rows), key=key)
    stay = nd.near_dedup(odd)
    assert stay.columns == odd.columns
    one = [r for r in stay.collect() if "one two" == (r.text or "").lower()]
    assert len(one) == 1 and one[0].doc_id == 9
    assert nd.near_groups(empty).count() == 0 and nd.near_dedup(empty).count() == 0


def test_threshold_of_the_pipeline_stage(spark):
    import corpus_pipeline
    words = [f"w{i}" for i in range(104)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:50] + ["x"] + words[51:80] + ["y"] + words[81:])),       # 0.82
            (2, " ".join(["z"] + words[:20] + ["v"] + words[21:50] + ["u"] + words[51:80] + ["t"] + words[81:]))]  # below 0.8
    near = len(shingles(rows[0][1]) & shingles(rows[1][1])) / len(shingles(rows[0][1]) | shingles(rows[1][1]))
    assert 0.80 <= near < 0.85
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in nd.near_dedup(docs).collect()} == {0, 1, 2}
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()} == {0, 2}
    for least, n in ((85, 6), (80, 5)):
        assert nd.band_rows(least) == n and (1 - (least / 100) ** n) ** (180 // n) < 1e-6


def test_signature_values_agree_as_often_as_the_sets(spark):
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        a, b = np.unique(x[:430]), np.unique(x[70:])
        s = nd.signatures([a, b])
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 360 / 500) < 0.02


def template_docs(n, rng):
    """Distinct pages around one template, all pairs just below the limit, and a near copy of every tenth."""
    template = " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(200))
    rows = []
    for k in range(n):
        own = " ".join("".join(rng.choices("ghijkl", k=5)) for _ in range(36))
        rows.append((2 * k, f"{template} {own}"))
        if k % 10 == 0:
            rows.append((2 * k + 1, f"{template} {own} end"))
    return rows


def test_pages_of_a_template_are_no_candidates(spark, monkeypatch):
    pairs_seen = []
    inner = nd.prefix_pairs

    def watched(unsure, least):
        pairs, large = inner(unsure, least)
        pairs_seen.append((unsure.count(), pairs.count(), large.count()))
        return pairs, large

    monkeypatch.setattr(nd, "prefix_pairs", watched)
    rng = random.Random(12)
    for n in (150, 600):
        rows = template_docs(n, rng)
        got = {r.doc_id: r.component_id for r in nd.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {k: k - k % 2 for k, _ in rows}
    for unsure, pairs, large in pairs_seen:
        assert unsure > 100 and pairs <= 0.2 * unsure and large == 0


def test_large_groups_of_a_rare_shingle_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 3)
    rng = random.Random(13)
    base = ["".join(rng.choices("abcdef", k=5)) for _ in range(80)]
    rows = []
    for k in range(40):
        words = list(base)
        for at in rng.sample(range(80), rng.choice((0, 1, 2, 3))):
            words[at] = f"w{rng.randrange(6)}"
        rows.append((k, " ".join(words)))
    got = {r.doc_id: r.component_id for r in nd.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), least=80).collect()}
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k, _ in rows}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    assert got == root


def test_exact_dedup_takes_columns_of_any_type(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "a b", {"x": 1}), (1, "a b", {"x": 1}), (2, "a  b", {"y": 2}), (3, "c", None)],
                                 "doc_id long, text string, m map<string,int>").withColumn("v", F.parse_json(F.lit("[1]")))
    for counters in (1, 1000):
        assert sorted(r.doc_id for r in ex.exact_dedup(docs, counters=counters).select("doc_id").collect()) == [1, 3]
