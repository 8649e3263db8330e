"""Language ID, quality, language model and search."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
from lodestar.llm import hmm_lm, lang_id, quality, topk_search
from lodestar.llm.common import fold
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(12, 3)).astype(np.float32)
    docs = [rng.integers(0, 12, n) for n in (5, 0, 1, 6, 3)]
    for d, got in zip(docs, lang_id.viterbi(docs, scores, 0.8)):
        value = lambda p: sum(scores[w, s] for w, s in zip(d, p)) - 0.8 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(map(value, itertools.product(range(3), repeat=len(d))))
        assert len(got) == len(d) and abs(value(got.tolist()) - best) < 1e-4


def test_spans_of_a_mixed_text_and_odd_rows(spark, odd, empty):
    train = spark.createDataFrame(
        [("the cat and the dog with that thing were there", "en"), ("der hund und die katze nicht mit dem ding", "de"),
         ("кот и собака там вместе", "ru")] * 5, "text string, lang string")
    model = lang_id.learn(train)
    assert model[0] == ["de", "en", "ru"]
    mixed = "the dog and the cat were there " * 8 + "die katze und der hund nicht mit " * 8 + "собака и кот"
    docs = spark.createDataFrame([(1, mixed), (2, None), (3, "?! 12 ²"), (4, "собака"), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in lang_id.identify(docs, model).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de", "ru"] and 0 < got[1].score < 1
    assert [(got[k].lang_pred, got[k].score) for k in (2, 3, 5)] == [("und", 0.0)] * 3
    assert got[4].lang_pred == "ru" and got[4].score == 1.0
    assert lang_id.identify(odd, model).count() == odd.count()
    kept = lang_id.with_language(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 8, 9, 10, 11, None}
    nothing = lang_id.learn(empty)
    assert {r.lang_pred for r in lang_id.identify(odd, nothing).collect()} == {"und"}
    # Nothing learned: the texts with letters stay.
    assert {r.doc_id for r in lang_id.with_language(odd, nothing).collect()} == {1, 2, 3, 8, 9, 10, 11, None}
    assert lang_id.identify(empty, model).count() == 0


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = lang_id.learn(docs.where(fold(F.col("doc_id"), 5) != 0))
    got = lang_id.identify(docs.where(fold(F.col("doc_id"), 5) == 0), model).join(docs, "doc_id")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.97


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels, fold(F.col("doc_id"), 5) != 0)
    rows = got.join(labels, "doc_id").where("not train").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_edge_cases(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (None, 1), (7, 0), (8, None)], "doc_id long, quality int")
    everything = F.lit(True)
    got = quality.quality_scores(odd, none, everything).collect()
    assert len(got) == odd.count() and {r.score for r in got} == {0.5}
    got = quality.quality_scores(odd, some, everything).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(empty, some, everything).count() == 0


def test_risk_gradient_and_hessian():
    rng = np.random.default_rng(4)
    x, kind = rng.normal(size=(40, 5)), rng.integers(0, 2, 40)
    part = quality.pu_part(0.7, (kind == 1).sum(), (kind == 0).sum())
    w, one = rng.normal(size=5), np.ones(5)
    at = lambda v: part(v, one)(kind, x)
    for k in range(5):
        step = np.eye(5)[k] * 1e-5
        assert abs((at(w + step)[0] - at(w - step)[0]) / 2e-5 - at(w)[2 + k]) < 1e-6
        assert np.allclose((at(w + step)[2:7] - at(w - step)[2:7]) / 2e-5, at(w)[7:].reshape(5, 5)[k], atol=1e-6)


def plain_forward(start, move, emit, seq):
    v = start * emit[:, seq[0]]
    for s in seq[1:]:
        v = (v @ move) * emit[:, s]
    return math.log(v.sum())


def test_scaled_forward_and_expectations_match_enumeration(monkeypatch):
    monkeypatch.setattr(hmm_lm, "SYMBOLS", 6)
    rng = np.random.default_rng(7)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(6), 3)
    seqs = sorted([rng.integers(0, 6, n).astype(np.uint16) for n in (5, 2, 1, 4)], key=len, reverse=True)
    g = hmm_lm.Group(seqs)
    logs = g.forward(start, move, emit.T.copy(), False)[0]
    assert np.allclose(logs, [plain_forward(start, move, emit, s) for s in seqs])
    total, first, moves, symbols = g.expect(start, move, emit.T.copy())
    want_first, want_moves, want_symbols = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for s in seqs:
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = np.array([start[q[0]] * math.prod(emit[a, o] for a, o in zip(q, s)) * math.prod(move[a, b] for a, b in zip(q, q[1:]))
                      for q in paths])
        for q, w in zip(paths, p / p.sum()):
            want_first[q[0]] += w
            for a, b in zip(q, q[1:]):
                want_moves[a, b] += w
            for a, o in zip(q, s):
                want_symbols[o, a] += w
    assert np.allclose(first, want_first) and np.allclose(moves, want_moves) and np.allclose(symbols, want_symbols)
    assert math.isclose(total, logs.sum())


def test_language_model_base_and_held_out_gain(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "DICTIONARY", 3000)  # so that many words take the way of the rare ones
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in hmm_lm.score_texts(docs, fold(F.col("doc_id"), 7) != 2, steps=4).collect()}
    rows = [(r.doc_id, hmm_lm.words_of(r.text)) for r in docs.collect()]
    c = Counter()
    for d, w in rows:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            c.update([*w, None])
    n, v = sum(c.values()), len(c)
    for d, w in rows:
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*w, None])
        assert math.isclose(got[d].base_score, base, rel_tol=1e-9)
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (len(w) + 1, sum(x in c for x in [*w, None]), n)
    out = [r for r in got.values() if not r.train]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_language_model_is_trained_for_six_steps(spark, odd, monkeypatch):
    seen, plain = [], hmm_lm.train
    monkeypatch.setattr(hmm_lm, "train", lambda *a: seen.append(plain(*a)) or seen[-1])
    assert hmm_lm.score_texts(odd, F.lit(True)).count() == odd.count()
    logs = seen[0][1]
    assert len(logs) == 6 and logs[-1] > logs[0]


def test_language_model_score_is_the_plain_forward_sum(spark, monkeypatch):
    """Own words, class words in the dictionary, rare and unseen ones: the score is the plain
    forward sum times the words' shares, and a class's words and one unseen word add up to the class."""
    monkeypatch.setattr(hmm_lm, "DICTIONARY", hmm_lm.OWN + 300)  # holds the words seen twice, not those seen once
    own, twice, once = ([f"{a}{i:04d}" for i in range(n)] for a, n in (("w", hmm_lm.OWN), ("c", 200), ("r", 200)))
    corpus = [" ".join(own * 2 + twice), " ".join(once + own + twice)]
    c = Counter(w.encode() for t in corpus for w in t.split())
    unseen = sorted({"zz" + w[-2:] for w in twice + once})
    texts = [*twice, *once, *unseen, "", "W0001 c0007 r0100 zz99 c0007 w0005", "r0001 r0001 zz01 Zz01 w8191"]
    seen, plain = [], hmm_lm.train
    monkeypatch.setattr(hmm_lm, "train", lambda seqs, counts, steps: seen.append(plain(seqs, counts, steps)[0]) or (seen[-1], []))
    docs = spark.createDataFrame(list(enumerate(corpus + texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in hmm_lm.score_texts(docs, F.col("doc_id") < 2, steps=2).collect()}
    start, move, emit = seen[0]
    ranks = {w.encode(): i for i, w in enumerate(own)}  # equal counts rank by the word
    group = {w: zlib.crc32(w[-2:]) % hmm_lm.CLASSES for w in c if w not in ranks}

    def forward(symbols):
        v = None
        for x in [*symbols, hmm_lm.END]:
            v = (start if v is None else v @ move) * emit[:, x]
        return v.sum()

    def share(w):
        same = [x for x, k in group.items() if k == zlib.crc32(w[-2:]) % hmm_lm.CLASSES]
        return (c[w] + 1) / (sum(c[x] for x in same) + len(same) + 1)
    by_class = Counter()
    for d, t in enumerate(texts, 2):
        words = t.lower().encode().split()
        symbols = [ranks.get(w, hmm_lm.OWN + zlib.crc32(w[-2:]) % hmm_lm.CLASSES) for w in words]
        want = math.log10(forward(symbols)) + sum(math.log10(share(w)) for w in words if w not in ranks)
        assert math.isclose(got[d].score, want, rel_tol=1e-9), t
        if len(words) == 1 and (words[0] in c or not any(zlib.crc32(u.encode()[-2:]) % hmm_lm.CLASSES == symbols[0] - hmm_lm.OWN
                                                         for u in unseen[:unseen.index(t)])):
            by_class[symbols[0]] += 10 ** got[d].score
    assert len(by_class) > 50
    assert all(math.isclose(p, forward([k]), rel_tol=1e-9) for k, p in by_class.items())


def test_language_model_edge_cases(spark, odd, empty):
    got = hmm_lm.score_texts(odd, F.lit(True), steps=2).collect()
    assert len(got) == odd.count() and all(r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {1}
    got = hmm_lm.score_texts(odd, F.lit(False)).collect()
    assert {(r.base_score, r.n_known, r.train_tokens) for r in got} == {(0.0, 0, 0)}
    assert hmm_lm.score_texts(empty, F.lit(True)).count() == 0


def brute_search(rows, queries, k):
    dims = max((len(v) for _, v in rows if v is not None), default=0)
    code = {}
    for i, v in rows:
        if i is not None and v is not None:
            code.setdefault((i, tuple([x is not None and x > 0 for x in v] + [False] * (dims - len(v)))))
    out = []
    for q, c in sorted({(i, c) for i, c in code if queries(i)}):
        best = sorted((sum(a != b for a, b in zip(c, d)), i) for i, d in code)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(best)]
    return out


def test_search_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=48).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(80)]                      # a common vector
    rows += [(400, None), (None, rows[3][1]), (401, [1.0] * 10), (402, []), (403, [None, float("nan"), 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit(1))
    got = topk_search.search(v, F.col("id") % 20 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == sorted(brute_search(rows, lambda i: i % 20 == 0, 5))


def test_search_of_copies_tied_with_other_codes(spark):
    rng = np.random.default_rng(10)
    near = [(np.arange(16) != j).astype(float).tolist() for j in range(6)]  # all at distance 1 from the query
    rows = [(0, [1.0] * 16), (1, near[0]), (100, near[0]), (2, near[1]), (101, near[1]), (3, near[2])]
    rows += [(200 + i, near[int(j)]) for i, j in enumerate(rng.integers(0, 6, 40))]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (2, 5):
        got = topk_search.search(v, F.col("id") < 3, k=k)
        assert sorted(map(tuple, got.collect())) == sorted(brute_search(rows, lambda i: i < 3, k))


def test_search_of_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    two = [(0, [1.0, -1.0]), (1, [1.0, 1.0])]
    got = topk_search.search(spark.createDataFrame(two, schema), F.lit(True), k=5)
    assert sorted(map(tuple, got.collect())) == brute_search(two, lambda i: True, 5)
    assert topk_search.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0


def test_a_label_decides_whether_a_text_stays(spark):
    train = spark.createDataFrame([("the cat sat on the mat and the dog " * 5, "en"), ("der hund und die katze sind nicht da " * 5, "de")],
                                  "text string, lang string")
    docs = spark.createDataFrame([(1, "the dog and the cat"), (2, "Привет мир это русский текст"), (3, "123 !"), (4, None),
                                  (5, "ok " + "привет " * 30), (6, "the dog привет")], "doc_id long, text string")
    kept = {r.doc_id for r in lang_id.with_language(docs, lang_id.learn(train)).collect()}
    assert kept == {1, 6}
    nothing = lang_id.learn(train.where("false"))
    assert {r.doc_id for r in lang_id.with_language(docs, nothing).collect()} == {1, 2, 5, 6}


def test_search_with_many_buckets_and_split_ones(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "INDEX_BLOCK", 8)
    monkeypatch.setattr(topk_search, "PAIRS", 64)
    rng = np.random.default_rng(9)
    head = rng.normal(size=16)
    rows = [(i, (np.concatenate([head, rng.normal(size=16)]) if i % 3 else rng.normal(size=32)).tolist()) for i in range(300)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.search(v, F.col("id") % 20 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == sorted(brute_search(rows, lambda i: i % 20 == 0, 5))
