"""Secret scan: base spans and Viterbi against brute force, gradients, held-out recall."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from lodestar.llm import secrets as S

SIGNS = ["password", "PASSWD", "Token", "secret", "api_key", "apikey", '"', "'", " ", "  ", "=", ":", "AKIA", "0123456789abcdef",
         "deadbeef", "XYZ", "abcdefgh", "/+", "_.", "é", "日本", "ſecret=", "\n", "-", "\U0001f642"]


def brute_base(text):
    """By the wording: leftmost matches of the unbounded patterns, then the length test."""
    letters = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                         r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in letters.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def texts_of(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(SIGNS, k=rng.randint(0, 25))) for _ in range(n)]


def test_base_spans_equal_the_wording():
    texts = texts_of(3000, 1)
    assert [S.base_spans(t) for t in texts] == [brute_base(t) for t in texts]
    assert {k for t in texts for _, k, _ in brute_base(t)} == {0, 1, 2}


def plain_tokens(text):
    out, kinds = [], [0 if c.isspace() else 1 if c.isalnum() or c == "_" else 2 for c in text]
    for k, c in enumerate(kinds):
        if c == 1 and k and kinds[k - 1] == 1:
            out[-1] = out[-1][0], k + 1
        elif c:
            out.append((k, k + 1))
    return out


def test_tokens_equal_a_plain_split():
    texts = ["", "a  b_c=1", " ", "x\U0001f642y", *texts_of(200, 2)]
    t = S.Tokens(texts)
    got = [[] for _ in texts]
    for a, b, k in zip(t.start.tolist(), t.end.tolist(), t.text_of.tolist()):
        got[k].append((a - int(t.text_from[k]), b - int(t.text_from[k])))
    # Characters beyond the basic plane count as word characters.
    assert got == [plain_tokens(x.replace("\U0001f642", "é")) for x in texts]
    # A text has the same features alone and among others.
    for k in (1, 50, 120):
        assert (S.Tokens([texts[k]]).features == t.features[t.text_of == k]).all()


def random_field(seed):
    rng, f = np.random.default_rng(seed), S.Field()
    f.emit += rng.normal(size=f.emit.shape)
    f.first[:2] += rng.normal(size=2)
    f.follow[:, :2] += rng.normal(size=(3, 2))
    f.follow[1:, 2] += rng.normal(size=2)
    return f


@pytest.mark.parametrize("stretch", [1, 3, 256])
def test_viterbi_equals_the_best_of_all_paths(monkeypatch, stretch):
    monkeypatch.setattr(S, "STRETCH", stretch)
    rng, f = np.random.default_rng(4), random_field(4)
    sizes = [1, 7, 2, 5, 6, 1, 4]
    scores = [rng.normal(size=(n, 3)) * 2 for n in sizes]
    want = []
    for e in scores:
        def total(p):
            return f.first[p[0]] + sum(e[k, x] for k, x in enumerate(p)) + sum(f.follow[x, y] for x, y in zip(p, p[1:]))
        want += max(itertools.product(range(3), repeat=len(e)), key=total)
    begins = np.zeros(sum(sizes), bool)
    begins[np.cumsum([0, *sizes[:-1]])] = True
    assert f.decode(np.concatenate(scores), begins).tolist() == list(want)


def test_likelihood_and_gradients():
    rng, f = np.random.default_rng(5), random_field(5)
    size = np.array([4, 1, 3])
    x = np.stack([rng.integers(0, n, (3, 4)) for n in S.GROUPS.values()], 2).astype(np.int32)
    y = np.array([[0, 1, 2, 0], [1, 0, 0, 0], [0, 0, 1, 0]], np.int8)
    value, emit, first, follow = S.likelihood(f, x, y, size)
    want = 0
    for k, n in enumerate(size):
        e = f.scores(x[k, :n])
        every = [f.first[p[0]] + sum(e[i, t] for i, t in enumerate(p)) + sum(f.follow[a, b] for a, b in zip(p, p[1:]))
                 for p in itertools.product(range(3), repeat=int(n))]
        p = y[k, :n]
        gold = f.first[p[0]] + sum(e[i, t] for i, t in enumerate(p)) + sum(f.follow[a, b] for a, b in zip(p, p[1:]))
        want += gold - np.logaddexp.reduce(every)
    assert value == pytest.approx(want)
    row = int(x[0, 1, 0])
    for array, grad, at in ((f.emit, emit, (row, 1)), (f.emit, emit, (row, 0)), (f.first, first, (1,)), (f.follow, follow, (1, 2)), (f.follow, follow, (0, 0))):
        old = array[at]
        array[at] = old + 1e-5
        up = S.likelihood(f, x, y, size)[0]
        array[at] = old - 1e-5
        down = S.likelihood(f, x, y, size)[0]
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def secret_docs(n, seed, secret):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = ["".join(rng.choices("aeinorst", k=rng.randint(2, 9))) for _ in range(60)]
        if k % 3 == 0:
            words.insert(rng.randint(5, 50), secret(rng))
        out.append(" ".join(words))
    return out


def hexes(rng, n=20):
    return "".join(rng.choices("0123456789abcdef", k=n))


def test_learned_field_finds_held_out_secrets_and_leaves_clean_texts(spark):
    train = secret_docs(600, 1, lambda r: f"password={hexes(r, 18)}" if r.random() < .5 else f'token = "{hexes(r, 40)}"')
    docs = spark.createDataFrame(list(enumerate(train)), "doc_id long, text string")
    field = S.learn(docs)
    # A key word that the base patterns do not know, and values too short for them.
    other = secret_docs(300, 2, lambda r: f"passphrase={hexes(r, 14)}")
    found = S.scan(other, field)
    hit = sum(any(k == 3 for _, k, _ in f) for f in found[::3])
    false = sum(bool(f) for i, f in enumerate(found) if i % 3)
    assert hit > 80 and false == 0
    clean = secret_docs(300, 3, lambda r: "ordinary")
    assert not any(S.scan(clean, field))


def test_report_equals_brute_force_on_base_columns(spark, odd, empty):
    texts = [*texts_of(300, 7), None, "", "token = '" + "x" * 300_000, "password=abcdefabcdef1234 " * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS id").repartition(4)
    got = {r.doc_id: r for r in S.secret_report(docs, S.learn(docs)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = brute_base(t or "")
        line = ",".join(f"{S.KINDS[kind]}:{a}:{b}" for a, kind, b in want)
        r = got[k]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == j for x in want) for j in range(3)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        spans = [x.split(":") for x in r.spans.split(",")] if r.spans else []
        assert [f"{x[0]}:{x[1]}:{x[2]}" for x in spans if x[0] != "crf"] == [x for x in line.split(",") if x]
        assert all(int(a) < int(b) <= len(t) for _, a, b in spans)
    assert S.secret_report(odd, S.learn(odd)).count() == odd.count()
    assert S.learn(empty) is None and S.secret_report(empty, None).count() == 0
