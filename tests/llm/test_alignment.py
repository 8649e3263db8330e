"""Alignment of two tokenizers against a brute-force version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from lodestar.llm import alignment

PARTS = [" ", "  ", "\n", "\t", "word", "tokenization", "É", "é", "日本語", "\U0001f642", "don't", "<|endoftext|>", "<s>", "</s>",
         "▁", "<0x41>", "1", "2024", "...", "ﬁ", "①", "\x85", " ", "́", "\0", "x" * 9, "-", "ß"]
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))


def byte_table():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def brute(models, texts):
    a_model, b_model = models
    table = byte_table()
    docs, held = [], Counter()
    for t in texts:
        want = b" " + (t or "").encode()
        a = [(i, bytes(table[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + (t or ""), add_special_tokens=False).ids]
        b = []
        for i in b_model.encode(t or ""):
            p = b_model.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()))
        if not t or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            docs.append(None)
            continue
        ends = [list(np.cumsum([len(x) for _, x in side])) for side in (a, b)]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            m, n = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append((a[i:m], b[j:n]))
            i, j = m, n
        links, at = [], 0
        for k, (x, _) in enumerate(a):
            a0, a1 = ([0] + ends[0])[k], ends[0][k]
            while at and ends[1][at - 1] > a0:
                at -= 1
            while ends[1][at] <= a0:
                at += 1
            for m in range(at, len(b)):
                if ([0] + ends[1])[m] >= a1:
                    break
                links.append((x, b[m][0]))
        held.update(set(links))
        docs.append((len(a), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        text = ";".join(f"{','.join(str(i) for i, _ in g)}|{','.join(str(i) for i, _ in h)}" for g, h in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def texts_of(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(n)] + [
        "tokens of some ordinary words, aligned. " * 50, "日本語" * 800, None, "", " ", " lead", "same text", "same text"]


@pytest.mark.parametrize("held", [alignment.HELD, 40, 0])
def test_report_equals_brute_force(spark, models, held):
    texts = texts_of(150, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "*", "1 AS row", "'x' AS pairs", "2 AS id").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in alignment.align_report(
        docs, public_tokenizers.path(A), public_tokenizers.path(B), held=held).collect()}
    want = dict(enumerate(brute(models, texts)))
    assert got == want and any(w[2] and w[2] < min(w[:2]) for w in want.values())
    assert sum(w[0] == 0 for w in want.values()) < 0.7 * len(texts)


def test_cuts_of_random_ends_are_the_common_ones():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n)) for _ in range(2))
        got = alignment.shared_cuts(a, b, [0], [len(a)], [0], [len(b)])
        assert a[got].tolist() == sorted((set(a.tolist()) & set(b.tolist())) - {n})


def test_one_very_long_text(models):
    text = "some words and numbers 12 34, all in a row; " * 60_000
    al = alignment.Aligned([text], public_tokenizers.path(A), public_tokenizers.path(B))
    assert len(al.link_a) == len(al.a) + len(al.b) - len(al.group_a)
    assert len(al.a) == len(models[0].encode(" " + text, add_special_tokens=False).ids)


def test_empty_table_and_odd_rows(spark, odd, empty):
    paths = public_tokenizers.path(A), public_tokenizers.path(B)
    assert alignment.align_report(empty, *paths).count() == 0
    rows = alignment.align_report(odd, *paths).collect()
    assert len(rows) == odd.count() and sum(r.n_a == 0 for r in rows) == 3


MIXED = [*PARTS, ".", ",", "!", "?", ";", ":", " a.", " É,", "\n\n", "\r\n", " word", " word.", "\nword", " 日本", ".\n"]


@pytest.fixture
def parts():
    paths = public_tokenizers.path(A), public_tokenizers.path(B)
    return alignment.Parts(alignment.codec(paths[0], plain=True), *paths)


@pytest.mark.parametrize("held", [(alignment.HELD_PARTS, alignment.HELD_BYTES), (20, 1 << 20), (1000, 500)])
def test_texts_by_parts_are_as_whole_texts(parts, monkeypatch, held):
    monkeypatch.setattr(alignment, "HELD_PARTS", held[0])
    monkeypatch.setattr(alignment, "HELD_BYTES", held[1])
    rng = random.Random(3)
    for _ in range(12):
        texts = ["".join(rng.choices(MIXED, k=rng.randint(0, 30))) for _ in range(40)] + ["", "▁ word a", "plain words, here.\nAnd there"]
        got, want = parts.align(texts), parts._whole(texts)
        assert got[0].tolist() == want[0].tolist() and [*map(bytes, got[1])] == want[1]
        assert [x.tolist() for x in got[2]] == [x.tolist() for x in want[2]]
        assert 0 < (got[0][:, 0] == 0).sum() < len(texts)


def test_texts_without_any_good_part(parts):
    sums, lines, pairs = parts.align(["▁", "▁▁"])
    assert not sums.any() and [*map(bytes, lines)] == [b"", b""] and not any(map(len, pairs))
    assert parts.align([""])[0].tolist() == [[0] * 4]


def test_a_part_is_encoded_once(parts, monkeypatch):
    seen = []
    encode = alignment.Pieces.encode
    monkeypatch.setattr(alignment.Pieces, "encode", lambda self, texts: seen.extend(texts) or encode(self, texts))
    for _ in range(3):
        parts.align(["one word and one word.\nAnd one, too"] * 50)
    assert sorted(seen) == sorted(["one", "word", "and", "a.", "a\nAnd", "a,", "too"])


def test_pieces_never_span_a_cut(parts):
    assert parts.apart[ord("a"), 32] and parts.apart[ord("."), 10] and parts.apart[ord("a"), ord(".")]
    assert not parts.apart[32, 32] and not parts.apart[ord("a"), ord("b")]


def test_other_models_are_aligned_whole(parts):
    texts = ["some words, some more"]
    want = parts.align(texts)
    parts.apart = None
    got = parts.align(texts)
    assert got[0].tolist() == want[0].tolist() and got[1] == [*map(bytes, want[1])] and not parts.place.get(b"absent")
