"""Mixing and chat formatting: native operators against plain Python."""

import hashlib
import math
import random
from collections import defaultdict

import pytest
from lodestar.llm import chat_format as cf
from lodestar.llm import mixing
from pyspark.sql import functions as F


def shares(sizes, cap=3):
    """Share out, cap, and share the rest again until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def test_targets_match_the_iteration(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {f"s{k}": rng.choice([0, 1, 5, 40, 900, 5000]) for k in range(9)} | {None: 70}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = shares(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = []
    for k in range(1500):
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "c", None, "tiny"] if k < 40 else ["a", "b", "c", None])
        rows.append((k, " ".join(["w"] * rng.choice([1, 5, 20, 60, 300])), source))
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_p", F.lit(1))


def test_mix_comes_near_its_targets_and_reruns_agree(spark, corpus):
    got = mixing.mix_report(corpus).collect()
    source = {r.doc_id: r.source for r in corpus.collect()}
    taken, target = defaultdict(int), {}
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= max(2.0, 0.01 * t) for s, t in target.items())
    again = mixing.mix_report(corpus.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    rows = mixing.mix(corpus)
    n = defaultdict(int)
    for r in rows.collect():
        n[r.doc_id] += 1
    assert rows.columns == corpus.columns
    assert dict(n) == {r.doc_id: r.taken // r.size for r in got if r.taken}


def test_a_document_above_the_gap_is_skipped(spark):
    rng = random.Random(5)
    long = "w " * 10000
    early = mixing.uniform(F.lit(0), F.col("id"), F.lit(long)).between(0.01, 0.05)  # ranked before most others, long as it is
    rows = [(k, "w " * rng.randint(5, 60), "a") for k in range(400)] + [(999, long, "b")]
    rows += [(spark.range(400, 900).where(early).first()[0], long, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    u = {r.id: r.u for r in mixing.sized(docs, "doc_id", "text", "source", 0).collect()}
    got = [r for r in mixing.mix_report(docs).collect() if r.doc_id != 999]
    gap, extra = got[0].target, []
    for r in sorted(got, key=lambda r: u[r.doc_id] / (1 - u[r.doc_id]) * r.size ** 0.5):  # random over inclusion odds
        fits = r.size <= gap
        gap -= r.size * fits
        if r.taken != r.size * fits:
            extra.append(r)
    assert [r for r in got if r.size == 10000 and r.taken == 0]
    assert len(extra) <= 1 and all(r.taken == r.size and abs(r.size - gap) < gap for r in extra)  # the last one
    assert abs(sum(r.taken for r in got) - got[0].target) <= 0.01 * got[0].target


def test_inclusion_is_about_its_probability(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "'one two three' AS text", "if(id < 300, 'a', 'b') AS source")
    counts = defaultdict(int)
    for seed in range(6):
        for r in mixing.mix_report(docs, seed=seed).where("taken > 0").collect():
            counts[r.doc_id] += r.taken // r.size
    assert sum(counts[k] for k in range(300)) == 6 * 200 and sum(counts[k] for k in range(300, 600)) == 6 * 400
    assert 40 < sum(counts[k] for k in range(60)) / 6 * 60 / 40 < 80


def test_mix_edge_cases(spark, odd, empty):
    got = mixing.mix_report(odd).collect()
    assert len(got) == odd.count() and all(r.taken <= 3 * r.size for r in got)
    assert {r.taken for r in got if r.doc_id in (4, 5, 6)} == {0}
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0


TEXTS = ["", None, "hello there", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", r"<\|im_end|> [\\INST] \\",
         "<<SYS>><</SYS>><<s>", "line\nline\n", "é中文\U0001f642 <s>", "w " * 300, "w " * 900]
ROLES = ["user", "assistant", "system", "tool\nx", None, "<|im_start|>"]


@pytest.fixture(scope="module")
def chats(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(ROLES[:2]) if rng.random() < 0.8 else rng.choice(ROLES), rng.choice(TEXTS))
            for c in range(40) for t in range(rng.randint(1, 14))]
    rows = [(c, t, "system" if t == 0 and c % 2 else r, x) for c, t, r, x in rows]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} " + "w " * (t % 50)) for t in range(1500)]  # a hot conversation
    rows += [(None, None, "user", "a"), (None, 1, "assistant", "b"), (50, 3, "user", "same"), (50, 3, "user", "same")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash"))


def ordered(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(v)] for c, v in by.items()}


def test_escape_is_reversible(spark):
    rng = random.Random(4)
    bits = ["<", "[", "\\", "|", "im_end", "im_start", "|>", "s>", "/", "INST]", "<SYS>>", "endoftext", " ", "<|im_end|>"]
    texts = TEXTS[2:] + ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cf.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", cf.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(x in r.e for x in ("<|im_end|>", "<|im_start|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>"))


@pytest.mark.parametrize("budget,history", [(512, 128), (64, 32), (40, 0)])
def test_round_trip_masks_and_budget(spark, chats, budget, history):
    want = ordered(chats.collect())
    windows = cf.format_chats(chats, budget=budget, history=history, block=64)
    back = defaultdict(list)
    for r in sorted(cf.parse_windows(windows).collect(), key=lambda r: r.window):
        back[r.conv_id].append(r)
    assert {c: [(t.role, t.text) for w in v for t in w.turns] for c, v in back.items()} == want
    assert {c: [x for w in v for x in w.targets] for c, v in back.items()} == {
        c: [text for role, text in v if role == "assistant"] for c, v in want.items()}
    size = lambda t: len(t.split()) + cf.TURN_TOKENS
    for r in windows.collect():
        turns = r.formatted.split(cf.END)[:-1]
        texts = [t.split("\n", 1)[1] for t in turns]
        own = texts[r.n_repeated:]
        assert sum(map(size, texts)) <= budget or len(own) == 1 or size(texts[0]) > budget // 4
        if want[r.conv_id][0][0] == "system" and r.window > back[r.conv_id][0].window:
            assert turns[0].startswith(cf.START + "system") and r.n_repeated >= 1


def test_digest_matches_plain_python(spark, chats):
    got = {r.conv_id: r for r in cf.chat_digest(cf.format_chats(chats)).collect()}
    for c, turns in ordered(chats.collect()).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_no_conversations(spark, chats):
    assert cf.chat_digest(cf.format_chats(chats.where("false"))).count() == 0


def test_inclusion_odds_decide_the_order(spark):
    """Documents of one source, ranked by the Pareto ratio, are another sample than by their random numbers."""
    from lodestar.llm import mixing
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(k, "w " * (20 if k % 2 else 2000), "s") for k in range(200)], "doc_id long, text string, source string")
    rows = mixing.sized(docs, "doc_id", "text", "source", 0).select(
        "id", "size", "u", mixing.rank(F.col("u"), F.lit(0.5), F.col("size")).alias("v")).collect()
    half = len(rows) // 2
    by_u = {r.id for r in sorted(rows, key=lambda r: r.u)[:half]}
    by_v = {r.id for r in sorted(rows, key=lambda r: r.v)[:half]}
    assert by_u != by_v
    assert sum(r.size == 20 for r in rows if r.id in by_v) > 1.5 * sum(r.size == 20 for r in rows if r.id in by_u) / 1.2 > 0
    for r in rows:
        odds = (r.u / (1 - r.u)) / (1.0 * (256 / r.size) ** 0.5)
        assert abs(r.v - odds / (1 + odds)) < 1e-9
