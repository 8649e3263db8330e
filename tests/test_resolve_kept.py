"""The kept name map against a full resolution after random edits of seed and names."""

import random

import pytest

from lodestar.operators import resolve as R
from lodestar.operators import resolve_kept as K

SEED = "seed_idx int, canonical string, aliases array<string>"


def seed_of(spark, entries):
    return spark.createDataFrame([(i, c, a) for i, c, a in entries], SEED)


def same_as_full(spark, base, seed, names, threshold=90):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, raw string")
    got = K.resolve_kept(df, "raw", base, threshold).collect()
    want = R.resolve(df, "raw", seed, threshold).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    return {r.raw: r.method for r in got}


def typo(rng, s):
    at = rng.randrange(max(1, len(s)))
    return rng.choice([s[:at] + s[at + 1:], s[:at] + rng.choice("abz") + s[at:], s, s.upper() + " Inc"])


@pytest.mark.parametrize("threshold", [90, 80])
def test_random_edits_equal_a_full_run(spark, tmp_path, threshold):
    rng = random.Random(threshold)

    def word():
        return "".join(rng.choices("abcde", k=rng.randint(3, 9)))
    entries = [(i, " ".join(word() for _ in range(rng.randint(1, 6))), [word() + " " + word()]) for i in range(25)]
    names, base, methods = [None, "", "Inc", "x"], str(tmp_path / "map"), set()
    for _ in range(4 if threshold == 90 else 2):
        forms = [f for _, c, a in entries for f in [c, *a]]
        names += [typo(rng, typo(rng, rng.choice(forms))) for _ in range(30)] + [rng.choice(forms)]
        seed = seed_of(spark, entries)
        df = spark.createDataFrame([(n,) for n in names[-40:] + names[:4]], "raw string")
        K.refresh(spark, base, seed, df, "raw", threshold)
        methods |= set(same_as_full(spark, base, seed, names, threshold).values())
        # edits: drop, add, rename, another alias, a near twin earlier in the seed, a form of two owners
        entries.pop(rng.randrange(len(entries)))
        entries.append((100 + len(names), word() + " " + word(), [rng.choice(forms)]))
        i = rng.randrange(len(entries))
        entries[i] = (entries[i][0], entries[i][1] + "s", entries[i][2])
        i = rng.randrange(len(entries))
        entries[i] = (entries[i][0], entries[i][1], [typo(rng, rng.choice(forms)), *entries[i][2]])
        entries.append((-len(names), typo(rng, rng.choice(forms)), []))
    assert methods == {"exact_seed_match", "fuzzy_seed_match", "no_seed_match"}


def test_only_names_that_meet_a_changed_form_are_scored(spark, tmp_path, monkeypatch):
    pairs, plain = [], R._candidate_pairs
    monkeypatch.setattr(R, "_candidate_pairs", lambda *a: pairs.append(plain(*a)) or pairs[-1])
    rng = random.Random(3)
    entries = [(i, "".join(rng.choices("abcdefghijklmnop", k=12 if i % 2 else 40)), []) for i in range(60)]
    names = [c[:-1] for _, c, _ in entries] + ["abracadabra"]
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    base = str(tmp_path / "map")
    K.refresh(spark, base, seed_of(spark, entries), df, "raw")
    assert sum(p.count() for p in pairs) >= 60
    first = K.bucket_paths(spark, base + "/at_90")

    pairs.clear()
    entries.append((99, "abracadabru", []))
    K.refresh(spark, base, seed_of(spark, entries))
    assert sum(p.count() for p in pairs) == 1
    rows = {r.raw: (r.canonical, r.changed_in) for r in K.kept_names(spark, base).collect()}
    assert rows["abracadabra"] == ("abracadabru", 1) and sum(n for _, n in rows.values()) == 1
    second = K.bucket_paths(spark, base + "/at_90")
    assert {b for b in first if first[b] != second[b]} == {11} and 39 in second     # the long names were not touched

    pairs.clear()                                                                    # the winner goes
    K.refresh(spark, base, seed_of(spark, [e for e in entries if e[0] not in (99, 1)]))
    rows = {r.raw: r for r in K.kept_names(spark, base).collect()}
    assert sum(p.count() for p in pairs) == 0
    assert rows["abracadabra"].method == rows[entries[1][1][:-1]].method == "no_seed_match"
    assert sum(r.changed_in == 2 for r in rows.values()) == 2

    pairs.clear()                                                                    # nothing changed
    K.refresh(spark, base, seed_of(spark, [e for e in entries if e[0] not in (99, 1)]), df, "raw")
    assert sum(p.count() for p in pairs) == 0
    assert {r.raw: r for r in K.kept_names(spark, base).collect()} == rows


def test_empty_tables_and_a_crashed_run(spark, tmp_path):
    base = str(tmp_path / "map")
    with pytest.raises(FileNotFoundError):
        K.kept_names(spark, base)
    none, some = seed_of(spark, []), spark.createDataFrame([("Acme Inc",), (None,), ("Acme Inc",)], "raw string")
    K.refresh(spark, base, none)
    K.refresh(spark, base, none, some, "raw")
    assert same_as_full(spark, base, none, ["Acme Inc", None]) == {"Acme Inc": "no_seed_match", None: "no_seed_match"}
    seed = seed_of(spark, [(0, "acme", None)])
    (tmp_path / "map" / "at_90" / "v000002" / "names").mkdir(parents=True)           # no _SUCCESS: not read
    assert K.refresh(spark, base, seed).endswith("v000003")
    assert same_as_full(spark, base, seed, ["Acme Inc", None])["Acme Inc"] == "exact_seed_match"


def test_reach_covers_every_pair_that_can_match():
    for threshold in (95, 90, 65):
        for l2 in (0, 1, 5, 24, 100, 254, 255, 300, 900):
            for l1 in range(0, 1200):
                if 100 * abs(l1 - l2) <= (100 - threshold) * (l1 + l2):
                    assert min(l1, K.LAST) in K.reach([min(l2, K.LAST)], threshold)
