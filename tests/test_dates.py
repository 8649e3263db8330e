"""Parity vectors for the flexible date parser (FIXTURES §3)."""

import datetime as dt

from lodestar.functions.dates import epoch_year, is_fresh, parse_flexible_date, parse_news_date, strict_iso_ts


def T(*a):
    return dt.datetime(*a)


VECTORS = [
    ("Mon, 15 Sep 2026 10:00:00 GMT", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("15 Sep 2026 10:00 +0200", T(2026, 9, 15, 8), T(2026, 9, 15, 8)),
    ("Mon, 15 Sep 2026 10:00:00 -0000", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("Mon, 15 Sep 26 10:00:00 EST", T(2026, 9, 15, 15), T(2026, 9, 15, 15)),
    ("Mon, 5 Sep 2026 10:00:00 PDT", T(2026, 9, 5, 17), T(2026, 9, 5, 17)),
    ("Tue, 15 Sep 2026 10:00:00 CET", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("2026-09-15T10:00:00.123+02:00", T(2026, 9, 15, 8, 0, 0, 123000), T(2026, 9, 15, 8, 0, 0, 123000)),
    ("2026-09-15", T(2026, 9, 15), T(2026, 9, 15)),
    ("20260915", T(1970, 8, 23, 12, 1, 55), T(2026, 9, 15)),
    ("1757930400", T(2025, 9, 15, 10), None),
    ("1757930400000", None, None), ("2026-09", None, None), ("T10:00", None, None),
    ("Sep 15, 2026", None, None), ("15 Sep 2026", None, None), ("3 weeks ago", None, None),
    ("Mon, 32 Sep 2026 10:00:00 GMT", None, None), ("2026-02-30T00:00:00Z", None, None),
    ("garbage", None, None), ("", None, None), (None, None, None),
    ("2 hours ago", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("posted 3 days ago", T(2026, 9, 12, 12), T(2026, 9, 12, 12)),
    ("99999999999999999999 days ago", None, None),
    ("Monday, 15-Sep-26 10:00:00 GMT", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("15 Sep 10:00:00 2026 +0100", T(2026, 9, 15, 9), T(2026, 9, 15, 9)),
    ("Sep 15 2026 10:00 PST", T(2026, 9, 15, 18), T(2026, 9, 15, 18)),
    ("15 September 2026 10:00:00 UT", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("15 Sep 2026 24:00:00 GMT", None, None),
    ("15 Sep 2026 10:00:60 GMT", None, None),
    ("15 Sep 2026 10.00.00 GMT", T(2026, 9, 15, 10), T(2026, 9, 15, 10)),
    ("15 Sep 2026 10.30 +0100", T(2026, 9, 15, 9, 30), T(2026, 9, 15, 9, 30)),
    ("2026 Sep 15 10:00:00", None, None),
]


def test_vectors(spark, as_of):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(VECTORS)], "i int, d string")
    out = (df.select("i", parse_flexible_date("d", as_of).cast("timestamp_ntz").alias("a"),
                     parse_news_date("d", as_of).cast("timestamp_ntz").alias("b"))
           .orderBy("i").collect())
    for r, v in zip(out, VECTORS):
        assert (r.a, r.b) == (v[1], v[2]), v[0]


def test_strict_and_epoch_year(spark):
    df = spark.createDataFrame([("2026-09-15T10:00:00Z", 1757930400), ("2026-09-15T10:00:00.5Z", 0),
                                ("2026-09-15 10:00:00", -86400)], "s string, e bigint")
    out = df.select(strict_iso_ts("s").cast("timestamp_ntz").alias("t"), epoch_year("e").alias("y")).collect()
    assert [r.t for r in out] == [T(2026, 9, 15, 10), None, None]
    assert [r.y for r in out] == [2025, None, 1969]


def test_freshness_boundary(spark, as_of):
    df = spark.createDataFrame([(T(2026, 9, 14, 12),), (T(2026, 9, 14, 11, 59, 59),), (None,), (T(2027, 1, 1),)],
                               "t timestamp_ntz")
    out = [r.f for r in df.select(is_fresh(df.t.cast("timestamp"), as_of).alias("f")).collect()]
    assert out == [True, False, False, True]


def test_rfc822_random_against_stdlib(spark):
    """Randomised RFC 822 strings: our parse equals Python's email.utils
    (naive results read as UTC, errors as null)."""
    import random
    from email.utils import parsedate_to_datetime

    from lodestar.functions.dates import rfc822_date
    rnd = random.Random(7)
    days = ["Mon, ", "Tue,", "Wed ", "", "Thursday, "]
    months = ["Jan", "feb", "SEP", "September", "Dec", "Foo"]
    zones = ["GMT", "UT", "EST", "PDT", "+0200", "-0530", "+0000", "-0000", "CET", "", "+2400"]
    samples = []
    for _ in range(1500):
        d = rnd.choice([1, 5, 15, 28, 31, 32])
        y = rnd.choice(["26", "99", "2026", "1969", "69", "70"])
        t = rnd.choice(["10:00", "10:00:05", "23:59:59", "24:00:00", "7:5:3", "10:60:00", "10.00.05", "10.30"])
        m = rnd.choice(months)
        z = rnd.choice(zones)
        shape = rnd.random()
        if shape < 0.15:
            core = f"{m} {d} {y} {t}"
        elif shape < 0.25:
            core = f"{d} {m} {t} {y}"
        elif shape < 0.35:
            core, z = f"{d}-{m}-{y} {t}", (z or "GMT")
        elif shape < 0.45 and z[:1] in "+-":
            core, z = f"{d} {m} {y} {t}{z}", ""
        else:
            core = f"{d} {m} {y} {t}"
        samples.append((rnd.choice(days) + core + (" " + z if z else "")).strip())

    def expect(s):
        try:
            v = parsedate_to_datetime(s)
        except Exception:
            return None
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", rfc822_date("s").cast("timestamp_ntz").alias("t")).collect()}
    bad = [(s, got[i], expect(s)) for i, s in enumerate(samples) if got[i] != expect(s)]
    assert not bad, bad[:5]


def test_iso_random_against_stdlib(spark):
    """Randomised ISO 8601 date-times in the supported shapes: our parse
    equals ``datetime.fromisoformat`` (naive read as UTC, errors as null)."""
    import random

    from lodestar.functions.dates import iso_date
    rnd = random.Random(11)
    samples = []
    for _ in range(1500):
        d = f"{rnd.choice([1969, 2024, 2026])}-{rnd.choice(['01', '02', '09', '12', '13'])}-" \
            f"{rnd.choice(['01', '15', '29', '30', '31', '00'])}"
        shape = rnd.random()
        if shape < 0.2:
            samples.append(d)
            continue
        t = rnd.choice(["10", "10:30", "10:30:05", "23:59:59", "24:00:00", "10:61:00"])
        if t.count(":") == 2 and rnd.random() < 0.4:
            t += "." + "".join(rnd.choice("0123456789") for _ in range(rnd.randint(1, 6)))
        z = rnd.choice(["", "Z", "+02:00", "-05:30", "+0200", "+02", "-00:00"])
        samples.append(d + rnd.choice(["T", " "]) + t + z)

    def expect(s):
        try:
            v = dt.datetime.fromisoformat(s.replace("Z", "+00:00"))
        except ValueError:
            return None
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", iso_date("s").cast("timestamp_ntz").alias("t")).collect()}
    bad = [(s, got[i], expect(s)) for i, s in enumerate(samples) if got[i] != expect(s)]
    assert not bad, bad[:5]
