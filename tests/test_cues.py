"""C3's cue search: a plain search first, boundaries that are not consumed."""

import re

import pytest
from pyspark.sql import functions as F

from lodestar.operators import classify as C

CUES = {"free": C.FREE_CUES, "paid": C.PAID_CUES, "b2b": C.B2B_CUES, "consumer": C.CONSUMER_CUES}
AROUND = ["{}", " {} ", "x{}", "{}x", "_{}", "{}9", "-{}-", "\n{}\n", "é{}漢", "\U0001F600{}\U0001F600", "{0}{0}", "{0}s {0}", "{0}\r\n"]


def words(cues):
    found = cues.removeprefix(C._L).removesuffix(C._R).split("|")
    return [w.replace("[ -]", s) for w in found for s in (" -" if "[" in w else " ")] + ["open  source", "no", ""]


@pytest.mark.parametrize("kind", CUES)
def test_cues_are_found_as_by_the_whole_expression(spark, kind):
    texts = sorted({a.format(w) for k in CUES.values() for w in words(k) for a in AROUND})
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in rows.select("t", C.has_cue(F.col("t"), CUES[kind])).collect()}
    assert got == {t: re.search(CUES[kind], t) is not None for t in texts}


def test_null_and_empty_texts_have_no_class(spark):
    rows = spark.createDataFrame([(None,), ("",)], "t string").select(C.pricing_rules("t")).collect()
    assert [r[0] for r in rows] == ["UNKNOWN"] * 2


def test_every_expression_stands_behind_a_plain_search(spark):
    plan = spark.createDataFrame([("a",)], "t string").select(C.pricing_rules("t").alias("p"))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("rlike") == plan.count("and rlike") > 0
    assert "contains(" in plan and "[^a-z0-9_]" not in plan
