"""Classification over landed model replies.

Replies are data: a ``tier_responses(record_key, tier_idx, status, body)``
table holds the final outcome of each tier attempt.  The first tier with an
``ok`` outcome and a parseable reply wins; an unknown value in a parseable
reply is ``UNKNOWN`` and does not fall through.  A deterministic rule tier
(C3) can stand in as the last tier.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.replies import (outcome_class, parse_reply, reply_field_enum,
                                        truncate_text)
from lodestar.functions.text import build_prompt, col_of

# --------------------------------------------------------------------------
# Default rules: cue words for the rule tier.  Deterministic stand-in for the
# model's guidance; not claimed to equal any model.
# --------------------------------------------------------------------------
# Whole-word tests use explicit ASCII boundaries so every regex engine agrees.
_L, _R = r"(^|[^a-z0-9_])(", r")([^a-z0-9_]|$)"
FREE_CUES = _L + r"free|open[ -]source|no cost" + _R
PAID_CUES = _L + r"premium|subscription|paid|pro plan|upgrade|pricing" + _R
B2B_CUES = (_L + r"business|businesses|enterprise|enterprises|companies|clients|teams|law firms|"
            r"retailers|b2b|api|developers|organizations|organisations|customers include" + _R)
CONSUMER_CUES = _L + r"consumer|consumers|individuals|personal|app for" + _R
_WORD = "[a-z0-9_]"


def has_cue(text: Column, cues: str) -> Column:
    """Whether ``text`` matches ``cues``, alternatives between ``_L`` and ``_R``.

    Most texts hold none of the alternatives' first literals, which a plain search
    tells; the others go through one expression that tests the boundaries without
    consuming them, which took a tenth of the time of a negated class at every position
    (eight tasks of a JVM)."""
    words = cues.removeprefix(_L).removesuffix(_R)
    literals = {re.match(r"[a-z0-9 ]+", w)[0] for w in words.split("|")}
    least = [w for w in sorted(literals) if not any(o != w and o in w for o in literals)]
    some = reduce(or_, [text.contains(w) for w in least])
    return some & text.rlike(f"(?<!{_WORD})(?:{words})(?!{_WORD})")


LANDED_TIERS = 1000  # landed replies keep tier numbers below this one


def first_success(replies: DataFrame, key: str = "record_key") -> DataFrame:
    """Per key, the reply of the lowest tier whose outcome is ``ok`` and
    whose body parses as JSON.  Keys where every tier failed are absent.  Of
    several attempts on one tier the first by ``attempt`` (if that column is
    there), then by body, wins."""
    ok = (outcome_class(F.col("status"), "model") == "ok") & parse_reply(F.col("body")).isNotNull()
    good = replies.where(ok)
    order = [c for c in ("tier_idx", "attempt", "body") if c in replies.columns]
    return (good.groupBy(key)
            .agg(F.min_by(F.col("body"), F.struct(*order)).alias("reply"),
                 F.min("tier_idx").alias("tier_idx")))


class Tier(NamedTuple):
    """One classifier of a chain: ``classify`` takes ``(record_key, prompt)`` rows, the
    prompt cut to ``max_chars`` (None: whole), and returns ``(record_key, status, body)``."""
    classify: Callable[[DataFrame], DataFrame]
    max_chars: int | None = 6000


def run_tiers(records: DataFrame, tiers: list[Tier], landed: DataFrame | None = None) -> DataFrame:
    """Answers of a chain of the caller's classifiers, ``(record_key, reply, tier_idx)``.

    ``records(record_key, prompt)`` has one row per key.  ``landed`` replies come first
    (with their own tier numbers); each tier then sees only the records without an answer so
    far, and a failed or unparseable reply leaves its record to the next.  Tiers are numbered
    from 0, or from ``LANDED_TIERS`` behind landed replies.  A tier's replies are written once to
    the checkpoint folder, so its classifier is not asked again by later tiers or after a lost
    executor."""
    from lodestar.session import materialize
    keys = records.select("record_key", F.coalesce("prompt", F.lit("")).alias("prompt"))
    done = None if landed is None else first_success(landed)
    first = 0 if landed is None else LANDED_TIERS
    for i, tier in enumerate(tiers):
        todo = keys
        if done is not None:
            seen = done.select("record_key", F.lit(True).alias("__seen__"))
            todo = keys.join(seen, "record_key", "left").where("__seen__ is null").drop("__seen__")
        if tier.max_chars is not None:
            todo = todo.withColumn("prompt", truncate_text("prompt", tier.max_chars))
        got = tier.classify(todo).select("record_key", F.lit(first + i).alias("tier_idx"), "status", "body")
        got = first_success(materialize(got, f"tier-{i}"))
        done = got if done is None else done.unionByName(got)
    if done is None:
        raise ValueError("no tier and no landed reply")
    return done


def pricing_from_replies(records: DataFrame, replies: DataFrame, key: str = "record_key",
                         out: str = "pricingModel") -> DataFrame:
    """Pricing class from the first successful tier; all tiers failed or
    none configured -> ``UNKNOWN``."""
    fs = first_success(replies, key).select(
        F.col(key), reply_field_enum(parse_reply(F.col("reply"))).alias("__p__"))
    return (records.join(fs, key, "left")
            .withColumn(out, F.coalesce(F.col("__p__"), F.lit("UNKNOWN"))).drop("__p__"))


def pricing_rules(text) -> Column:
    """Rule tier over the description text."""
    t = F.lower(F.coalesce(col_of(text), F.lit("")))
    free, paid = has_cue(t, FREE_CUES), has_cue(t, PAID_CUES)
    return (F.when(free & paid, F.lit("FREEMIUM"))
            .when(free, F.lit("FREE"))
            .when(has_cue(t, B2B_CUES), F.lit("ENTERPRISE"))
            .when(paid | has_cue(t, CONSUMER_CUES), F.lit("PAID"))
            .otherwise(F.lit("UNKNOWN")))


def classification_input(startups: DataFrame, max_chars: int | None = 6000) -> Column:
    """X20 + X18: the prompt text each tier would receive, truncated (whole if None)."""
    prompt = build_prompt(F.col("content.entityName"), F.col("content.description"))
    return prompt if max_chars is None else truncate_text(prompt, max_chars)


def build_products(startups: DataFrame, done: DataFrame | None = None,
                   replies: DataFrame | None = None, limit: int | None = None,
                   order=("source.url",), use_rules: bool = True, max_chars: int | None = 6000,
                   tiers: list[Tier] | None = None) -> DataFrame:
    """C4: L1 limit -> J2 skip finished urls -> prompt -> C2 (then C3 for
    records no tier answered) -> P2.  ``replies`` are keyed by source url; ``tiers``
    (``run_tiers``) are asked for records that the replies leave open."""
    from lodestar.operators.dedupe import resume_anti
    from lodestar.operators.filters import limit_first
    from lodestar.operators.records import product_records
    s = limit_first(startups, limit, [F.col(c) for c in order])
    s = s.withColumn("record_key", F.col("source.url"))
    if done is not None:
        s = resume_anti(s, done, "record_key", F.col("source.url"))
    s = s.withColumn("prompt", classification_input(s, max_chars))
    if tiers:
        whole = s.where("record_key is not null").select("record_key", classification_input(s, None).alias("prompt"))
        answers = run_tiers(whole.groupBy("record_key").agg(F.min("prompt").alias("prompt")), tiers, replies)
    else:
        answers = None if replies is None else first_success(replies)
    if answers is not None:
        fs = answers.select(
            "record_key", reply_field_enum(parse_reply(F.col("reply"))).alias("__model__"))
        s = s.join(fs, "record_key", "left")
    else:
        s = s.withColumn("__model__", F.lit(None).cast("string"))
    rule = pricing_rules(F.col("content.description")) if use_rules else F.lit("UNKNOWN")
    s = s.withColumn("pricingModel", F.coalesce(F.col("__model__"), rule))
    return product_records(s, "pricingModel")
