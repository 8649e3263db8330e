"""Model-reply and response scalars (X18-X22, X24, X25): truncation budget,
token estimate, reply unfencing and parsing, response outcome classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.text import col_of, ustrip
from lodestar.schemas import PRICING_MODELS, TRUNCATION_MARKER

__all__ = ["truncate_text", "estimate_tokens", "unfence_reply", "parse_reply",
           "reply_field_enum", "outcome_class", "retry_after_seconds"]


def truncate_text(c, max_chars: int = 6000, keep_head_ratio: float = 0.7) -> Column:
    """Texts over ``max_chars`` become head + marker + tail.

    head = int(max_chars * ratio); tail = max(0, max_chars - head - len(marker)).
    With a tiny budget the result can exceed it (D10), as specified.
    """
    c = col_of(c)
    head = int(max_chars * keep_head_ratio)
    tail = max(0, max_chars - head - len(TRUNCATION_MARKER))
    tail_col = F.right(c, F.lit(tail)) if tail > 0 else F.lit("")
    return F.when(F.length(c) <= max_chars, c).otherwise(
        F.concat(F.left(c, F.lit(head)), F.lit(TRUNCATION_MARKER), tail_col))


def estimate_tokens(c) -> Column:
    """Characters // 4."""
    return F.floor(F.length(col_of(c)) / 4).cast("bigint")


def unfence_reply(c) -> Column:
    """Trim; if the reply starts with three backticks strip all
    surrounding backticks, a leading ``json`` tag, and trim again."""
    t = ustrip(c)
    inner = F.regexp_replace(t, r"^`+|`+$", "")
    inner = ustrip(F.regexp_replace(inner, r"^json", ""))
    return F.when(t.startswith("```"), inner).otherwise(t)


def parse_reply(c) -> Column:
    """Reply text -> VARIANT, or null when it is not valid JSON."""
    return F.try_parse_json(unfence_reply(c))


def reply_field_enum(parsed, field: str = "pricingModel", allowed=None,
                     default: str = "UNKNOWN") -> Column:
    """Read ``field`` from a parsed reply, upper-case it, keep it only if
    it is one of ``allowed``; anything else (missing field, non-object JSON,
    unknown value) is ``default``."""
    allowed = allowed or PRICING_MODELS
    v = F.upper(F.try_variant_get(col_of(parsed), f"$.{field}", "string"))
    return F.when(v.isin(*allowed), v).otherwise(F.lit(default))


def outcome_class(status, kind: str = "model", remaining=None) -> Column:
    """Response outcome ``ok`` / ``retryable`` / ``permanent`` / ``empty``.

    kinds: ``model`` (429, 5xx retryable; 413, 401, 403, other permanent),
    ``feed`` (429, 5xx retryable; others permanent), ``search`` (403 with
    remaining=0 retryable; 422 empty), ``repo`` (403 with remaining=0
    retryable; 404 empty), ``tag`` (404 empty).
    """
    s = col_of(status)
    out = F.when(s == 200, F.lit("ok"))
    if kind in ("search", "repo"):
        rem = F.coalesce(col_of(remaining).cast("string"), F.lit("")) if remaining is not None \
            else F.lit("")
        out = out.when((s == 403) & (rem == "0"), F.lit("retryable"))
        out = out.when(s == (422 if kind == "search" else 404), F.lit("empty"))
    else:
        out = out.when(s == 429, F.lit("retryable"))
        if kind == "tag":
            out = out.when(s == 404, F.lit("empty"))
    out = out.when(s >= 500, F.lit("retryable"))
    return out.otherwise(F.lit("permanent"))


def retry_after_seconds(c) -> Column:
    """Numeric Retry-After header in seconds, else null."""
    return ustrip(c).try_cast("double")
