"""Text scalars: name normalisation, suffix strip, whitespace, markup, urls,
arrays to text, prompt building.

Regexes use ``(?U)`` so ``\\s`` and ``\\b`` are Unicode-aware, matching how a
Python ``str`` regex treats them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.schemas import LEGAL_SUFFIX_ALTERNATIVES, NO_DESCRIPTION

__all__ = [
    "col_of", "lit_array", "lit_map", "ustrip", "strip_legal_suffix", "normalize_name", "self_canonical",
    "first_nonempty", "collapse_space", "strip_markup", "cut_text", "split_title",
    "url_tail", "bare_id", "repo_owner_repo", "drop_empty", "array_text",
    "token_sort", "build_prompt", "display_cut", "percent",
]

# Whitespace as a Python ``str`` regex sees it: Unicode White_Space plus the
# ASCII separators U+001C..U+001F.
WS = r"[\s\x1c-\x1f]"
SUFFIX_RE = r"(?iU),?" + WS + r"*\b(" + LEGAL_SUFFIX_ALTERNATIVES + r")" + WS + r"*$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def lit_array(values) -> Column:
    """A constant array built from one SQL literal (one JVM call, not one per element)."""
    return F.expr("array(" + ", ".join(_sql_lit(v) for v in values) + ")")


def lit_map(pairs: dict) -> Column:
    """A constant map built from one SQL literal."""
    return F.expr("map(" + ", ".join(f"{_sql_lit(k)}, {_sql_lit(v)}" for k, v in pairs.items()) + ")")


def ustrip(c) -> Column:
    """Strip leading/trailing Unicode whitespace (SQL ``trim`` only strips spaces).
    One anchored regex; the input is referenced once, so nested calls stay
    linear (a CASE guard would repeat the input and compound when nested)."""
    return F.regexp_replace(col_of(c), r"(?U)^" + WS + r"+|" + WS + r"+$", "")


def strip_legal_suffix(c) -> Column:
    """Drop one trailing legal suffix (``Foo Co Inc`` -> ``Foo Co``)."""
    return ustrip(F.regexp_replace(ustrip(c), SUFFIX_RE, ""))


def normalize_name(c) -> Column:
    """Trim, strip one legal suffix, delete ``.``/``-``, collapse spaces, lower."""
    n = strip_legal_suffix(c)
    n = F.regexp_replace(n, r"[.\-]", "")
    n = ustrip(F.regexp_replace(n, r"(?U)" + WS + "+", " "))
    return F.lower(n)


def self_canonical(c) -> Column:
    """Canonical form of an unmatched name: suffix stripped, else the raw value."""
    s = strip_legal_suffix(c)
    return F.when(s == "", col_of(c)).otherwise(s)


def first_nonempty(*cols) -> Column:
    """``a or b or None`` over strings: first value that is not null/empty."""
    return F.coalesce(*[F.nullif(col_of(c), F.lit("")) for c in cols])


def collapse_space(c) -> Column:
    """Every whitespace run to one space, then trim."""
    return F.trim(F.regexp_replace(col_of(c), r"(?U)" + WS + "+", " "))


def cut_text(c, n: int | None = 2000) -> Column:
    """Cut to ``n`` characters (None: whole); empty result -> null."""
    return F.nullif(col_of(c) if n is None else F.left(col_of(c), F.lit(n)), F.lit(""))


def strip_markup(c, n: int | None = 2000) -> Column:
    """Remove ``<...>`` tags, cut to ``n`` characters, empty -> null."""
    return cut_text(F.regexp_replace(F.coalesce(col_of(c), F.lit("")), r"<[^>]+>", ""), n)


def split_title(c):
    """X11: ``Company: Title`` split at the first colon -> (company, title).

    Without a colon the company is ``Unknown`` and the title the whole text.
    """
    c = col_of(c)
    has = F.instr(c, ":") > 0
    company = F.when(has, ustrip(F.substring_index(c, ":", 1))).otherwise(F.lit("Unknown"))
    rest = F.substring(c, F.instr(c, ":") + 1, F.lit(1 << 30))
    title = F.when(has, ustrip(rest)).otherwise(ustrip(c))
    return company, title


def url_tail(c) -> Column:
    """Last ``/``-separated part of a url (the versioned paper id)."""
    return F.substring_index(col_of(c), "/", -1)


def bare_id(c) -> Column:
    """Id without its version: text before the first ``v``."""
    return F.substring_index(col_of(c), "v", 1)


def repo_owner_repo(c):
    """(owner, repo) from a repository url; null when fewer than 2 parts."""
    tail = F.substring_index(F.regexp_replace(col_of(c), r"/+$", ""), "github.com/", -1)
    parts = F.split(tail, "/")
    ok = F.size(parts) >= 2
    return (F.when(ok, F.get(parts, 0)), F.when(ok, F.get(parts, 1)))


def drop_empty(c) -> Column:
    """Drop null and empty elements of a string array."""
    return F.filter(col_of(c), lambda x: x != "")


def array_text(c, sep: str) -> Column:
    """Join an array with ``sep``; a null array gives ``''``."""
    return F.array_join(F.coalesce(col_of(c), F.array().cast("array<string>")), sep)


def token_sort(c) -> Column:
    """Split on whitespace, sort tokens by code point, join with one space."""
    toks = F.filter(F.split(col_of(c), r"(?U)" + WS + "+"), lambda x: x != "")
    return F.array_join(F.array_sort(toks), " ")


def build_prompt(name, description) -> Column:
    """Classification prompt text."""
    desc = F.coalesce(F.nullif(col_of(description), F.lit("")), F.lit(NO_DESCRIPTION))
    return F.concat(F.lit("Startup name: "), F.coalesce(col_of(name), F.lit("None")),
                    F.lit("\nDescription: "), desc)


def display_cut(c, n: int = 60) -> Column:
    """First ``n`` characters for display."""
    return F.left(F.coalesce(col_of(c), F.lit("")), F.lit(n))


def percent(part, total, digits: int = 1) -> Column:
    """``round(100*part/total, digits)``; null when the total is 0."""
    return F.when(col_of(total) > 0,
                  F.round(F.lit(100.0) * col_of(part) / col_of(total), digits))
