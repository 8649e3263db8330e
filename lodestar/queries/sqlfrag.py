"""DuckDB SQL fragments for the oracle twins of the registered queries.

These are independent re-statements of each rule in plain SQL (RE2 regexes,
``list_reduce`` for the LCS), used only to check the Spark plans.
"""

from __future__ import annotations

from lodestar.schemas import LEGAL_SUFFIX_ALTERNATIVES

# Python-str whitespace, spelled out for RE2 (whose \s is ASCII only).
DWS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
SUFFIX = r"(?i),?\s*\b(" + LEGAL_SUFFIX_ALTERNATIVES + r")\s*$"


def ustrip(x: str) -> str:
    return f"regexp_replace({x}, '^{DWS}+|{DWS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{DWS}+', ' ', 'g'))"


def strip_suffix(x: str) -> str:
    return f"trim(regexp_replace(trim({x}), '{SUFFIX}', ''))"


def norm(x: str) -> str:
    s = strip_suffix(x)
    s = f"regexp_replace({s}, '[.\\-]', '', 'g')"
    return f"lower(trim(regexp_replace({s}, '\\s+', ' ', 'g')))"


def self_canon(x: str) -> str:
    s = strip_suffix(x)
    return f"(CASE WHEN {s} = '' THEN {x} ELSE {s} END)"


def token_sort(x: str) -> str:
    return (f"array_to_string(list_sort(list_filter(string_split_regex({x}, '\\s+'), "
            f"lambda t: t <> '')), ' ')")


def lcs(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE list_reduce("
            f"list_transform(range(1, length({a}) + 1), lambda i: substr({a}, i, 1)), "
            f"lambda prev, ca: list_reduce(range(1, length({b}) + 1), lambda cur, j: "
            f"list_append(cur, CASE WHEN ca = substr({b}, j, 1) THEN prev[j] + 1 "
            f"ELSE greatest(prev[j + 1], cur[j]) END), [0]), "
            f"list_transform(range(0, length({b}) + 1), lambda x: 0))[length({b}) + 1] END)")


def kw_any(hay: str, words) -> str:
    """Any plain-substring keyword hit."""
    return "(" + " OR ".join(f"contains({hay}, '{w}')" for w in words) + ")"
