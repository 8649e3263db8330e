"""Date scalars (X4-X8, F3): flexible publication-date parsing, relative
phrases, strict ISO, epoch year and the freshness predicate.

All branches are native expressions guarded by ``try_`` forms so a bad value
yields null instead of failing the task under ANSI mode.  Results are UTC
instants and do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.text import col_of, lit_array, lit_map, ustrip
from lodestar.schemas import DAY_NAMES, MONTH_NAMES, ZONE_OFFSETS

__all__ = [
    "epoch_to_ts", "parse_flexible_date", "parse_news_date", "relative_date",
    "rfc822_date", "iso_date", "strict_iso_ts", "epoch_year", "is_fresh", "as_of_lit",
]

MIN_EPOCH = -62135596800          # 0001-01-01T00:00:00Z
MAX_EPOCH = 253402300799          # 9999-12-31T23:59:59Z
MIN_MICROS = MIN_EPOCH * 1_000_000

REL_RE = r"(?iU)(\d+)\s*(second|minute|hour|day)s?\s*ago"

# RFC 822: optional leading day token, day, month, year, time, optional zone.
_DAYS = "|".join(DAY_NAMES)
RFC_PREFIX_RE = r"(?i)^(?:\S*,\s*|(?:" + _DAYS + r")\s+)"
RFC_SWAP_RE = r"^([A-Za-z]+)\s+(\d+),?(\s+)"
# RFC 850 ``15-Sep-26 10:00:00 GMT`` (exactly three tokens) -> spaced form.
RFC850_RE = r"^(\d+)-([A-Za-z]+)-(\d+)(\s+\S+\s+\S+)$"
# Dot-separated times (``10.00.00`` / ``10.00``) read like colon ones.
RFC_DOT3_RE = r"^(\d+,?\s+[A-Za-z]+,?\s+\d+,?\s+)(\d+)\.(\d+)\.(\d+)(?=\s|$|[+-])"
RFC_DOT2_RE = r"^(\d+,?\s+[A-Za-z]+,?\s+\d+,?\s+)(\d+)\.(\d+)(?=\s|$|[+-])"
# Time written before the year: ``15 Sep 10:00:00 2026 ...``.
RFC_TIME_FIRST_RE = r"^(\d+,?\s+[A-Za-z]+,?\s+)(\d+:[\d:]+)(\s+)(\d+)\b"
RFC_RE = (r"^(\d+),?\s+([A-Za-z]+),?\s+(\d+),?\s+(\d+):(\d+)(?::(\d+))?,?"
          r"(?:([+-]\d+)\s*$|\s+(\S+)(?:\s+.*)?$|\s*$)")

ISO_RE = (r"^(\d{4})-(\d{2})-(\d{2})"
          r"(?:[T ](\d{2})(?::(\d{2})(?::(\d{2})(\.\d+)?)?)?"
          r"(Z|[+-]\d{2}(?::?\d{2})?)?)?$")


def as_of_lit(as_of) -> Column:
    """An ``as_of`` argument as a timestamp Column (datetime, string or Column)."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=_dt.timezone.utc)
        return F.timestamp_micros(F.lit(int(as_of.timestamp() * 1_000_000)))
    return F.to_timestamp(F.lit(as_of))


def epoch_to_ts(c) -> Column:
    """Seconds since the epoch (integral or fractional) -> timestamp; out of
    the year 1..9999 range -> null."""
    c = col_of(c)
    d = c.cast("double")
    micros = F.round(d * F.lit(1_000_000.0)).cast("long")
    return F.when((d >= MIN_EPOCH) & (d <= MAX_EPOCH), F.timestamp_micros(micros))


SEP = "\u0001"


def _let(value: Column, fn) -> Column:
    """Bind ``value`` once and use it several times in ``fn`` (a one-element
    ``transform``); keeps big parse trees small and each regex single-pass."""
    return F.get(F.transform(F.array(value), fn), 0)


def _groups(s: Column, pattern: str, n: int) -> Column:
    """All ``n`` capture groups of a full-string match in one regex pass:
    ``split(regexp_replace(s, pattern, '$1<SEP>$2...'), SEP)``; a string that
    does not match gives an array of size 1."""
    repl = SEP.join(f"${i}" for i in range(1, n + 1))
    return F.when(~F.contains(s, F.lit(SEP)), F.split(F.regexp_replace(s, pattern, repl), SEP))


REL_FULL_RE = r"(?isU)^.*?(\d+)\s*(second|minute|hour|day)s?\s*ago.*$"
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def relative_date(raw, as_of) -> Column:
    """``N second/minute/hour/day(s) ago`` found anywhere -> as_of - N units.
    Non-matching text or an amount that overflows -> null (D16)."""
    a = as_of_lit(as_of)

    def body(g):
        n = g[0].try_cast("bigint")
        unit = F.lower(g[1])
        secs = F.try_element_at(lit_map(UNIT_SECONDS), unit).cast("bigint")
        micros = F.try_multiply(F.try_multiply(n, secs), F.lit(1_000_000).cast("bigint"))
        res = F.try_subtract(F.unix_micros(a), micros)
        return F.when((F.size(g) == 2) & (res >= F.lit(MIN_MICROS)), F.timestamp_micros(res))
    return _let(_groups(col_of(raw), REL_FULL_RE, 2), body)


def rfc822_date(raw) -> Column:
    """RFC 822 / 2822 dates the way ``email.utils`` reads them: optional day
    name, day and month in either order, 2- or 4-digit year, optional seconds,
    zone from the fixed table, a signed ``hhmm`` number, else UTC."""
    s = F.regexp_replace(ustrip(raw), RFC_PREFIX_RE, "")
    s = F.regexp_replace(s, RFC850_RE, "$1 $2 $3$4")
    s = F.regexp_replace(s, RFC_SWAP_RE, "$2$3$1 ")
    s = F.regexp_replace(s, RFC_TIME_FIRST_RE, "$1$4$3$2")
    s = F.regexp_replace(s, RFC_DOT3_RE, "$1$2:$3:$4")
    s = F.regexp_replace(s, RFC_DOT2_RE, "$1$2:$3")
    zmap = lit_map(ZONE_OFFSETS)
    months = lit_array(MONTH_NAMES)

    def body(g):
        dd = g[0].try_cast("int")
        mon_idx = F.array_position(months, F.lower(g[1]))
        mm = F.when(mon_idx > 0, ((mon_idx - 1) % 12) + 1).cast("int")
        y = g[2].try_cast("int")
        yy = F.when(y < 100, F.when(y > 68, y + 1900).otherwise(y + 2000)).otherwise(y)
        hh, mi = g[3].try_cast("int"), g[4].try_cast("int")
        ss = F.coalesce(F.nullif(g[5], F.lit("")).try_cast("int"), F.lit(0))
        ztok = F.upper(F.when(g[6] != "", g[6]).otherwise(g[7]))
        num = F.when(ztok.rlike(r"^[+-]?\d+$"), ztok.try_cast("int"))
        hhmm = F.coalesce(F.try_element_at(zmap, ztok), num, F.lit(0))
        off = F.signum(hhmm).cast("int") * ((F.abs(hhmm) / 100).cast("int") * 3600
                                            + (F.abs(hhmm) % 100) * 60)
        local = F.try_make_timestamp(yy, mm, dd, hh, mi, ss.cast("decimal(16,6)"), F.lit("UTC"))
        valid = (F.size(g) == 8) & (ss < 60) & (F.abs(off) < 86400) & (yy >= 1) & local.isNotNull()
        return F.when(valid, F.timestamp_micros(F.unix_micros(local) - off.cast("bigint") * F.lit(1_000_000)))
    return _let(_groups(s, RFC_RE, 8), body)


def iso_date(raw, compact: bool = False) -> Column:
    """ISO 8601 date or date-time; no zone means UTC.  ``compact`` also reads
    a bare ``yyyyMMdd``."""
    s = ustrip(raw)

    def dflt(c, v):
        return F.when(c == "", F.lit(v)).otherwise(c)

    def body(g):
        canon = F.concat(g[0], F.lit("-"), g[1], F.lit("-"), g[2], F.lit("T"),
                         dflt(g[3], "00"), F.lit(":"), dflt(g[4], "00"), F.lit(":"),
                         dflt(g[5], "00"), g[6], dflt(g[7], "Z"))
        return F.when(F.size(g) == 8, canon.try_cast("timestamp"))
    res = _let(_groups(s, ISO_RE, 8), body)
    if compact:
        def cbody(t):
            cd = F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 5, 2), F.lit("-"),
                          F.substring(t, 7, 2), F.lit("T00:00:00Z")).try_cast("timestamp")
            return F.when(t.rlike(r"^\d{8}$"), cd)
        res = F.coalesce(_let(s, cbody), res)
    return res


def parse_flexible_date(raw, as_of, epoch: bool = True) -> Column:
    """X4 (``epoch=True``) / X5 (``epoch=False``): the first branch that
    applies wins: digits as epoch seconds, relative phrase, RFC 822, ISO 8601.
    Unparseable or empty -> null."""
    raw = col_of(raw).cast("string")

    def body(s):
        out = F.when(s.isNull() | (s == ""), F.lit(None).cast("timestamp"))
        if epoch:
            digits = s.rlike(r"^\d+$")
            out = out.when(digits, epoch_to_ts(s.try_cast("bigint")))
        out = out.when((F.instr(F.lower(s), "ago") > 0) & s.rlike(REL_RE), relative_date(s, as_of))
        # ISO needs ``dddd-`` up front and RFC 822 never has it: route by the
        # 5th character instead of trying both regexes.
        iso_shaped = F.substr(s, F.lit(5), F.lit(1)) == "-"
        out = out.when(iso_shaped, iso_date(s, compact=False))
        if not epoch:
            out = out.when(F.length(s) == 8, iso_date(s, compact=True))
        return out.otherwise(rfc822_date(s))
    return _let(ustrip(raw), body)


def parse_news_date(raw, as_of) -> Column:
    """The news-feed variant without the epoch branch."""
    return parse_flexible_date(raw, as_of, epoch=False)


def strict_iso_ts(raw) -> Column:
    """Exactly ``yyyy-MM-ddTHH:mm:ssZ`` read as UTC, anything else null."""
    s = col_of(raw)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
                  F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


def epoch_year(c) -> Column:
    """UTC year of an epoch-seconds value; 0/null/out of range -> null."""
    x = col_of(c).cast("bigint")
    days = F.floor(x / F.lit(86400)).cast("int")
    return F.when((x != 0) & (x >= MIN_EPOCH) & (x <= MAX_EPOCH),
                  F.year(F.date_from_unix_date(days)).cast("bigint"))


def is_fresh(ts, as_of, hours: int = 24, upper_bound: bool = False) -> Column:
    """``ts >= as_of - hours``; null is not fresh; future instants pass
    unless ``upper_bound`` (D3)."""
    a = as_of_lit(as_of)
    lo = F.timestamp_micros(F.unix_micros(a) - F.lit(hours * 3600 * 1_000_000))
    # Comparisons only: a null test of its own would make Catalyst evaluate a
    # parsed ``ts`` once more per row.
    cond = col_of(ts).between(lo, a) if upper_bound else col_of(ts) >= lo
    return F.coalesce(cond, F.lit(False))
