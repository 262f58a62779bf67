"""Scalar text functions on Columns: whitespace, blank test, markup cleaning,
timestamp parsing, zero-padded dates.

Everything here is a built-in ``pyspark.sql.functions`` expression, so it stays
inside whole-stage codegen.  The same regular expressions run unchanged in
DuckDB (RE2), which is how the oracle queries check them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for identical results)
# ---------------------------------------------------------------------------
# Python's notion of whitespace (str.isspace / str.split() / str.strip()):
#   U+0009..U+000D, U+001C..U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A,
#   U+2028, U+2029, U+202F, U+205F, U+3000
WS_RANGES = ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
             (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
WS_CLASS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# User mention, channel reference and wrapped URL markup.
MENTION_RE = r"<@([A-Za-z0-9]+)>"
MENTION_SPLIT_RE = r"<@[A-Za-z0-9]+>"
CHANNEL_RE = r"<#([A-Za-z0-9]+)\|([^>]+)>"
UNKNOWN_USER = "Unknown User"
# A numeric ts string as accepted by float(), without nan/inf/underscores.
TS_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# ---------------------------------------------------------------------------


def _non_ws_class() -> str:
    """Every code point outside ``WS_RANGES``, written as positive ranges with
    the one holding ASCII letters first.  Same set as ``[^...WS...]``, but
    Java's regex engine accepts an ordinary character on its first range test
    instead of testing it against every whitespace range (about 4x faster on
    the URL pattern); RE2 reads it the same way."""
    gaps, lo = [], 0
    for a, b in WS_RANGES:
        if a > lo:
            gaps.append((lo, a - 1))
        lo = b + 1
    gaps.append((lo, 0x10FFFF))
    gaps.sort(key=lambda r: (not (r[0] <= ord("a") <= r[1]), r[0]))
    return "[" + "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in gaps) + "]"


NON_WS_CLASS = _non_ws_class()
URL_RE = r"<(http" + NON_WS_CLASS + r"+)>"
WS_LEADING = "^" + WS_CLASS + "+"
WS_TRAILING = WS_CLASS + "+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_nonblank(text) -> Column:
    """text is present and not only (Python) whitespace."""
    t = _c(text)
    return t.isNotNull() & t.rlike(NON_WS_CLASS)


def strip_ws(text) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace."""
    return F.regexp_replace(F.regexp_replace(_c(text), WS_LEADING, ""), WS_TRAILING, "")


_WIDE_WS = "".join(chr(c) for a, b in WS_RANGES for c in range(a, b + 1) if c > 0x7F)
_ASCII_WS_RUN = r"[\t-\r\x1c-\x20]+"


def collapse_ws(text) -> Column:
    """T4: ``' '.join(text.split())`` - every whitespace run becomes one space,
    ends trimmed (newlines are lost, as in the reference).  Non-ASCII
    whitespace is first mapped to spaces with ``translate`` (a table lookup),
    so the run pattern is an ASCII class; runs stay runs, the result is the
    same as collapsing with the full class."""
    t = F.translate(_c(text), _WIDE_WS, " " * len(_WIDE_WS))
    return F.btrim(F.regexp_replace(t, _ASCII_WS_RUN, " "), F.lit(" "))


def replace_channel_refs(text) -> Column:
    """``<#C123|general>`` -> ``#general``; ``<#C123>`` stays."""
    return F.regexp_replace(_c(text), CHANNEL_RE, "#$2")


def unwrap_urls(text) -> Column:
    """``<http...>`` -> inner text (greedy up to the last ``>`` before
    whitespace; a ``|label`` is kept)."""
    return F.regexp_replace(_c(text), URL_RE, "$1")


def rejoin_mentions(text, names: Column) -> Column:
    """Each ``<@ID>`` becomes its ``@name`` from ``names``, given in
    mention order.  Names are inserted literally (no ``$``/``\\`` expansion): the
    text is split at the mentions and re-joined with the names."""
    t = _c(text)
    parts = F.split(t, MENTION_SPLIT_RE, -1)
    names = F.concat(F.coalesce(names, F.array().cast("array<string>")), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(parts, names, lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    return F.when(F.instr(t, "<@") > 0, joined).otherwise(t)


def clean_rest(text) -> Column:
    """T2 -> T3 -> T4 (what T6 does after T5 and T1).  Both markup
    patterns start with ``<``: a text without one only needs T4."""
    t = _c(text)
    return F.when(F.instr(t, "<") > 0, collapse_ws(unwrap_urls(replace_channel_refs(t)))).otherwise(collapse_ws(t))


def parse_ts(ts) -> Column:
    """Numeric ts string -> double; NULL when not a finite decimal number."""
    t = strip_ws(_c(ts))
    return F.when(t.rlike(TS_RE), t.try_cast("double"))


def epoch_micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def date_string(y, m, d) -> Column:
    """``f"{y}-{m:02d}-{d:02d}"`` (year not padded) for int Columns."""
    return F.format_string("%d-%02d-%02d", _c(y), _c(m), _c(d))
