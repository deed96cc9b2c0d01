"""Scalar text expressions.

Everything here is a built-in Spark expression, so it runs inside whole-stage
codegen.  Whitespace follows Python's ``str.isspace`` (what ``strip()`` and
``split()`` use), written as one character class that Java regex and RE2 both
read the same way, so DuckDB oracles can reuse the exact pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, as a regex
# character-class body (\x{..} escapes are valid in Java regex and RE2).
WHITESPACE_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WHITESPACE_CLASS}]"
NON_WS = f"[^{WHITESPACE_CLASS}]"
# The same 29 characters listed one by one, for translate/btrim.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Truncation of long payloads (limit, kept prefix, marker).
TRUNCATE_LIMIT = 3000
TRUNCATE_KEEP = 2500
TRUNCATE_MARKER = "\n...[truncated]..."

# Fixed value: length of the first-turn fingerprint used for dedup.
FINGERPRINT_CHARS = 200

# Regexes of the reference's quality checks.
NAME_FIELD_PATTERN = r'"name":' + WS + r'*"([^"]+)"'
LOSS_PATTERN = r"[Ll]oss[: ]+([0-9]+\.[0-9]+)"


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_ws(x) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace (no regex)."""
    return F.btrim(col(x), F.lit(WHITESPACE_CHARS))


def is_nonblank(x) -> Column:
    """``bool(s.strip())``; null counts as blank.

    Decided by the first character for almost every text (no copy); only a
    text that starts with whitespace is trimmed.
    """
    c = col(x)
    first = F.substring(c, 1, 1)
    return F.coalesce(
        F.when(F.length(first) == 0, F.lit(False))
         .when(~first.isin(list(WHITESPACE_CHARS)), F.lit(True))
         .otherwise(F.length(trim_ws(c)) > 0),
        F.lit(False))


def is_nonempty(x) -> Column:
    """Not null and not the empty string."""
    return F.coalesce(F.length(col(x)) > 0, F.lit(False))


def token_count(x) -> Column:
    """``len(s.split())``: number of maximal non-whitespace runs (0 for null).

    Whitespace is mapped to one space with ``translate`` and the text split
    on that literal, about ten times faster than counting regex matches.
    """
    c = col(x)
    spaced = F.translate(c, WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    n = F.size(F.array_remove(F.split(spaced, " "), ""))
    return F.when(c.isNull(), F.lit(0)).otherwise(n).cast("bigint")


def truncate_long(x, limit: int = TRUNCATE_LIMIT, keep: int = TRUNCATE_KEEP,
                  marker: str = TRUNCATE_MARKER) -> Column:
    """Keep the first ``keep`` code points plus a marker when longer than ``limit``."""
    c = col(x)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit(marker))).otherwise(c)


def fingerprint(x, chars: int = FINGERPRINT_CHARS) -> Column:
    """First ``chars`` code points (``s[:chars]``)."""
    return F.substring(col(x), 1, chars)


def contains(x, needle: str) -> Column:
    """Substring test; null text does not contain anything."""
    return F.coalesce(col(x).contains(needle), F.lit(False))


def extract_all(x, pattern: str, group: int = 1) -> Column:
    """All matches of one capture group (``re.findall`` with one group)."""
    return F.regexp_extract_all(col(x), F.lit(pattern), F.lit(group))


def join_nonempty(parts: Column, sep: str) -> Column:
    """``sep.join(p for p in parts if p)`` (null and empty parts are left out)."""
    return F.array_join(F.filter(parts, lambda p: F.length(p) > 0), sep)


def _last_index(c: Column, ch: str) -> Column:
    """1-based position of the last ``ch`` in ``c`` (0 when absent)."""
    r = F.instr(F.reverse(c), ch)
    return F.when(r > 0, F.length(c) - r + 1).otherwise(F.lit(0))


def _span(c: Column, open_ch: str, close_ch: str) -> Column:
    """Greedy span from the first ``open_ch`` to the last ``close_ch`` after it."""
    first = F.instr(c, open_ch)
    last = _last_index(c, close_ch)
    return F.when((first > 0) & (last > first), F.substring(c, first, last - first + 1))


# Python's json.loads also reads the literals NaN, Infinity and -Infinity; for the
# validity test they stand in as 0 when they are whole tokens.
_NON_FINITE = r"(?<![-\w.])(?:NaN|-?Infinity)(?![\w.])"


def _parses(c: Column) -> Column:
    """``c`` is exactly one JSON value, as ``json.loads`` reads it.

    ``try_parse_json`` stops after the first value and ignores what follows;
    a string that also parses inside ``[...]`` and as the value of
    ``{"v": ...}`` cannot carry trailing content (the two wrappers cannot
    both be closed early).  Whole-token ``NaN``/``Infinity`` are accepted as
    Python does.
    """
    c = F.regexp_replace(c, F.lit(_NON_FINITE), F.lit("0"))
    return (F.try_parse_json(c).isNotNull()
            & F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).isNotNull()
            & F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}"))).isNotNull())


def embedded_json_match(x) -> Column:
    """``STRUCT<kind, json>`` of the first rule that parses (one pass over the rules)."""
    c = col(x)
    arr = _span(c, "[", "]")
    obj = _span(c, "{", "}")

    def hit(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("json"))

    return (F.when(_parses(c), hit("whole", c))
            .when(arr.isNotNull() & _parses(arr), hit("array", arr))
            .when(obj.isNotNull() & _parses(obj), hit("object", obj)))


def embedded_json(x) -> Column:
    """JSON found in free text: the whole string, else the greedy ``[...]``
    span, else the greedy ``{...}`` span; null when none parses.

    Returns the matching text (not a re-serialisation), so it can be
    compared or parsed with any schema downstream.
    """
    return embedded_json_match(x)["json"]


def bracket_span(x) -> Column:
    """Simpler form: text from the first ``[`` to the last ``]``."""
    return _span(col(x), "[", "]")
