"""Record cleaning: N/A sentinels and the multi-format timestamp parse.

The parse accepts exactly what Python's ``datetime.strptime`` accepts for
``%m/%d/%y %H:%M``, ``%m/%d/%Y %H:%M`` and ``%m/%d/%y %H:%M:%S`` (first hit
wins): one- or two-digit fields, a space-padded day, any blank run where the
format has a space, two-digit years 69-99 -> 19xx and 00-68 -> 20xx, real
calendar dates only, seconds 0-59.  Java's pattern parser differs on several
of these, so the fields are taken apart with anchored regexes and rebuilt
with ``try_make_timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import WS, py_strip

# The accepted field shapes (as strptime's directives) and the
# two-digit-year pivot.
_MON = r"(1[0-2]|0[1-9]|[1-9])"
_DAY = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_Y2 = r"([0-9]{2})"
_Y4 = r"(?!0000)([0-9]{4})"  # there is no year 0
_HOUR = r"(2[0-3]|[01][0-9]|[0-9])"
_MIN = r"([0-5][0-9]|[0-9])"
_SEC = r"([0-5][0-9]|[0-9])"
_SP = WS + "+"
YEAR_PIVOT = 69

FORMATS = [
    ("%m/%d/%y %H:%M", rf"^{_MON}/{_DAY}/{_Y2}{_SP}{_HOUR}:{_MIN}$", 2, False),
    ("%m/%d/%Y %H:%M", rf"^{_MON}/{_DAY}/{_Y4}{_SP}{_HOUR}:{_MIN}$", 4, False),
    ("%m/%d/%y %H:%M:%S", rf"^{_MON}/{_DAY}/{_Y2}{_SP}{_HOUR}:{_MIN}:{_SEC}$", 2, True),
]
NA_VALUES = ("n/a", "na")
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _one(s: Column, pattern: str, ydigits: int, secs: bool) -> Column:
    def g(i):
        return F.regexp_extract(s, pattern, i)

    year = g(3).cast("int")
    if ydigits == 2:
        year = F.when(year >= YEAR_PIVOT, year + 1900).otherwise(year + 2000)
    day = F.trim(g(2)).cast("int")
    sec = g(6).cast("decimal(8,6)") if secs else F.lit(0).cast("decimal(8,6)")
    ts = F.try_make_timestamp(year, g(1).cast("int"), day, g(4).cast("int"), g(5).cast("int"), sec)
    return F.when(s.rlike(pattern), ts)


def parse_timestamp(c) -> Column:
    """Parse a stripped string with the three formats; null when none fits."""
    s = py_strip(_c(c))
    return F.coalesce(*[_one(s, p, y, sec) for _, p, y, sec in FORMATS]).cast("timestamp")


def null_if_na(c) -> Column:
    """Null for null, empty, or (stripped, any case) ``n/a`` / ``na``."""
    x = _c(c)
    return F.when(x.isNull() | (x == "") | F.lower(py_strip(x)).isin(*NA_VALUES),
                  F.lit(None).cast("string")).otherwise(x)


def iso_timestamp(ts) -> Column:
    """ISO-8601 text without zone, as ``datetime.isoformat()`` for whole seconds."""
    return F.date_format(_c(ts), ISO_FORMAT)


def iso_or_null(c) -> Column:
    """Sentinel check, then parse: the timestamp for a raw record field."""
    return parse_timestamp(null_if_na(c))
