"""Column expressions (P4–P15, X1–X24) with the warehouse's NULL rules.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside Catalyst and whole-stage codegen; there are no Python UDFs.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ColumnOrName = Column | str

# Text that stands for NULL inside a surrogate key (P8); any
# fixed non-empty token works, it only has to differ from real values.
SURROGATE_NULL_TOKEN = "__null__"
SURROGATE_SEPARATOR = "-"

# Spellings a warehouse TRY_CAST(... AS BOOLEAN) accepts (X8),
# compared after lower(trim(x)).
TRUE_SPELLINGS = ("true", "t", "yes", "y", "on", "1")
FALSE_SPELLINGS = ("false", "f", "no", "n", "off", "0")

# A plain decimal or scientific number; guards try_cast(double), which would
# also accept Java suffixes such as '1.5d', 'NaN' and 'Infinity' (X7).
NUMERIC_TEXT = r"\A\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*\z"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P4 / P14 / X1 ---------------------------------------------------------
def default_if_null(c: ColumnOrName, value) -> Column:
    """``NVL(c, value)``; an empty string is kept."""
    return F.coalesce(_c(c), F.lit(value))


# --- P5 ----------------------------------------------------------------------
def decode_flag(c: ColumnOrName, true_value: str = "t") -> Column:
    """Exact, case-sensitive match → TRUE; anything else *and NULL* → FALSE."""
    return F.when(_c(c) == F.lit(true_value), F.lit(True)).otherwise(F.lit(False))


# --- P6 ----------------------------------------------------------------------
def replace_value(c: ColumnOrName, old, new) -> Column:
    """Replace one value; NULL and every other value pass unchanged."""
    c = _c(c)
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


# --- P7 / X5 / X6 ----------------------------------------------------------
def parse_money(c: ColumnOrName, precision: int = 10, scale: int = 2,
                symbol: str = "$") -> Column:
    """Strip ``symbol`` everywhere, then cast strictly to DECIMAL(p, s).

    Under ANSI mode the cast raises on text such as ``1,200.00`` or on
    overflow and rounds half-up on extra digits — the warehouse behaviour.
    """
    return F.replace(_c(c), F.lit(symbol)).cast(DecimalType(precision, scale))


# --- P8 / X23 ------------------------------------------------------------
def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the text of every column, NULL replaced by a fixed token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


# --- P10 / X4 ---------------------------------------------------------------
def greatest_strict(*cols: ColumnOrName) -> Column:
    """GREATEST that returns NULL when any argument is NULL.

    Spark's ``greatest`` skips NULLs; the warehouse propagates them.
    """
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


# P11–P13 / X3 (CASE WHEN tiers) live in functions.tiers.


# --- P15 ---------------------------------------------------------------------
def flag_match(c: ColumnOrName) -> Column:
    """TRUE when an outer join found a partner (``c IS NOT NULL``)."""
    return _c(c).isNotNull()


# --- F7 ----------------------------------------------------------------------
def any_null(cols: Iterable[ColumnOrName]) -> Column:
    """``c1 IS NULL OR c2 IS NULL OR … OR FALSE``."""
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols], F.lit(False))


# --- F8 / X11 ---------------------------------------------------------------
def _whole_text(pattern: str) -> str:
    """Anchor a pattern to the whole text with ``\\A…\\z``.

    Java's ``$`` also matches before a final newline, so ``'12\\n'`` would
    pass ``^[0-9]+$``; leading ``^`` and trailing unescaped ``$`` are
    replaced by the strict anchors.
    """
    body = pattern[1:] if pattern.startswith("^") else pattern
    if body.endswith("$") and not re.search(r"(?<!\\)(?:\\\\)*\\\$$", body):
        body = body[:-1]
    return r"\A(?:" + body + r")\z"


def full_match(c: ColumnOrName, pattern: str) -> Column:
    """TRUE when the whole text matches ``pattern``; NULL stays NULL."""
    return _c(c).rlike(_whole_text(pattern))


# --- X7 ----------------------------------------------------------------------
def try_parse_double(c: ColumnOrName) -> Column:
    """``TRY_CAST(c AS FLOAT)``: NULL unless ``c`` is a plain number."""
    c = _c(c)
    return F.when(c.rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))


# --- X8 ----------------------------------------------------------------------
def try_parse_boolean(c: ColumnOrName) -> Column:
    """``TRY_CAST(c AS BOOLEAN)`` with the warehouse's spellings."""
    t = F.lower(F.trim(_c(c)))
    return (F.when(t.isin(*TRUE_SPELLINGS), F.lit(True))
             .when(t.isin(*FALSE_SPELLINGS), F.lit(False)))


# --- X2 ----------------------------------------------------------------------
def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` — ANSI division by zero would raise."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


# --- A7 ----------------------------------------------------------------------
def count_when(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` — NULL on empty input."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


# --- X18 / X19 ----------------------------------------------------------------
def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF(day, start, end)``: midnights crossed."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def hour_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF('hour', start, end)``: hour *boundaries* crossed.

    10:59 → 11:00 is 1, unlike a plain elapsed-time difference.
    """
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", _c(start)),
                            F.date_trunc("HOUR", _c(end)))


# --- X20 ----------------------------------------------------------------------
def as_timestamp(value=None) -> Column:
    """An ``as_of`` parameter as a TIMESTAMP_NTZ column: a Column, a
    datetime/date, or text; ``None`` means now (``CURRENT_TIMESTAMP``)."""
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


# --- X14 ----------------------------------------------------------------------
def truncate_period(c: ColumnOrName, period: str) -> Column:
    """``DATE_TRUNC(period, c)`` for hour/day/week/month; weeks start Monday."""
    period = period.lower()
    unit = {"hourly": "hour", "daily": "day", "weekly": "week",
            "monthly": "month"}.get(period, period)
    if unit not in {"hour", "day", "week", "month"}:
        raise ValueError(f"unsupported period {period!r}")
    return F.date_trunc(unit, _c(c))


def month_start(c: ColumnOrName) -> Column:
    """First day of the month as a DATE (not a timestamp)."""
    return F.trunc(F.to_date(_c(c)), "month")


# --- whole-row text, A9 --------------------------------------------------------
def row_text(cols: Sequence[ColumnOrName], null_text: str = "NULL",
             separator: str = "") -> Column:
    """Concatenate the text of every column, NULL shown as ``null_text``.

    With the default empty separator ('a','bc') and ('ab','c') give the same
    text, which is the reference's whole-row distinct semantics.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_text)) for c in cols]
    return F.concat_ws(separator, *parts)
