"""Scalar expressions, all built from JVM-side Spark functions (no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def validate_period(year: int, month: int) -> tuple[int, int]:
    """Typed period arguments; rejects what would otherwise fail in a date."""
    year, month = int(year), int(month)
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1..12, got {month}")
    if not 1 <= year <= 9999:
        raise ValueError(f"year out of range: {year}")
    return year, month


def month_start(year: int, month: int) -> Column:
    """First day of a month as a date literal (folded by Catalyst)."""
    year, month = validate_period(year, month)
    return F.lit(_dt.date(year, month, 1))


def period_literal(year: int, month: int) -> str:
    """'YYYYMM' with a two-digit month, from validated ints."""
    year, month = validate_period(year, month)
    return f"{year}{month:02d}"


def period_key(year_col="year", month_col="month") -> Column:
    """'YYYYMM' from stored year / month columns (month left-padded)."""
    return F.concat(_col(year_col).cast("string"),
                    F.lpad(_col(month_col).cast("string"), 2, "0"))


def to_day(c) -> Column:
    """``date(x)``: a date from a date, timestamp or 'yyyy-MM-dd' string."""
    return F.to_date(_col(c))


def coalesce_default(c, default=0) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def nonempty(c="operation") -> Column:
    """Not NULL and not the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


#: Amounts from here up are no amounts: a double that large has no cents.
MONEY_LIMIT = 1e15
MONEY = "decimal(38,6)"

# Whole millionths of amounts below this are exact in a double and in a long.
_NARROW_LIMIT = 1e9
_LIMB_BITS = 24


def amount_test(name: str) -> str:
    """SQL: a double that can be an amount: no NaN, no infinity, below the limit."""
    return f"not isnan({name}) and abs({name}) < {MONEY_LIMIT:.0e}D"


def is_amount(c) -> Column:
    """``amount_test`` of a column."""
    c = _col(c)
    return ~F.isnan(c) & (F.abs(c) < F.lit(MONEY_LIMIT))


def money(c) -> Column:
    """An amount as an exact decimal: the shortest decimal that names the
    double, half up to six places.  Sums of doubles depend on the order rows
    arrive in; sums of decimals do not.  Amounts are rounded once, after the
    sum (``rounded``), not row by row.  What is no amount (``is_amount``; the
    mapping counts such values as rejects) becomes NULL."""
    c = _col(c)
    return F.when(is_amount(c), c.try_cast(MONEY))


def money_sum(c) -> Column:
    """Exact sum of ``money`` values (NULL when there is none), as decimal.

    Nearly all amounts are below 10^9 with at most six places: those are
    summed as whole millionths in two longs (upper and lower bits apart, so
    neither can overflow), which stays on the fast path of Spark's aggregates.
    Whatever is not exactly such a number goes into a decimal sum beside it.
    """
    c = _col(c).cast("double")
    size = F.abs(c)
    millionths = F.floor(size * F.lit(1e6) + F.lit(0.5))
    is_narrow = (size < F.lit(_NARROW_LIMIT)) & (millionths.cast("double") / F.lit(1e6) == size)
    narrow = F.when(is_narrow, F.when(c < 0, -millionths).otherwise(millionths))
    upper = F.sum(F.shiftright(narrow, _LIMB_BITS))
    lower = F.sum(narrow.bitwiseAND(F.lit((1 << _LIMB_BITS) - 1).cast("bigint")))
    wide = F.sum(F.when(~F.coalesce(is_narrow, F.lit(True)), money(c)))
    units = upper.cast("decimal(20,0)") * F.lit(1 << _LIMB_BITS).cast("decimal(9,0)") + lower.cast("decimal(20,0)")
    exact = (units * F.lit("0.000001").cast("decimal(7,6)")).cast(MONEY)
    return F.coalesce(exact + wide, exact, wide).cast(MONEY)


def rounded(c) -> Column:
    """An exact sum as a currency amount: half up to two decimals, as double."""
    return F.round(_col(c), 2).cast("double")


def exact_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """double -> decimal by the shortest decimal that names it (NULL stays
    NULL; a value that the decimal cannot hold becomes NULL)."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def decode_object_key(c) -> Column:
    """Decode a URL-encoded object key the way form decoding does.

    ``+`` becomes a space and ``%XX`` escapes are decoded; a ``%`` that does
    not start a valid escape is kept literally (it is escaped to ``%25``
    before decoding, so the decoder never fails).
    """
    escaped = F.regexp_replace(_col(c), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(escaped)
