"""Row filters: non-empty values and a month lower bound with partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import month_start, nonempty, validate_period


def filter_nonempty(df: DataFrame, column: str = "operation") -> DataFrame:
    return df.where(nonempty(column))


def implied_period_predicate(year: int, month: int, year_col: str = "year",
                             month_col: str = "month"):
    """``(year, month) >= (Y, M)`` over stored period columns."""
    year, month = validate_period(year, month)
    y, m = F.col(year_col), F.col(month_col)
    return (y > F.lit(year)) | ((y == F.lit(year)) & (m >= F.lit(month)))


def filter_date_from(df: DataFrame, year: int, month: int, date_col: str = "fulldate",
                     period_cols: tuple[str, str] | None = None) -> DataFrame:
    """Rows dated on or after the first day of (year, month); no upper bound.

    ``period_cols`` names stored (year, month) columns that are derived from
    ``date_col`` -- the partition columns of the published layout.  Adding the
    implied predicate on them lets Spark prune whole partition directories,
    which a predicate on the date alone cannot do.
    """
    out = df.where(F.col(date_col) >= month_start(year, month))
    if period_cols is not None:
        out = out.where(implied_period_predicate(year, month, *period_cols))
    return out


def filter_month(df: DataFrame, year: int, month: int, date_col: str = "fulldate",
                 period_cols: tuple[str, str] | None = None) -> DataFrame:
    """Rows of exactly one calendar month (``>= start and < start + 1 month``)."""
    start = month_start(year, month)
    out = df.where((F.col(date_col) >= start) & (F.col(date_col) < F.add_months(start, 1)))
    if period_cols is not None:
        y, m = period_cols
        out = out.where((F.col(y) == F.lit(int(year))) & (F.col(m) == F.lit(int(month))))
    return out
