"""Aggregation building blocks (all map-side combinable)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.scalars import money_sum, rounded
from ledgerlake.schemas import CARD_TYPES_SEPARATOR


def count_sum(df: DataFrame, keys: list[str], id_col: str, amount_col: str,
              count_name: str = "total_count", sum_name: str = "total_amount") -> DataFrame:
    """``count(id)`` (non-NULL ids) and ``sum(amount)`` (NULL for no values)."""
    return df.groupBy(*keys).agg(F.count(id_col).alias(count_name),
                                 rounded(money_sum(amount_col)).alias(sum_name))


def rounded_total(amount_col: str) -> Column:
    """``round(coalesce(sum(amount), 0), 2)`` over the exact sum; a double."""
    return rounded(F.coalesce(money_sum(amount_col), F.lit(0)))


def total(df: DataFrame, amount_col: str) -> Column:
    """``round(coalesce(sum(amount), 0), 2)`` in the column's own kind: a long
    column has a long total (no rounding, nothing lost beyond 2**53)."""
    if isinstance(df.schema[amount_col].dataType, T.IntegralType):
        return F.coalesce(F.sum(amount_col), F.lit(0)).cast("bigint")
    return rounded_total(amount_col)


def conditional_sum(value_col: str, category_col: str, category: str) -> Column:
    """``sum(case when category = c then value else 0 end)`` (double)."""
    return rounded(money_sum(F.when(F.col(category_col) == F.lit(category), F.col(value_col)).otherwise(F.lit(0.0))))


def conditional_count_compat(category_col: str, category: str) -> Column:
    """``count(case when category = c then 1 else 0 end)``.

    Both branches are non-NULL, so this counts every row of the group; kept
    because published results were computed this way.
    """
    return F.count(F.when(F.col(category_col) == F.lit(category), F.lit(1)).otherwise(F.lit(0)))


def conditional_count(category_col: str, category: str) -> Column:
    """Rows whose category equals ``category``."""
    return F.count_if(F.col(category_col) == F.lit(category))


def distinct_list(value_col: str, sep: str = CARD_TYPES_SEPARATOR) -> Column:
    """Distinct non-NULL values joined to one string, sorted; '' when none.

    ``collect_set`` is bounded by the value domain (here card types), not by
    the group size, and combines map-side.
    """
    return F.coalesce(F.array_join(F.array_sort(F.collect_set(value_col)), sep), F.lit(""))


def agg_by_period(df: DataFrame, key: str, id_col: str, amount_col: str,
                  period_cols: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """Per (key, stored period) counts and rounded totals."""
    return df.groupBy(key, *period_cols).agg(
        F.count(id_col).alias("total_count"),
        rounded_total(amount_col).alias("total_amount"))
