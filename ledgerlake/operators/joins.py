"""Join operators.

Everything here is an equi-join planned by Catalyst.  Nothing is hinted:
AQE converts a join to a broadcast at run time when the measured side is
small, and splits skewed partitions of sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def join_chain(base: DataFrame, steps: Sequence[tuple[DataFrame, Column | str | list, str]]) -> DataFrame:
    """Apply joins in order: ``steps`` is a list of (right, condition, how)."""
    out = base
    for right, cond, how in steps:
        out = out.join(right, cond, how)
    return out


def left_join_hot_right(left: DataFrame, right: DataFrame, left_key: str,
                        right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` when one key may hold a
    large share of ``right``'s rows.

    AQE can split a skewed partition only on the preserved side of an outer
    join, so a hot key on the right would be processed by one task.  The same
    result is the union of

    * the inner join (AQE splits a skewed partition of either side), and
    * left rows without a match: an anti join against the right's distinct
      keys (partial aggregation collapses the hot key before the shuffle).

    NULL keys never match, as in the outer join.  Column names of the two
    sides must be distinct.
    """
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = (right.where(F.col(right_key).isNotNull())
            .select(F.col(right_key).alias("_right_key")).distinct())
    unmatched = left.join(keys, left[left_key] == keys["_right_key"], "left_anti")
    padding = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select(*left.columns, *padding))


def left_join_residual(left: DataFrame, right: DataFrame, key: str,
                       right_predicate: Column) -> DataFrame:
    """``left LEFT JOIN right ON key = key AND <predicate on right>``.

    A predicate on the right side in the ON clause filters right rows before
    matching, but keeps left rows without a match -- unlike the same term in
    WHERE.  Filtering the right side first is equivalent and lets the
    predicate reach the scan.
    """
    return left.join(right.where(right_predicate), key, "left")


def left_join_aggregated(left: DataFrame, aggregates: Sequence[DataFrame],
                         key: str | list[str]) -> DataFrame:
    """Left-join ``left`` to pre-aggregated subqueries, one after another.

    The aggregates are small relative to their inputs (partial aggregation
    runs before the shuffle); joins on the same key reuse one partitioning.
    """
    out = left
    for agg in aggregates:
        out = out.join(agg, key, "left")
    return out


# A key's rows are compared in this many parts before they meet.
KEY_PARTS = 16


def latest_rows(df: DataFrame, key: str, ts: str) -> DataFrame:
    """All rows whose ``ts`` equals the maximum ``ts`` of their key (ties kept).

    Same result as ``WHERE ts = (SELECT max(ts) ... WHERE key = outer.key)``:
    rows with a NULL key or NULL ts never qualify.  ``rank() = 1`` per (key,
    salt): Spark cuts every task's rows to the latest of each such group before
    the shuffle, and a hot key is spread over the salts.  What is left -- the
    latest rows of a few parts -- is compared with the key's maximum by a join,
    which AQE splits where one key has very many ties; both sides of it read
    one shuffle, so the rows are scanned once.
    """
    salted = (df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
              .withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(KEY_PARTS))))
    part = Window.partitionBy(key, "_salt").orderBy(F.desc(ts))
    few = salted.withColumn("_place", F.rank().over(part)).where("_place = 1").drop("_place", "_salt")
    # of all columns, so that this side reads the same shuffle as the rows do
    newest = few.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(F.col(ts).alias("ts"), F.xxhash64(*df.columns))).alias("_last"))
    newest = newest.select("_key", F.col("_last.ts").alias("_ts"))
    return few.join(newest, (few[key] == newest["_key"]) & (few[ts] == newest["_ts"]), "left_semi")


def latest_value(df: DataFrame, key: str, order_cols: Sequence[str], value: str,
                 alias: str | None = None) -> DataFrame:
    """One value per key from the row that is greatest by ``order_cols``.

    ``max(struct(order..., value))`` is an ordinary aggregate: partial
    aggregation keeps one candidate per key per task, so it is skew-safe and
    needs no window sort.  Rows whose first order column is NULL are ignored;
    NULLs in later columns sort lowest.
    """
    first = order_cols[0]
    packed = F.max(F.struct(*[F.col(c) for c in order_cols], F.col(value).alias("_v")))
    return (df.where(F.col(key).isNotNull() & F.col(first).isNotNull())
            .groupBy(key).agg(packed["_v"].alias(alias or value)))
