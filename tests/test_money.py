"""Exact sums on the fast path, values out of range, latest rows of hot keys."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import exact_decimal, money, money_sum, rounded
from ledgerlake.operators.joins import latest_rows
from ledgerlake.operators.mapping import apply_mapping, reject_counts
from ledgerlake.schemas import mapping_for


def six(x: float) -> Decimal:
    return Decimal(repr(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP)


def one_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(money_sum("v").alias("s")).first().s


def test_sums_equal_decimal_arithmetic(spark):
    rng = random.Random(4)
    values = [round(rng.uniform(-1e6, 1e6), rng.choice([0, 1, 2, 6])) for _ in range(2000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(2000)]
    values += [1.005, 0.004, 0.004, 0.004, 5e-7, -5e-7, 1.5e-6, -1.5e-6, 999999999.999999, 1e9, -1e9, 0.1 + 0.2, -0.0, 0.0]
    assert one_sum(spark, values) == sum(map(six, values))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.m for r in df.select(money("v").alias("m")).collect()] == [six(v) for v in values]


def test_what_is_no_amount_does_not_count_and_does_not_end_the_query(spark):
    odd = [1e15, -1e24, 1e300, float("nan"), float("inf"), float("-inf")]
    assert one_sum(spark, [1.25, *odd, 2.5]) == Decimal("3.75")
    assert one_sum(spark, odd) is None and one_sum(spark, [None, 0.0]) == 0
    df = spark.createDataFrame([(v,) for v in odd], "v double")
    assert all(r.m is None for r in df.select(money("v").alias("m")).collect())
    assert df.select(exact_decimal("v").alias("d")).where("d is not null").count() == 1    # 10^15 has its place


def test_very_many_large_amounts_do_not_overflow(spark):
    df = spark.range(2_000_000).select(F.lit(999_999_999.99).alias("v"))
    assert df.agg(money_sum("v").alias("s")).first().s == Decimal("999999999.99") * 2_000_000
    near = spark.range(1000).select(F.lit(9.99e14).alias("v"))
    assert near.agg(rounded(money_sum("v")).alias("s")).first().s == 9.99e17


def test_values_out_of_range_are_counted_rejects(spark):
    raw = spark.createDataFrame([("T1", "1e24", "5"), ("T2", "1e300", "NaN"), ("T3", "12.5", "x"), ("T4", None, "7")],
                                "trans_id string, amount string, balance string")
    seen = Observation()
    got = apply_mapping(raw, mapping_for("transaction"), seen).select("amount", "balance").collect()
    assert [tuple(r) for r in got] == [(None, 5.0), (None, None), (12.5, None), (None, 7.0)]
    counts = reject_counts(seen)
    assert (counts["amount"], counts["balance"]) == (2, 2)


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("null_key", [False, True])
def test_latest_rows_of_hot_keys(spark, null_key):
    """A third of the rows shares one key without a time, a third one moment."""
    rows = ([("hot", None, i) for i in range(400)] + [("hot", 7, i) for i in range(400)] + [("hot", 3, i) for i in range(400)]
            + [(f"k{i % 40}", i % 9, i) for i in range(400)] + [(None if null_key else "x", 100, 1)] * 3)
    df = spark.createDataFrame(rows, "k string, ts int, v int").repartition(5)
    best = {}
    for k, ts, _ in rows:
        if k is not None and ts is not None:
            best[k] = max(best.get(k, ts), ts)
    out = latest_rows(df, "k", "ts")
    assert sorted(map(tuple, out.collect())) == sorted(r for r in rows if r[0] is not None and r[1] is not None and best[r[0]] == r[1])
    plan = _final(out)
    assert "collect_list" not in plan and "WindowGroupLimit" in plan


def test_no_list_of_rows_is_built(spark):
    from ledgerlake.catalog.queries import QUERIES
    for name in ("customer_master", "latest_by_key", "self_join_latest"):
        plan = _final(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "collect_list" not in plan, name
