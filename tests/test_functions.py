"""Scalar functions: exact money, period keys, key decoding."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import (decode_object_key, exact_decimal, money,
                                          money_sum, period_key, period_literal, rounded)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**11, 10**11), min_size=1, max_size=40))
def test_money_is_exact_for_two_decimals(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "amount double")
    r = df.agg(money_sum("amount").alias("s"), rounded(money_sum("amount")).alias("d")).first()
    assert r["s"] == Decimal(sum(cents)) / 100
    assert r["d"] == float(Decimal(sum(cents)) / 100)
    assert [x["c"] for x in df.select(money("amount").alias("c")).collect()] == [Decimal(c) / 100 for c in cents] + [None]


def test_period_and_decimal_helpers(spark):
    df = spark.createDataFrame([(2018, 3, 0.3), (1999, 12, None)], "year int, month int, v double")
    got = df.select(period_key().alias("p"), exact_decimal("v").alias("d")).collect()
    assert [r["p"] for r in got] == ["201803", "199912"]
    assert got[0]["d"] == Decimal("0.30") and got[1]["d"] is None
    assert period_literal(2018, 3) == "201803"


def test_decode_object_key(spark):
    keys = ["raw_data/a+b/c.csv", "raw_data%2Fx%2Fy.csv", "bad%zz", "end%", "%E2%82%AC"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(decode_object_key("k")).collect()]
    assert got == ["raw_data/a b/c.csv", "raw_data/x/y.csv", "bad%zz", "end%", "€"]
