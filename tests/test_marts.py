"""Golden fixtures for the marts: NULLs, ties, empty strings, orphans,
fan-out, exact decimals -- compat forms against the published join forms,
exact forms against hand-computed values."""

import pytest
from pyspark.sql import functions as F

import nested_loops
from helpers import TS, D, bank_df, equals_dicts, rows
from ledgerlake.operators import aggregates as agg
from ledgerlake.plans import marts

CIC, CW = "Credit in Cash", "Cash Withdrawal"


def acc(aid, district, day=D(2017, 12, 30), freq="monthly"):
    return {"account_id": aid, "district_id": district, "frequency": freq, "parseddate": day,
            "year": day.year, "month": day.month, "day": day.day}


def txn(tid, aid, op, amount, balance, ts):
    return {"trans_id": tid, "account_id": aid, "operation": op, "amount": amount,
            "balance": balance, "fulldatewithtime": ts,
            "fulldate": ts.date() if ts else None,
            "year": ts.year if ts else None, "month": ts.month if ts else None,
            "day": ts.day if ts else None}


@pytest.fixture(scope="module")
def bank(spark):
    t = {}
    t["district"] = bank_df(spark, "district", [{"district_id": 1, "city": "Prague"},
                                                {"district_id": 2, "city": "Brno"}])
    t["account"] = bank_df(spark, "account", [
        acc("A1", 1), acc("A2", 2), acc("A2", 2),          # A2 listed twice
        acc("A3", 99),                                      # no such district
        acc(None, 1),                                       # NULL key
        acc("A5", 1)])                                      # no transactions
    t["disposition"] = bank_df(spark, "disposition", [
        {"disp_id": "D1", "client_id": "C1", "account_id": "A1", "type": "OWNER"},
        {"disp_id": "D2", "client_id": "C2", "account_id": "A1", "type": "USER"},
        {"disp_id": "D3", "client_id": "C3", "account_id": "A2", "type": "OWNER"},
        {"disp_id": "D4", "client_id": "C4", "account_id": "A9", "type": "OWNER"},
        {"disp_id": "D5", "client_id": "C1", "account_id": "A3", "type": "OWNER"},
        {"disp_id": "D6", "client_id": "C5", "account_id": "A5", "type": "OWNER"}])
    t["client"] = bank_df(spark, "client", [
        {"client_id": c, "sex": "F", "age": 30 + i, "city": "Prague"}
        for i, c in enumerate(["C1", "C2", "C3", "C4", "C5", "C6"])])
    t["card"] = bank_df(spark, "card", [
        {"card_id": "K1", "disp_id": "D1", "type": "gold"},
        {"card_id": "K2", "disp_id": "D1", "type": "classic"},
        {"card_id": "K3", "disp_id": "D2", "type": None},
        {"card_id": "K4", "disp_id": "D3", "type": "junior"},
        {"card_id": None, "disp_id": "D3", "type": "gold"}])
    t["transaction"] = bank_df(spark, "transaction", [
        txn("T1", "A1", CIC, 0.1, 100.0, TS(2018, 1, 5, 10)),
        txn("T2", "A1", CIC, 0.2, 100.1, TS(2018, 1, 6, 10)),
        txn("T3", "A1", CW, 50.25, 60.0, TS(2018, 2, 1, 9)),
        txn("T4", "A1", "", 10.0, 60.0, TS(2018, 2, 1, 9)),     # tie, equal balance, empty op
        txn("T5", "A1", None, 5.0, 55.0, TS(2018, 1, 7)),
        txn("T6", "A2", CW, 20.0, 80.0, TS(2018, 3, 1)),
        txn("T7", "A2", CIC, 30.0, 110.0, TS(2018, 3, 1)),      # tie, different balance
        txn(None, "A2", CIC, 1.5, 90.0, TS(2018, 2, 15)),       # NULL id
        txn("T9", "A3", CIC, 7.0, 7.0, None),                   # NULL timestamp only
        txn("T10", None, CIC, 9.0, 9.0, TS(2018, 1, 1))])       # NULL account
    t["order"] = bank_df(spark, "order", [
        {"order_id": 1, "account_id": "A1", "amount": 100.5},
        {"order_id": 2, "account_id": "A1", "amount": 3.0},
        {"order_id": 3, "account_id": "A2", "amount": None},
        {"order_id": 4, "account_id": None, "amount": 1.0}])
    t["loan"] = bank_df(spark, "loan", [
        {"loan_id": "L1", "account_id": "A1", "amount": 1000, "fulldate": D(2018, 1, 10),
         "year": 2018, "month": 1, "day": 10},
        {"loan_id": "L2", "account_id": "A1", "amount": 2000, "fulldate": D(2018, 2, 10),
         "year": 2018, "month": 2, "day": 10}])
    for name, df in t.items():
        df.createOrReplaceTempView(f"t_{name}")
    return t


def _as_args(b):
    return b["account"], b["transaction"], b["order"], b["disposition"], b["card"]


def test_account_summary_equals_join_form(spark, bank):
    fast = marts.account_summary(*_as_args(bank))
    assert equals_dicts(fast, nested_loops.account_summary(nested_loops.load(bank)))


def test_account_summary_exact_values(bank):
    out = marts.account_summary_exact(*_as_args(bank)).where(F.col("account_id") == "A1")
    got = {r["transactions_type"]: r for r in out.collect()}
    assert set(got) == {CIC, CW}
    assert got[CIC]["total_transactions"] == 2
    assert got[CIC]["total_transaction_amount"] == 0.3          # 0.1 + 0.2 exactly
    assert got[CW]["total_transaction_amount"] == 50.25
    for r in got.values():
        assert (r["total_orders"], r["total_order_amount"]) == (2, 103.5)
        assert r["total_cards"] == 3
        assert r["card_types"] == "classic, gold"


def test_account_summary_compat_multiplies(bank):
    out = marts.account_summary(*_as_args(bank))
    a1 = {r["transactions_type"]: r for r in out.where(F.col("account_id") == "A1").collect()}
    # 2 orders x 3 disposition/card rows multiply the transaction measures.
    assert a1[CIC]["total_transactions"] == 2 * 2 * 3
    assert a1[CIC]["total_orders"] == 2 * 2 * 3
    assert a1[CIC]["total_cards"] == 3 * 2 * 2
    a2 = out.where(F.col("account_id") == "A2").collect()
    # A2 is listed twice (ra=2); its Credit-in-Cash group has two rows (rt=2).
    got = {r["transactions_type"]: r["total_cards"] for r in a2}
    assert got == {CW: 1 * 2 * 1, CIC: 1 * 2 * 2}
    none = out.where(F.col("account_id") == "A5").collect()
    assert len(none) == 1 and none[0]["transactions_type"] is None
    assert none[0]["total_transactions"] == 0 and none[0]["total_transaction_amount"] is None
    assert none[0]["card_types"] == ""


def _master_args(b):
    return b["client"], b["disposition"], b["account"], b["transaction"]


def test_customer_master_equals_join_form(spark, bank):
    assert equals_dicts(marts.customer_master(*_master_args(bank)), nested_loops.customer_master(nested_loops.load(bank)))


def test_customer_master_compat_ties(bank):
    out = marts.customer_master(*_master_args(bank))
    a1 = out.where((F.col("account_id") == "A1") & (F.col("client_id") == "C1")).collect()
    assert len(a1) == 1                       # equal tied balances: one row, doubled totals
    assert a1[0]["total_in_cash_transaction"] == 3 * 2
    assert a1[0]["total_in_cash_credit"] == 0.6
    assert a1[0]["total_withdrawal_credit"] == 100.5
    assert a1[0]["balance"] == 60.0           # from the empty-operation row as well
    a2 = out.where(F.col("account_id") == "A2").collect()
    # different tied balances: one row each (x2: A2 is listed twice)
    assert sorted(r["balance"] for r in a2) == [80.0, 80.0, 110.0, 110.0]
    a3 = out.where(F.col("account_id") == "A3").collect()
    assert [r["total_in_cash_transaction"] for r in a3] == [None]   # NULL timestamps only
    c6 = out.where(F.col("client_id") == "C6").collect()
    assert len(c6) == 1 and c6[0]["account_id"] is None            # client without disposition


def test_customer_master_exact(bank):
    out = marts.customer_master_exact(*_master_args(bank))
    a1 = out.where((F.col("account_id") == "A1") & (F.col("client_id") == "C1")).first()
    assert (a1["total_in_cash_transaction"], a1["total_withdrawal_transaction"]) == (2, 1)
    assert (a1["total_in_cash_credit"], a1["total_withdrawal_credit"]) == (0.3, 50.25)
    assert a1["balance"] == 60.0
    a2 = out.where(F.col("account_id") == "A2").collect()
    assert [r["balance"] for r in a2] == [110.0, 110.0]   # tie broken by trans_id (T7 > T6)
    a3 = out.where(F.col("account_id") == "A3").first()
    assert a3["total_in_cash_transaction"] == 1 and a3["balance"] is None


def _summary_args(b):
    return (b["client"], b["disposition"], b["account"], b["district"], b["transaction"],
            b["loan"])


def test_customer_summary_equals_join_form(spark, bank):
    fast = marts.customer_summary(*_summary_args(bank), 2018, 1)
    assert equals_dicts(fast, nested_loops.customer_summary(nested_loops.load(bank), D(2018, 1, 1)))


def test_customer_summary_month_cross_product_vs_exact(bank):
    compat = marts.customer_summary(*_summary_args(bank), 2018, 1)
    a1 = compat.where((F.col("account_id") == "A1") & (F.col("client_id") == "C1"))
    assert a1.count() == 4                       # 2 transaction months x 2 loan months
    exact = marts.customer_summary_exact(*_summary_args(bank), 2018, 1)
    e1 = exact.where((F.col("account_id") == "A1") & (F.col("client_id") == "C1")).collect()
    assert len(e1) == 1
    assert (e1[0]["total_transactions"], e1[0]["total_spent"]) == (3, 5.3)
    assert (e1[0]["total_loans"], e1[0]["total_loan_amount"]) == (1, 1000.0)
    assert e1[0]["pdate"] == "201801"
    # A3 has no district: inner chain drops it; C6 has no disposition.
    assert exact.where(F.col("account_id") == "A3").count() == 0
    assert exact.where(F.col("client_id") == "C6").count() == 0


def test_customer_summary_rejects_bad_month(bank):
    with pytest.raises(ValueError):
        marts.customer_summary(*_summary_args(bank), 2018, 13)


def test_conditional_count_compat_counts_every_row(spark):
    df = spark.createDataFrame([("a", x) for x in ["X", "X", "X", "Y", "Y", "Z"]], "k string, c string")
    r = df.groupBy("k").agg(agg.conditional_count_compat("c", "X").alias("compat"),
                            agg.conditional_count("c", "X").alias("exact")).first()
    assert (r["compat"], r["exact"]) == (6, 3)


def test_distinct_list_skips_nulls_and_sorts(spark):
    df = spark.createDataFrame([("a", "gold"), ("a", None), ("a", "classic"), ("a", "gold"),
                                ("b", None)], "k string, t string")
    got = dict(rows(df.groupBy("k").agg(agg.distinct_list("t").alias("l"))))
    assert got == {"a": "classic, gold", "b": ""}


def test_money_is_rounded_once_after_the_sum(spark):
    df = spark.createDataFrame([("a", 1.005), ("b", 0.004), ("b", 0.004), ("b", 0.004), ("c", float("nan")),
                                ("c", float("inf")), ("c", 2.0), ("d", None)], "k string, amount double")
    got = dict(rows(df.groupBy("k").agg(agg.rounded_total("amount").alias("t"))))
    assert got == {"a": 1.01, "b": 0.01, "c": 2.0, "d": 0.0}


def test_long_loan_totals_stay_long(spark, bank):
    big = 2 ** 53 + 1
    loan = bank["loan"].withColumn("amount", F.lit(big).cast("long")).where(F.col("loan_id") == "L1")
    out = marts.customer_summary(bank["client"], bank["disposition"], bank["account"], bank["district"], bank["transaction"],
                                 loan, 2018, 1)
    assert out.schema["total_loan_amount"].dataType.simpleString() == "bigint"
    assert big in {r.total_loan_amount for r in out.collect()}
