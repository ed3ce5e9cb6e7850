"""Property test: the linear rewrites equal the published join-then-aggregate
forms on random tables with duplicate keys, NULLs, empty operations and
timestamp ties."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import bank_df, equals_dicts, same_rows
from ledgerlake.plans import marts
import nested_loops
from exact_sql import ACCOUNT_SUMMARY_EXACT, CUSTOMER_MASTER_EXACT, CUSTOMER_SUMMARY_EXACT

ACCOUNTS = st.sampled_from(["A1", "A2", "A3", None])
OPS = st.sampled_from(["Credit in Cash", "Cash Withdrawal", "", None])
AMOUNT = st.one_of(st.none(), st.integers(-500, 50000).map(lambda c: c / 100))
TSS = st.one_of(st.none(), st.sampled_from([dt.datetime(2018, 1, 1, 9), dt.datetime(2018, 1, 20),
                                            dt.datetime(2018, 2, 3)]))

tables = st.fixed_dictionaries({
    "account": st.lists(st.tuples(ACCOUNTS, st.sampled_from([1, 2])), max_size=5),
    "transaction": st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["T1", "T2", "T3"])),
                                      ACCOUNTS, OPS, AMOUNT, st.sampled_from([1.0, 2.0, None]), TSS),
                            max_size=10),
    "order": st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 3)), ACCOUNTS, AMOUNT), max_size=4),
    "disposition": st.lists(st.tuples(st.sampled_from(["D1", "D2", None]),
                                      st.sampled_from(["C1", "C2"]), ACCOUNTS), max_size=4),
    "card": st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["K1", "K2"])),
                               st.sampled_from(["D1", "D2", None]),
                               st.sampled_from(["gold", "classic", None])), max_size=4),
    "loan": st.lists(st.tuples(st.sampled_from(["L1", "L2"]), ACCOUNTS, st.integers(0, 900),
                               st.sampled_from([dt.date(2017, 12, 5), dt.date(2018, 1, 5),
                                                dt.date(2018, 2, 5)])), max_size=4),
})


def _build(spark, t):
    d = dt.date(2017, 12, 30)
    b = {
        "account": bank_df(spark, "account", [
            {"account_id": a, "district_id": dist, "frequency": "m", "parseddate": d,
             "year": d.year, "month": d.month, "day": d.day} for a, dist in t["account"]]),
        "transaction": bank_df(spark, "transaction", [
            {"trans_id": i, "account_id": a, "operation": op, "amount": amt, "balance": bal,
             "fulldatewithtime": ts, "fulldate": ts.date() if ts else None,
             "year": ts.year if ts else None, "month": ts.month if ts else None}
            for i, a, op, amt, bal, ts in t["transaction"]]),
        "order": bank_df(spark, "order", [{"order_id": i, "account_id": a, "amount": amt}
                                          for i, a, amt in t["order"]]),
        "disposition": bank_df(spark, "disposition", [
            {"disp_id": i, "client_id": c, "account_id": a, "type": "OWNER"}
            for i, c, a in t["disposition"]]),
        "card": bank_df(spark, "card", [{"card_id": i, "disp_id": dsp, "type": ty}
                                        for i, dsp, ty in t["card"]]),
        "client": bank_df(spark, "client", [{"client_id": c} for c in ["C1", "C2", "C3"]]),
        "district": bank_df(spark, "district", [{"district_id": 1, "city": "X"}]),
        "loan": bank_df(spark, "loan", [
            {"loan_id": i, "account_id": a, "amount": amt, "fulldate": ld, "year": ld.year,
             "month": ld.month} for i, a, amt, ld in t["loan"]]),
    }
    for name, df in b.items():
        df.createOrReplaceTempView(f"t_{name}")
    return b


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(t=tables)
def test_rewrites_equal_join_forms(spark, t):
    b = _build(spark, t)
    fast = marts.account_summary(b["account"], b["transaction"], b["order"], b["disposition"], b["card"])
    plain = nested_loops.load(b)
    assert equals_dicts(fast, nested_loops.account_summary(plain))
    exact_as = marts.account_summary_exact(b["account"], b["transaction"], b["order"],
                                           b["disposition"], b["card"])
    assert same_rows(exact_as, spark.sql(ACCOUNT_SUMMARY_EXACT))
    master = marts.customer_master(b["client"], b["disposition"], b["account"], b["transaction"])
    assert equals_dicts(master, nested_loops.customer_master(plain))
    exact = marts.customer_master_exact(b["client"], b["disposition"], b["account"], b["transaction"])
    assert same_rows(exact, spark.sql(CUSTOMER_MASTER_EXACT))
    summary = marts.customer_summary(b["client"], b["disposition"], b["account"], b["district"],
                                     b["transaction"], b["loan"], 2018, 1)
    assert equals_dicts(summary, nested_loops.customer_summary(plain, dt.date(2018, 1, 1)))
    summary_exact = marts.customer_summary_exact(b["client"], b["disposition"], b["account"],
                                                 b["district"], b["transaction"], b["loan"], 2018, 1)
    assert same_rows(summary_exact,
                     spark.sql(CUSTOMER_SUMMARY_EXACT.format(pdate="201801", start="2018-01-01")))
