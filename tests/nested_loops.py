"""The published marts by nested loops over collected rows: the tests' oracle.

Every table is a list of dicts; sums are exact decimals, rounded half up once.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from itertools import product


def load(tables: dict) -> dict[str, list[dict]]:
    return {name: [r.asDict() for r in df.collect()] for name, df in tables.items()}


def amount(values) -> float | None:
    values = [v for v in values if v is not None]
    if values and all(isinstance(v, int) for v in values):
        return sum(values)
    known = [Decimal(str(v)) for v in values]
    return float(sum(known).quantize(Decimal("0.01"), ROUND_HALF_UP)) if known else None


def partners(rows: list[dict], key: str, value) -> list[dict]:
    return [r for r in rows if value is not None and r[key] == value]


def account_summary(t: dict[str, list[dict]]) -> list[dict]:
    held: dict[tuple, list] = {}
    for a in t["account"]:
        worked = [x for x in partners(t["transaction"], "account_id", a["account_id"]) if x["operation"]]
        orders = partners(t["order"], "account_id", a["account_id"])
        cards = []
        for d in partners(t["disposition"], "account_id", a["account_id"]):
            cards += partners(t["card"], "disp_id", d["disp_id"]) or [{}]
        for x, o, c in product(worked or [{}], orders or [{}], cards or [{}]):
            key = (a["account_id"], a["district_id"], a["frequency"], a["parseddate"], x.get("operation"))
            held.setdefault(key, []).append((x, o, c))
    out = []
    for key, seen in held.items():
        names = ("account_id", "district_id", "frequency", "parseddate", "transactions_type")
        xs, os, cs = zip(*seen)
        out.append(dict(zip(names, key)) | {
            "total_transactions": sum(x.get("trans_id") is not None for x in xs),
            "total_transaction_amount": amount(x.get("amount") for x in xs),
            "total_orders": sum(o.get("order_id") is not None for o in os),
            "total_order_amount": amount(o.get("amount") for o in os),
            "total_cards": sum(c.get("card_id") is not None for c in cs),
            "card_types": ", ".join(sorted({c["type"] for c in cs if c.get("type") is not None}))})
    return out


def _figures(transactions: list[dict], account) -> list[dict]:
    mine = partners(transactions, "account_id", account)
    times = [x["fulldatewithtime"] for x in mine if x["fulldatewithtime"] is not None]
    last = [x["balance"] for x in mine if times and x["fulldatewithtime"] == max(times)]
    worked = [x for x in mine if x["operation"]]
    out = []
    for balance in set(last):
        rows = [x for x in worked for other in last if other == balance]
        if rows:
            out.append({"rows": len(rows), "balance": balance,
                        "in": amount([0] + [x["amount"] for x in rows if x["operation"] == "Credit in Cash"]),
                        "out": amount([0] + [x["amount"] for x in rows if x["operation"] == "Cash Withdrawal"])})
    return out


def customer_master(t: dict[str, list[dict]]) -> list[dict]:
    out = []
    for c in t["client"]:
        for d in partners(t["disposition"], "client_id", c["client_id"]) or [{}]:
            for a in partners(t["account"], "account_id", d.get("account_id")) or [{}]:
                for f in _figures(t["transaction"], a.get("account_id")) or [{}]:
                    row = {k: c[k] for k in ("client_id", "sex", "age", "phone", "email", "address_1", "city", "state", "zipcode")}
                    row |= {"type": d.get("type")} | {k: a.get(k) for k in ("account_id", "frequency", "parseddate")}
                    out.append(row | {"total_in_cash_transaction": f.get("rows"), "total_withdrawal_transaction": f.get("rows"),
                                      "total_in_cash_credit": f.get("in"), "total_withdrawal_credit": f.get("out"),
                                      "balance": f.get("balance")})
    return out


def _months(rows: list[dict], account, key: str, start) -> list[tuple]:
    held: dict[tuple, list] = {}
    for r in partners(rows, "account_id", account):
        if r["fulldate"] is not None and r["fulldate"] >= start:
            held.setdefault((r["year"], r["month"]), []).append(r)
    return [(amount([0] + [r["amount"] for r in m]), sum(r[key] is not None for r in m)) for m in held.values()]


def customer_summary(t: dict[str, list[dict]], start) -> list[dict]:
    out = []
    for c in t["client"]:
        for d in partners(t["disposition"], "client_id", c["client_id"]):
            for a in partners(t["account"], "account_id", d["account_id"]):
                for place in partners(t["district"], "district_id", a["district_id"]):
                    spent = _months(t["transaction"], a["account_id"], "trans_id", start) or [(0.0, 0)]
                    lent = _months(t["loan"], a["account_id"], "loan_id", start) or [(0.0, 0)]
                    for (money, n), (loan, k) in product(spent, lent):
                        row = {x: c[x] for x in ("client_id", "age", "sex", "email", "phone", "address_1")}
                        out.append(row | {"account_id": a["account_id"], "frequency": a["frequency"], "branch": place["city"],
                                          "total_transactions": n, "total_spent": money, "total_loan_amount": loan,
                                          "total_loans": k, "pdate": f"{start:%Y%m}"})
    return out
