"""The three customer marts, each in a compatible and an exact form.

Compatible forms reproduce the published results, defects included
(fan-out multiplication, counting every row as a "conditional count",
tied latest balances, month cross products).  They are computed without
materialising the fan-out: every branch is aggregated on its own first and
the multiplicities are applied arithmetically, so work is linear in the
inputs.  ``*_exact`` forms give the intended numbers.

Inputs are the transformed bank tables as DataFrames; column names follow
the bank model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import money_sum, nonempty, period_literal, rounded
from ledgerlake.operators.aggregates import distinct_list, total
from ledgerlake.operators.filters import filter_date_from, filter_month
from ledgerlake.operators.joins import left_join_hot_right, latest_value
from ledgerlake.schemas import CASH_WITHDRAWAL, CREDIT_IN_CASH

ACCOUNT_SUMMARY_COLUMNS = [
    "account_id", "district_id", "frequency", "parseddate", "transactions_type",
    "total_transactions", "total_transaction_amount", "total_orders",
    "total_order_amount", "total_cards", "card_types"]

CUSTOMER_MASTER_COLUMNS = [
    "client_id", "sex", "age", "phone", "email", "address_1", "city", "state",
    "zipcode", "type", "account_id", "frequency", "parseddate",
    "total_in_cash_transaction", "total_withdrawal_transaction",
    "total_in_cash_credit", "total_withdrawal_credit", "balance"]

CUSTOMER_SUMMARY_COLUMNS = [
    "client_id", "age", "sex", "email", "phone", "address_1", "account_id",
    "frequency", "branch", "total_transactions", "total_spent",
    "total_loan_amount", "total_loans", "pdate"]

ACCOUNT_KEYS = ["account_id", "district_id", "frequency", "parseddate"]


def _one_if_null(c: str):
    return F.coalesce(F.col(c), F.lit(1))


def _zero_if_null(c: str):
    return F.coalesce(F.col(c), F.lit(0))


# ---------------------------------------------------------------------------
# M1 account summary
# ---------------------------------------------------------------------------

def _card_branch(disposition: DataFrame, card: DataFrame, distinct_dispositions: bool) -> DataFrame:
    """Per account: rows of disposition LEFT JOIN card, non-NULL card ids, types.

    Cards are first reduced to one row per (disp_id, type), so a disposition
    with very many cards costs one row per card type, and the per-account
    aggregation combines map-side.
    """
    per_disp_type = (card.where(F.col("disp_id").isNotNull())
                     .groupBy("disp_id", "type")
                     .agg(F.count(F.lit(1)).alias("_card_rows"),
                          F.count("card_id").alias("_card_ids")))
    disp = disposition.where(F.col("account_id").isNotNull()).select("account_id", "disp_id")
    if distinct_dispositions:
        disp = disp.distinct()
    return (disp.join(per_disp_type, "disp_id", "left")
            .groupBy("account_id")
            .agg(F.sum(F.coalesce(F.col("_card_rows"), F.lit(1))).alias("rc"),
                 F.sum(F.coalesce(F.col("_card_ids"), F.lit(0))).alias("nc"),
                 distinct_list("type").alias("card_types")))


def _account_branches(account, transaction, order, disposition, card, distinct_dispositions):
    # Partial aggregation first, so duplicated account rows under one hot key
    # collapse map-side; the re-shuffle by account_id for the joins below
    # then moves aggregated rows only.
    acc = account.groupBy(*ACCOUNT_KEYS).agg(F.count(F.lit(1)).alias("ra"))
    txn = (transaction.where(nonempty("operation") & F.col("account_id").isNotNull())
           .groupBy("account_id", "operation")
           .agg(F.count(F.lit(1)).alias("rt"), F.count("trans_id").alias("nt"),
                money_sum("amount").alias("st"))
           .withColumnRenamed("operation", "transactions_type"))
    orders = (order.where(F.col("account_id").isNotNull()).groupBy("account_id")
              .agg(F.count(F.lit(1)).alias("ro"), F.count("order_id").alias("no"),
                   money_sum("amount").alias("so")))
    cards = _card_branch(disposition, card, distinct_dispositions)
    return (acc.join(txn, "account_id", "left")
            .join(orders, "account_id", "left")
            .join(cards, "account_id", "left"))


def account_summary(account: DataFrame, transaction: DataFrame, order: DataFrame,
                    disposition: DataFrame, card: DataFrame) -> DataFrame:
    """Account summary as published: the measures of each branch multiplied by
    the row counts of the other branches (the fan-out of four left joins),
    computed from per-branch aggregates."""
    j = _account_branches(account, transaction, order, disposition, card, False)
    ra = F.col("ra")
    f_rt, f_ro, f_rc = _one_if_null("rt"), _one_if_null("ro"), _one_if_null("rc")
    return j.select(
        *ACCOUNT_KEYS, "transactions_type",
        (_zero_if_null("nt") * ra * f_ro * f_rc).alias("total_transactions"),
        rounded(F.col("st") * (ra * f_ro * f_rc)).alias("total_transaction_amount"),
        (_zero_if_null("no") * ra * f_rt * f_rc).alias("total_orders"),
        rounded(F.col("so") * (ra * f_rt * f_rc)).alias("total_order_amount"),
        (_zero_if_null("nc") * ra * f_rt * f_ro).alias("total_cards"),
        F.coalesce(F.col("card_types"), F.lit("")).alias("card_types"))


def account_summary_exact(account: DataFrame, transaction: DataFrame, order: DataFrame,
                          disposition: DataFrame, card: DataFrame) -> DataFrame:
    """Per-branch counts and sums, not multiplied by other branches.

    One row per (account, operation); the order and card measures are
    account-level and repeat on each operation row (do not sum them over
    operations)."""
    j = _account_branches(account, transaction, order, disposition, card, True)
    return j.select(
        *ACCOUNT_KEYS, "transactions_type",
        _zero_if_null("nt").alias("total_transactions"),
        rounded("st").alias("total_transaction_amount"),
        _zero_if_null("no").alias("total_orders"),
        rounded("so").alias("total_order_amount"),
        _zero_if_null("nc").alias("total_cards"),
        F.coalesce(F.col("card_types"), F.lit("")).alias("card_types"))


# ---------------------------------------------------------------------------
# M2 customer master
# ---------------------------------------------------------------------------

def _client_account_chain(client: DataFrame, disposition: DataFrame, account: DataFrame) -> DataFrame:
    cus = client.select("client_id", "sex", "age", "phone", "email", "address_1",
                        "city", "state", "zipcode")
    dpst = disposition.select(F.col("client_id").alias("_d_client"),
                              F.col("account_id").alias("_d_account"), "type")
    acc = account.select("account_id", "frequency",
                         F.to_date("parseddate").alias("parseddate"))
    # A client may hold a large share of dispositions: skew-safe left join.
    # After it, a hot account sits on the preserved (left) side, which AQE
    # can split, and the account side is one row per account.
    return (left_join_hot_right(cus, dpst, "client_id", "_d_client")
            .join(acc, F.col("_d_account") == acc.account_id, "left")
            .drop("_d_client", "_d_account"))


def customer_master(client: DataFrame, disposition: DataFrame, account: DataFrame,
                    transaction: DataFrame) -> DataFrame:
    """Customer master as published.

    * both "conditional" counts equal all non-empty-operation rows;
    * the latest balance is taken over all rows of the account, ignoring the
      operation filter, and every row tied on the latest timestamp counts:
      equal balances multiply the totals, different balances give one output
      row each;
    * accounts whose timestamps are all NULL, or without non-empty
      operations, get no aggregates (NULL, no default).

    One pass over ``transaction``: (account, timestamp, balance) with counts
    and sums, combined map-side.  From it the totals and the latest timestamp
    of every account, and the rows of that timestamp by a join on (account,
    timestamp), so a hot account is spread by its timestamps.  No row's list
    is ever built.
    """
    ne = nonempty("operation")

    def of(category):
        return money_sum(F.when(ne, F.when(F.col("operation") == F.lit(category), F.col("amount")).otherwise(F.lit(0.0))))
    per_balance = (transaction.where(F.col("account_id").isNotNull())
                   .groupBy("account_id", "fulldatewithtime", "balance")
                   .agg(F.count(F.lit(1)).alias("_m"), F.count_if(ne).alias("_n"),
                        of(CREDIT_IN_CASH).alias("_s_in"), of(CASH_WITHDRAWAL).alias("_s_out")))
    totals = (per_balance.groupBy(F.col("account_id").alias("_account"))
              .agg(F.max("fulldatewithtime").alias("_latest"), F.sum("_m").alias("_rows"),
                   *[F.sum(c).alias(c) for c in ("_n", "_s_in", "_s_out")])
              .where("_rows >= _n and _n > 0 and _latest is not null"))
    # True of every row, as above: with the same columns and filters both sides
    # read one shuffle (a plain equality would filter this side's timestamps).
    ties = (per_balance.where("_m >= _n and (_n > 0 or coalesce(_s_in, _s_out) is null)")
            .select("account_id", "fulldatewithtime", "balance", "_m"))
    per_account = ties.join(totals, (F.col("account_id") == F.col("_account")) & F.col("fulldatewithtime").eqNullSafe(F.col("_latest")))
    m = F.col("_m")
    txn_aggregates = (per_account
                      .select(F.col("account_id").alias("_t_account"),
                              (F.col("_n") * m).alias("total_in_cash_transaction"),
                              (F.col("_n") * m).alias("total_withdrawal_transaction"),
                              rounded(F.col("_s_in") * m).alias("total_in_cash_credit"),
                              rounded(F.col("_s_out") * m).alias("total_withdrawal_credit"),
                              "balance"))
    chain = _client_account_chain(client, disposition, account)
    return (chain.join(txn_aggregates, chain.account_id == txn_aggregates._t_account, "left")
            .select(*CUSTOMER_MASTER_COLUMNS))


def customer_master_exact(client: DataFrame, disposition: DataFrame, account: DataFrame,
                          transaction: DataFrame) -> DataFrame:
    """Counts by category, totals by category, and exactly one latest balance
    per account (latest timestamp, then highest trans_id, amount, balance)."""
    tx = transaction.where(F.col("account_id").isNotNull())
    totals = tx.groupBy("account_id").agg(
        F.count_if(F.col("operation") == F.lit(CREDIT_IN_CASH)).alias("total_in_cash_transaction"),
        F.count_if(F.col("operation") == F.lit(CASH_WITHDRAWAL)).alias("total_withdrawal_transaction"),
        rounded(F.coalesce(money_sum(F.when(F.col("operation") == F.lit(CREDIT_IN_CASH), F.col("amount"))),
                           F.lit(0))).alias("total_in_cash_credit"),
        rounded(F.coalesce(money_sum(F.when(F.col("operation") == F.lit(CASH_WITHDRAWAL), F.col("amount"))),
                           F.lit(0))).alias("total_withdrawal_credit"))
    balance = latest_value(tx, "account_id",
                           ["fulldatewithtime", "trans_id", "amount", "balance"], "balance")
    per_account = (totals.join(balance, "account_id", "left")
                   .withColumnRenamed("account_id", "_t_account"))
    chain = _client_account_chain(client, disposition, account)
    return (chain.join(per_account, chain.account_id == per_account._t_account, "left")
            .select(*CUSTOMER_MASTER_COLUMNS))


# ---------------------------------------------------------------------------
# M3 customer period summary
# ---------------------------------------------------------------------------

def _summary_base(client, disposition, account, district, distinct_dispositions):
    cln = client.select("client_id", "age", "sex", "email", "phone", "address_1")
    d = disposition.select(F.col("client_id").alias("_d_client"),
                           F.col("account_id").alias("_d_account"))
    if distinct_dispositions:
        d = d.distinct()
    acc = account.select("account_id", "frequency", F.col("district_id").alias("_a_district"))
    # a small dimension: joined by broadcast where its measured size allows it
    dist = district.select(F.col("district_id").alias("_dt_district"), F.col("city").alias("branch"))
    return (cln.join(d, cln.client_id == d._d_client)
            .join(acc, F.col("_d_account") == acc.account_id)
            .join(dist, F.col("_a_district") == F.col("_dt_district")))


def _summary_select(j: DataFrame, pdate: str) -> DataFrame:
    return j.select(
        "client_id", "age", "sex", "email", "phone", "address_1", "account_id", "frequency",
        "branch",
        F.coalesce(F.col("_txn_count"), F.lit(0)).cast("bigint").alias("total_transactions"),
        F.coalesce(F.col("_txn_spent"), F.lit(0)).alias("total_spent"),
        F.coalesce(F.col("_loan_amount"), F.lit(0)).alias("total_loan_amount"),
        F.coalesce(F.col("_loan_count"), F.lit(0)).cast("bigint").alias("total_loans"),
        F.lit(pdate).alias("pdate"))


def customer_summary(client: DataFrame, disposition: DataFrame, account: DataFrame,
                     district: DataFrame, transaction: DataFrame, loan: DataFrame,
                     year: int, month: int, period_cols: tuple[str, str] | None = None) -> DataFrame:
    """Customer summary as published for a start month.

    Transactions and loans dated on or after the start are aggregated per
    (account, year, month) but joined on the account alone, so an account
    yields (transaction months x loan months) rows, all labelled with the
    start period, and "spent" sums every amount, credits included.
    ``period_cols`` enables partition pruning on a (year, month) layout.
    """
    pdate = period_literal(year, month)
    txn = (filter_date_from(transaction, year, month, "fulldate", period_cols)
           .groupBy("account_id", "year", "month")
           .agg(total(transaction, "amount").alias("_txn_spent"),
                F.count("trans_id").alias("_txn_count"))
           .select(F.col("account_id").alias("_t_account"), "_txn_spent", "_txn_count"))
    loans = (filter_date_from(loan, year, month, "fulldate", period_cols)
             .groupBy("account_id", "year", "month")
             .agg(total(loan, "amount").alias("_loan_amount"),
                  F.count("loan_id").alias("_loan_count"))
             .select(F.col("account_id").alias("_l_account"), "_loan_amount", "_loan_count"))
    base = _summary_base(client, disposition, account, district, False)
    j = (base.join(txn, F.col("_d_account") == F.col("_t_account"), "left")
         .join(loans, F.col("_d_account") == F.col("_l_account"), "left"))
    return _summary_select(j, pdate)


def customer_summary_exact(client: DataFrame, disposition: DataFrame, account: DataFrame,
                           district: DataFrame, transaction: DataFrame, loan: DataFrame,
                           year: int, month: int,
                           period_cols: tuple[str, str] | None = None) -> DataFrame:
    """One row per (client, account) for exactly the requested month:
    transactions and loans of ``[start, start + 1 month)``, dispositions made
    distinct on (client, account) first."""
    pdate = period_literal(year, month)
    txn = (filter_month(transaction, year, month, "fulldate", period_cols)
           .groupBy("account_id")
           .agg(total(transaction, "amount").alias("_txn_spent"),
                F.count("trans_id").alias("_txn_count"))
           .withColumnRenamed("account_id", "_t_account"))
    loans = (filter_month(loan, year, month, "fulldate", period_cols)
             .groupBy("account_id")
             .agg(total(loan, "amount").alias("_loan_amount"),
                  F.count("loan_id").alias("_loan_count"))
             .withColumnRenamed("account_id", "_l_account"))
    base = _summary_base(client, disposition, account, district, True)
    j = (base.join(txn, F.col("_d_account") == F.col("_t_account"), "left")
         .join(loans, F.col("_d_account") == F.col("_l_account"), "left"))
    return _summary_select(j, pdate)
