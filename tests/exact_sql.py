"""The exact marts in plain Spark SQL: test oracles on small fixtures."""

CUSTOMER_MASTER_EXACT = """
WITH totals AS (
    SELECT account_id,
           count_if(operation = 'Credit in Cash') AS total_in_cash_transaction,
           count_if(operation = 'Cash Withdrawal') AS total_withdrawal_transaction,
           cast(round(coalesce(sum(case when operation = 'Credit in Cash'
                then cast(cast(amount as string) as decimal(30,6)) end), 0), 2) as double) AS total_in_cash_credit,
           cast(round(coalesce(sum(case when operation = 'Cash Withdrawal'
                then cast(cast(amount as string) as decimal(30,6)) end), 0), 2) as double) AS total_withdrawal_credit
    FROM t_transaction WHERE account_id IS NOT NULL GROUP BY account_id),
lb AS (
    SELECT account_id, balance FROM (
        SELECT account_id, balance,
               row_number() OVER (PARTITION BY account_id ORDER BY fulldatewithtime DESC,
                   trans_id DESC NULLS LAST, amount DESC NULLS LAST, balance DESC NULLS LAST) AS rn
        FROM t_transaction WHERE account_id IS NOT NULL AND fulldatewithtime IS NOT NULL)
    WHERE rn = 1)
SELECT cus.client_id, cus.sex, cus.age, cus.phone, cus.email, cus.address_1, cus.city, cus.state,
       cus.zipcode, dpst.type, acc.account_id, acc.frequency, date(acc.parseddate) parseddate,
       per.total_in_cash_transaction, per.total_withdrawal_transaction,
       per.total_in_cash_credit, per.total_withdrawal_credit, per.balance
FROM t_client cus
LEFT JOIN t_disposition dpst ON cus.client_id = dpst.client_id
LEFT JOIN t_account acc ON dpst.account_id = acc.account_id
LEFT JOIN (SELECT totals.*, lb.balance FROM totals LEFT JOIN lb ON totals.account_id = lb.account_id) per
       ON acc.account_id = per.account_id
"""

ACCOUNT_SUMMARY_EXACT = """
SELECT acc.account_id, acc.district_id, acc.frequency, acc.parseddate, tx.transactions_type,
       COALESCE(tx.nt, 0) AS total_transactions, CAST(ROUND(tx.st, 2) AS DOUBLE) AS total_transaction_amount,
       COALESCE(od.n_orders, 0) AS total_orders, CAST(ROUND(od.so, 2) AS DOUBLE) AS total_order_amount,
       COALESCE(cd.nc, 0) AS total_cards, COALESCE(cd.types, '') AS card_types
FROM (SELECT DISTINCT account_id, district_id, frequency, parseddate FROM t_account) acc
LEFT JOIN (SELECT account_id, operation AS transactions_type, COUNT(trans_id) AS nt,
                  SUM(CAST(CAST(amount AS STRING) AS DECIMAL(30,6))) AS st
           FROM t_transaction
           WHERE operation IS NOT NULL AND operation != '' AND account_id IS NOT NULL
           GROUP BY account_id, operation) tx ON acc.account_id = tx.account_id
LEFT JOIN (SELECT account_id, COUNT(order_id) AS n_orders, SUM(CAST(CAST(amount AS STRING) AS DECIMAL(30,6))) AS so
           FROM t_order WHERE account_id IS NOT NULL GROUP BY account_id) od
       ON acc.account_id = od.account_id
LEFT JOIN (SELECT d.account_id, COUNT(c.card_id) AS nc,
                  array_join(array_sort(collect_set(c.type)), ', ') AS types
           FROM (SELECT DISTINCT account_id, disp_id FROM t_disposition
                 WHERE account_id IS NOT NULL) d
           LEFT JOIN t_card c ON d.disp_id = c.disp_id
           GROUP BY d.account_id) cd ON acc.account_id = cd.account_id
"""

CUSTOMER_SUMMARY_EXACT = """
SELECT cln.client_id, cln.age, cln.sex, cln.email, cln.phone, cln.address_1,
       acc.account_id, acc.frequency, dtrc.city branch,
       COALESCE(txn.total_transactions, 0) total_transactions,
       cast(COALESCE(txn.total_spent, 0) as double) total_spent,
       cast(COALESCE(l.total_loan_amount, 0) as double) total_loan_amount,
       COALESCE(l.total_loans, 0) total_loans,
       '{pdate}' AS pdate
FROM t_client cln
JOIN (SELECT DISTINCT client_id, account_id FROM t_disposition) d ON cln.client_id = d.client_id
JOIN t_account acc ON d.account_id = acc.account_id
JOIN t_district dtrc ON acc.district_id = dtrc.district_id
LEFT JOIN (
    SELECT account_id, ROUND(COALESCE(SUM(cast(cast(amount as string) as decimal(30,6))), 0), 2) AS total_spent,
           COUNT(trans_id) AS total_transactions
    FROM t_transaction
    WHERE fulldate >= DATE'{start}' AND fulldate < add_months(DATE'{start}', 1)
    GROUP BY account_id) txn ON d.account_id = txn.account_id
LEFT JOIN (
    SELECT account_id, ROUND(COALESCE(SUM(cast(cast(amount as string) as decimal(30,6))), 0), 2) AS total_loan_amount,
           COUNT(loan_id) AS total_loans
    FROM t_loan
    WHERE fulldate >= DATE'{start}' AND fulldate < add_months(DATE'{start}', 1)
    GROUP BY account_id) l ON d.account_id = l.account_id
"""
