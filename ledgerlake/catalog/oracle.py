"""DuckDB oracle SQL for every registered query.

The bank tables are inlined as CTEs over the driver tables (same binding as
``ledgerlake.sources.binding``).  Money is summed as an exact decimal through
its text, rounded once and cast to double, so results compare bit-equal.
"""

from __future__ import annotations

# Start month used by the period queries.
START_YEAR, START_MONTH = 1998, 1

BINDING = """
bclient AS (
  SELECT c_custkey AS client_id, CAST(NULL AS VARCHAR) AS sex, CAST(NULL AS DATE) AS fulldate,
         CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS month, CAST(NULL AS INTEGER) AS year,
         CAST(NULL AS INTEGER) AS age, CAST(NULL AS VARCHAR) AS social, c_name AS first,
         CAST(NULL AS VARCHAR) AS middle, CAST(NULL AS VARCHAR) AS last, CAST(NULL AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS address_1,
         CAST(NULL AS VARCHAR) AS address_2, CAST(NULL AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state, CAST(NULL AS BIGINT) AS zipcode,
         CAST(c_nationkey AS BIGINT) AS district_id
  FROM customer),
bdistrict AS (
  SELECT CAST(n_nationkey AS BIGINT) AS district_id, n_name AS city,
         CAST(NULL AS VARCHAR) AS state_name, CAST(NULL AS VARCHAR) AS state_abbrev,
         CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS division
  FROM nation),
baccount AS (
  SELECT account_id, district_id, frequency, parseddate,
         CAST(year(parseddate) AS INTEGER) AS year, CAST(month(parseddate) AS INTEGER) AS month,
         CAST(day(parseddate) AS INTEGER) AS day
  FROM (SELECT o_orderkey AS account_id, CAST(c_nationkey AS BIGINT) AS district_id,
               o_orderpriority AS frequency, CAST(o_orderdate AS DATE) AS parseddate
        FROM orders JOIN customer ON o_custkey = c_custkey)),
bdisposition AS (
  SELECT o_orderkey AS disp_id, o_custkey AS client_id, o_orderkey AS account_id,
         o_orderstatus AS type
  FROM orders),
btxn AS (
  SELECT trans_id, account_id, type, operation, amount, balance, k_symbol, bank, account,
         CAST(year(fulldate) AS INTEGER) AS year, CAST(month(fulldate) AS INTEGER) AS month,
         CAST(day(fulldate) AS INTEGER) AS day, fulldate, fulltime, fulldatewithtime
  FROM (SELECT l_orderkey * 10 + l_linenumber AS trans_id, l_orderkey AS account_id,
               CAST(NULL AS VARCHAR) AS type,
               CASE l_returnflag WHEN 'A' THEN 'Credit in Cash' WHEN 'R' THEN 'Cash Withdrawal'
                    ELSE '' END AS operation,
               l_extendedprice AS amount, l_quantity AS balance,
               CAST(NULL AS VARCHAR) AS k_symbol, CAST(NULL AS VARCHAR) AS bank,
               CAST(NULL AS VARCHAR) AS account, CAST(l_shipdate AS DATE) AS fulldate,
               CAST(NULL AS VARCHAR) AS fulltime, l_shipdate AS fulldatewithtime
        FROM lineitem)),
bloan AS (
  SELECT loan_id, account_id, amount, duration, payments, status,
         CAST(year(fulldate) AS INTEGER) AS year, CAST(month(fulldate) AS INTEGER) AS month,
         CAST(day(fulldate) AS INTEGER) AS day, fulldate, location, purpose
  FROM (SELECT event_id AS loan_id, user_id AS account_id, value AS amount,
               CAST(NULL AS BIGINT) AS duration, CAST(NULL AS BIGINT) AS payments,
               CAST(NULL AS VARCHAR) AS status, CAST(ts AS DATE) AS fulldate,
               CAST(NULL AS BIGINT) AS location, CAST(NULL AS VARCHAR) AS purpose
        FROM events WHERE event_type = 'signup')),
border AS (
  SELECT event_id AS order_id, user_id AS account_id, CAST(NULL AS VARCHAR) AS bank_to,
         CAST(NULL AS BIGINT) AS account_to, value AS amount, CAST(NULL AS VARCHAR) AS k_symbol
  FROM events WHERE event_type = 'purchase'),
bcard AS (
  SELECT p_partkey AS card_id, CAST(floor(p_partkey / 2) AS BIGINT) AS disp_id, p_type AS type,
         CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS month,
         CAST(NULL AS INTEGER) AS year, CAST(NULL AS DATE) AS fulldate
  FROM part)
"""


def with_binding(body: str, extra_ctes: str = "") -> str:
    ctes = BINDING.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


START = f"DATE '{START_YEAR:04d}-{START_MONTH:02d}-01'"
PDATE = f"'{START_YEAR:04d}{START_MONTH:02d}'"
NEXT = f"DATE '{START_YEAR + (START_MONTH == 12):04d}-{START_MONTH % 12 + 1:02d}-01'"
NEXT_PDATE = f"'{START_YEAR + (START_MONTH == 12):04d}{START_MONTH % 12 + 1:02d}'"

ORACLE: dict[str, str] = {}

MONEY = "CAST(CAST({0} AS VARCHAR) AS DECIMAL(30,6))"
MONEY_SUM = f"ROUND(SUM({MONEY}), 2)"
ROUNDED = f"ROUND(COALESCE(SUM({MONEY}), 0), 2)"

# ---------------------------------------------------------------------------
# staging: typed bank table -> text -> declared mapping, as Spark does it
# ---------------------------------------------------------------------------

_DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "long": "BIGINT", "int": "INTEGER",
               "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP"}

_STAGE_SOURCES = {
    "account": "baccount", "card": "bcard", "client": "bclient", "disposition": "bdisposition",
    "district": "bdistrict", "loan": "bloan", "order": "border", "transaction": "btxn",
    "loan_portfolio": "(SELECT loan_id, amount AS funded_amount, fulldate AS funded_date FROM bloan)",
}

# What the binding of a table provides; the other columns of its mapping are NULL text.
_BOUND_PORTFOLIO = {"loan_id", "funded_amount", "funded_date"}


def _spark_like_cast(text: str, target: str) -> str:
    """DuckDB form of Spark's try_cast from text (integers take integer text only)."""
    duck = _DUCK_TYPES[target]
    if target == "string":
        return text
    if duck in ("BIGINT", "INTEGER"):
        return (f"TRY_CAST(CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') "
                f"THEN trim({text}) END AS {duck})")
    return f"TRY_CAST({text} AS {duck})"


def stage_sql(table: str) -> str:
    from ledgerlake.schemas import MAPPINGS
    have = _BOUND_PORTFOLIO if table == "loan_portfolio" else {dst for _, _, dst, _ in MAPPINGS[table]}
    cols = []
    for _src, _st, dst, dt in MAPPINGS[table]:
        text = f'CAST(s."{dst}" AS VARCHAR)' if dst in have else "CAST(NULL AS VARCHAR)"
        cols.append(f'{_spark_like_cast(text, dt)} AS "{dst}"')
    return with_binding(f"SELECT {', '.join(cols)} FROM {_STAGE_SOURCES[table]} s")


for _t in _STAGE_SOURCES:
    ORACLE[f"stage_{_t}"] = stage_sql(_t)

ORACLE["apply_mapping"] = stage_sql("transaction")
ORACLE["stage_full_refresh"] = stage_sql("transaction")
ORACLE["stream_ingest_landing"] = stage_sql("account")
ORACLE["stream_publish_stage"] = stage_sql("account")
ORACLE["stream_ingest_publish"] = stage_sql("account")
ORACLE["stream_ingest_mixed_headers"] = stage_sql("account")

# ---------------------------------------------------------------------------
# scans and publishing (sinks return their read-back)
# ---------------------------------------------------------------------------

ORACLE["scan_table"] = with_binding("SELECT * FROM btxn")
ORACLE["scan_partitioned_parquet"] = with_binding("SELECT * FROM btxn")
ORACLE["scan_csv_by_name"] = with_binding("""
SELECT CAST(card_id AS VARCHAR) AS card_id, CAST(disp_id AS VARCHAR) AS disp_id, type,
       CAST(day AS VARCHAR) AS day, CAST(month AS VARCHAR) AS month, CAST(year AS VARCHAR) AS year,
       CAST(fulldate AS VARCHAR) AS fulldate
FROM bcard""")
ORACLE["publish_rebuild_monthly"] = with_binding("SELECT * FROM baccount")
ORACLE["publish_catalog_table"] = with_binding("SELECT * FROM baccount")
ORACLE["publish_rebuild_daily"] = with_binding("SELECT * FROM btxn")
ORACLE["publish_refresh_period"] = with_binding("SELECT * FROM baccount")
ORACLE["publish_append"] = with_binding("""
SELECT * FROM baccount WHERE parseddate < (SELECT d FROM lastd)
UNION ALL
SELECT * FROM baccount, lastd WHERE year = year(d) AND month = month(d)
UNION ALL
SELECT * FROM baccount, lastd WHERE year = year(d) AND month = month(d)
""".replace("SELECT * FROM baccount, lastd", "SELECT baccount.* FROM baccount, lastd"),
    "lastd AS (SELECT max(parseddate) AS d FROM baccount)")
ORACLE["publish_snapshot"] = with_binding("SELECT * FROM border")
ORACLE["publish_schema_evolution"] = with_binding("""
SELECT account_id, district_id,
       CASE WHEN year = year(d) AND month = month(d) THEN frequency END AS frequency,
       parseddate, year, month, day
FROM baccount, lastd""", "lastd AS (SELECT max(parseddate) AS d FROM baccount)")
ORACLE["period_scope"] = with_binding("SELECT DISTINCT year, month, day FROM btxn")

# ---------------------------------------------------------------------------
# marts
# ---------------------------------------------------------------------------

# A row of the published summary repeats every branch as often as the other
# branches have rows: multiplicities instead of the four-way join.
_TIMES = "CAST({0} AS DECIMAL(9,0))"
ACCOUNT_SUMMARY = with_binding(f"""
SELECT ac.account_id, ac.district_id, ac.frequency, ac.parseddate, tx.operation AS transactions_type,
       CAST(COALESCE(tx.ids, 0) * copies * o_rows * c_rows AS BIGINT) AS total_transactions,
       CAST(ROUND(CAST(tx.amount AS DECIMAL(24,6)) * {_TIMES.format('copies * o_rows * c_rows')}, 2) AS DOUBLE)
           AS total_transaction_amount,
       CAST(COALESCE(od.ids, 0) * copies * t_rows * c_rows AS BIGINT) AS total_orders,
       CAST(ROUND(CAST(od.amount AS DECIMAL(24,6)) * {_TIMES.format('copies * t_rows * c_rows')}, 2) AS DOUBLE)
           AS total_order_amount,
       CAST(COALESCE(dc.ids, 0) * copies * t_rows * o_rows AS BIGINT) AS total_cards,
       COALESCE(dc.kinds, '') AS card_types
FROM ac LEFT JOIN tx USING (account_id) LEFT JOIN od USING (account_id) LEFT JOIN dc USING (account_id),
     LATERAL (SELECT COALESCE(tx.n, 1) AS t_rows, COALESCE(od.n, 1) AS o_rows, COALESCE(dc.n, 1) AS c_rows)
""", f"""
ac AS (SELECT account_id, district_id, frequency, parseddate, count(*) AS copies FROM baccount GROUP BY ALL),
tx AS (SELECT account_id, operation, count(*) AS n, count(trans_id) AS ids, sum({MONEY.format('amount')}) AS amount
       FROM btxn WHERE operation <> '' GROUP BY ALL),
od AS (SELECT account_id, count(*) AS n, count(order_id) AS ids, sum({MONEY.format('amount')}) AS amount
       FROM border GROUP BY ALL),
dc AS (SELECT d.account_id, count(*) AS n, count(card_id) AS ids, string_agg(DISTINCT c.type, ', ' ORDER BY c.type) AS kinds
       FROM bdisposition d LEFT JOIN bcard c USING (disp_id) GROUP BY ALL)""")
ORACLE["account_summary"] = ACCOUNT_SUMMARY
ORACLE["write_mart"] = ACCOUNT_SUMMARY

ORACLE["account_summary_exact"] = with_binding(f"""
SELECT acc.account_id, acc.district_id, acc.frequency, acc.parseddate,
       tx.transactions_type,
       COALESCE(tx.nt, 0) AS total_transactions,
       CAST(tx.st AS DOUBLE) AS total_transaction_amount,
       COALESCE(od.n_orders, 0) AS total_orders,
       CAST(od.so AS DOUBLE) AS total_order_amount,
       COALESCE(cd.nc, 0) AS total_cards,
       COALESCE(cd.types, '') AS card_types
FROM (SELECT DISTINCT account_id, district_id, frequency, parseddate FROM baccount) acc
LEFT JOIN (SELECT account_id, operation AS transactions_type, COUNT(trans_id) AS nt,
                  {MONEY_SUM.format('amount')} AS st
           FROM btxn WHERE operation IS NOT NULL AND operation != '' AND account_id IS NOT NULL
           GROUP BY account_id, operation) tx ON acc.account_id = tx.account_id
LEFT JOIN (SELECT account_id, COUNT(order_id) AS n_orders, {MONEY_SUM.format('amount')} AS so
           FROM border WHERE account_id IS NOT NULL GROUP BY account_id) od
       ON acc.account_id = od.account_id
LEFT JOIN (SELECT d.account_id, COUNT(c.card_id) AS nc,
                  string_agg(DISTINCT c.type, ', ' ORDER BY c.type) AS types
           FROM (SELECT DISTINCT account_id, disp_id FROM bdisposition
                 WHERE account_id IS NOT NULL) d
           LEFT JOIN bcard c ON d.disp_id = c.disp_id
           GROUP BY d.account_id) cd ON acc.account_id = cd.account_id
""")

# Balances of the rows that share the first rank by time, with how often each occurs.
TIED = """tied AS (
    SELECT account_id, balance, count(*) AS times
    FROM (SELECT account_id, balance, rank() OVER (PARTITION BY account_id ORDER BY fulldatewithtime DESC) AS place
          FROM {0} WHERE account_id IS NOT NULL AND fulldatewithtime IS NOT NULL)
    WHERE place = 1 GROUP BY ALL)"""


def _master_sql(txn: str) -> str:
    amount = MONEY.format("amount")
    per_account = f"""{TIED.format(txn)},
worked AS (
    SELECT account_id, count(*) AS n, sum({amount}) FILTER (operation = 'Credit in Cash') AS cash_in,
           sum({amount}) FILTER (operation = 'Cash Withdrawal') AS cash_out
    FROM {txn} WHERE operation <> '' AND account_id IS NOT NULL GROUP BY ALL),
figures AS (
    SELECT account_id, balance, n * times AS entries_in, n * times AS entries_out,
           CAST(ROUND(CAST(COALESCE(cash_in, 0) AS DECIMAL(24,6)) * {_TIMES.format('times')}, 2) AS DOUBLE) AS paid_in,
           CAST(ROUND(CAST(COALESCE(cash_out, 0) AS DECIMAL(24,6)) * {_TIMES.format('times')}, 2) AS DOUBLE) AS paid_out
    FROM worked JOIN tied USING (account_id))"""
    return per_account


# Every client with its accounts and what ``figures`` says of them.
_OF_CLIENTS = """
SELECT c.client_id, c.sex, c.age, c.phone, c.email, c.address_1, c.city, c.state, c.zipcode, d.type,
       a.account_id, a.frequency, CAST(a.parseddate AS DATE) AS parseddate,
       f.entries_in AS total_in_cash_transaction, f.entries_out AS total_withdrawal_transaction,
       f.paid_in AS total_in_cash_credit, f.paid_out AS total_withdrawal_credit, f.balance
FROM bclient c LEFT JOIN (bdisposition d LEFT JOIN (baccount a LEFT JOIN figures f USING (account_id))
                          ON a.account_id = d.account_id) ON d.client_id = c.client_id"""
ORACLE["customer_master"] = with_binding(_OF_CLIENTS, _master_sql("btxn"))

# One balance an account: of the row that sorts last by time, number, amount and balance.
_KINDS = {"in": "Credit in Cash", "out": "Cash Withdrawal"}
ORACLE["customer_master_exact"] = with_binding(_OF_CLIENTS, f"""
last_balance AS (
    SELECT DISTINCT ON (account_id) account_id, balance FROM btxn
    WHERE account_id IS NOT NULL AND fulldatewithtime IS NOT NULL
    ORDER BY account_id, fulldatewithtime DESC, trans_id DESC NULLS LAST, amount DESC NULLS LAST, balance DESC NULLS LAST),
figures AS (
    SELECT account_id, last_balance.balance AS balance, """ + ", ".join(
    f"count(*) FILTER (operation = '{kind}') AS entries_{k}, "
    f"CAST(ROUND(COALESCE(sum({MONEY.format('amount')}) FILTER (operation = '{kind}'), 0), 2) AS DOUBLE) AS paid_{k}"
    for k, kind in _KINDS.items()) + """
    FROM btxn LEFT JOIN last_balance USING (account_id) WHERE account_id IS NOT NULL GROUP BY account_id, last_balance.balance)""")


def _summary_sql(txn_where: str, loan_where: str, per: str, holders: str, pdate: str, txn: str = "btxn") -> str:
    def money_and_rows(table, key, where):
        return f"""(SELECT account_id, {ROUNDED.format('amount')} AS amount, count({key}) AS entries
              FROM {table} WHERE {where} GROUP BY account_id{per})"""
    return f"""
SELECT h.client_id, age, sex, email, phone, address_1, h.account_id, frequency, dt.city AS branch,
       CAST(COALESCE(spent.entries, 0) AS BIGINT) AS total_transactions,
       CAST(COALESCE(spent.amount, 0) AS DOUBLE) AS total_spent,
       CAST(COALESCE(lent.amount, 0) AS DOUBLE) AS total_loan_amount,
       CAST(COALESCE(lent.entries, 0) AS BIGINT) AS total_loans, {pdate} AS pdate
FROM {holders} h JOIN baccount USING (account_id) JOIN bdistrict dt USING (district_id)
     JOIN (SELECT client_id, age, sex, email, phone, address_1 FROM bclient) person ON person.client_id = h.client_id
     LEFT JOIN {money_and_rows(txn, 'trans_id', txn_where)} spent ON spent.account_id = h.account_id
     LEFT JOIN {money_and_rows('bloan', 'loan_id', loan_where)} lent ON lent.account_id = h.account_id
"""


_FROM_START = (f"fulldate >= {START}", f"fulldate >= {START}", ", year, month", "bdisposition", PDATE)
ORACLE["customer_summary"] = with_binding(_summary_sql(*_FROM_START))


def _exact_month(start: str, pdate: str) -> str:
    bounded = f"fulldate >= {start} AND fulldate < {start} + INTERVAL 1 MONTH"
    return _summary_sql(bounded, bounded, "",
                        "(SELECT DISTINCT client_id, account_id FROM bdisposition)", pdate)


ORACLE["customer_summary_exact"] = with_binding(_exact_month(START, PDATE))

# The published layout with rows whose stored date parts disagree with the date
# (see queries._odd_transactions): the jobs' results are those without pruning.
_ODD = """
oddtxn AS (
  SELECT * FROM btxn
  UNION ALL BY NAME
  SELECT * REPLACE (-trans_id AS trans_id, CAST(NULL AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month) FROM btxn WHERE trans_id % 10 = 1
  UNION ALL BY NAME
  SELECT * REPLACE (-trans_id AS trans_id, CAST(year - 1 AS INTEGER) AS year, CAST(12 AS INTEGER) AS month) FROM btxn WHERE trans_id % 10 = 2
  UNION ALL BY NAME
  SELECT * REPLACE (-trans_id AS trans_id, CAST(2 AS INTEGER) AS month, CAST(31 AS INTEGER) AS day) FROM btxn WHERE trans_id % 10 = 3)"""
ORACLE["customer_master_published"] = with_binding(_OF_CLIENTS, _ODD + ",\n" + _master_sql("oddtxn"))
ORACLE["publish_evolving_pruned"] = with_binding(f"""
SELECT trans_id, account_id, fulldate, amount, year, month FROM oddtxn WHERE fulldate >= {START}""", _ODD)
ORACLE["customer_summary_published"] = with_binding(_summary_sql(*_FROM_START, txn="oddtxn"), _ODD)

_ITEMS = """SELECT client_id, age, sex, email, phone, address_1, account_id, frequency, branch,
       total_transactions, CAST(total_spent AS DECIMAL(18,2)) AS total_spent,
       CAST(total_loan_amount AS DECIMAL(18,2)) AS total_loan_amount, total_loans, pdate
FROM ({0})"""
ORACLE["export_customer_summary_upsert"] = with_binding(
    _ITEMS.format(_exact_month(START, PDATE)) + "\nUNION ALL\n"
    + _ITEMS.format(_exact_month(NEXT, NEXT_PDATE)))
ORACLE["export_store_items"] = ORACLE["export_customer_summary_upsert"]
ORACLE["stage_job_landing"] = ORACLE["stage_card"]

# ---------------------------------------------------------------------------
# filters, projections, joins
# ---------------------------------------------------------------------------

ORACLE["filter_nonempty"] = with_binding("""
SELECT trans_id, account_id, operation, amount FROM btxn
WHERE operation IS NOT NULL AND operation != ''""")
ORACLE["filter_date_from"] = with_binding(f"""
SELECT trans_id, account_id, fulldate, amount, year, month FROM btxn WHERE fulldate >= {START}""")
ORACLE["with_period_column"] = with_binding(
    f"SELECT account_id, frequency, {PDATE} AS pdate FROM baccount")
ORACLE["inner_join_chain"] = with_binding("""
SELECT c.client_id, a.account_id, a.frequency, dt.city AS branch, d.type
FROM bclient c JOIN bdisposition d ON c.client_id = d.client_id
JOIN baccount a ON d.account_id = a.account_id
JOIN bdistrict dt ON a.district_id = dt.district_id""")
ORACLE["left_join_chain"] = with_binding("""
SELECT c.client_id, d.type, a.account_id, a.frequency, a.parseddate
FROM bclient c LEFT JOIN bdisposition d ON c.client_id = d.client_id
LEFT JOIN baccount a ON d.account_id = a.account_id""")
ORACLE["left_join_residual"] = with_binding("""
SELECT a.account_id, t.trans_id, t.operation, t.amount
FROM baccount a LEFT JOIN btxn t ON a.account_id = t.account_id
     AND (t.operation IS NOT NULL AND t.operation != '')""")
ORACLE["left_join_aggregated"] = with_binding(f"""
SELECT a.account_id,
       CAST(COALESCE(t.total_transactions, 0) AS BIGINT) AS total_transactions,
       CAST(COALESCE(t.total_spent, 0) AS DOUBLE) AS total_spent,
       CAST(COALESCE(l.total_loan_amount, 0) AS DOUBLE) AS total_loan_amount,
       CAST(COALESCE(l.total_loans, 0) AS BIGINT) AS total_loans
FROM baccount a
LEFT JOIN (SELECT account_id, {ROUNDED.format('amount')} AS total_spent,
                  COUNT(trans_id) AS total_transactions
           FROM btxn WHERE fulldate >= {START} GROUP BY account_id, year, month) t
       ON a.account_id = t.account_id
LEFT JOIN (SELECT account_id, {ROUNDED.format('amount')} AS total_loan_amount,
                  COUNT(loan_id) AS total_loans
           FROM bloan WHERE fulldate >= {START} GROUP BY account_id, year, month) l
       ON a.account_id = l.account_id""")
ORACLE["latest_by_key"] = with_binding("""
SELECT account_id, trans_id, balance, fulldatewithtime FROM btxn
WHERE account_id IS NOT NULL AND fulldatewithtime IS NOT NULL
QUALIFY rank() OVER (PARTITION BY account_id ORDER BY fulldatewithtime DESC) = 1""")
ORACLE["self_join_latest"] = with_binding("""
SELECT account_id, balance, CAST(n * times AS BIGINT) AS joined_rows
FROM tied JOIN (SELECT account_id, count(*) AS n FROM btxn WHERE operation <> '' GROUP BY ALL) USING (account_id)
""", TIED.format("btxn"))

# ---------------------------------------------------------------------------
# aggregates and scalar functions
# ---------------------------------------------------------------------------

ORACLE["agg_count_sum"] = with_binding(f"""
SELECT account_id, COUNT(trans_id) AS total_transactions,
       CAST({MONEY_SUM.format('amount')} AS DOUBLE) AS total_transaction_amount
FROM btxn GROUP BY account_id""")
ORACLE["agg_rounded_total"] = with_binding(f"""
SELECT account_id, CAST({ROUNDED.format('amount')} AS DOUBLE) AS total_loan_amount,
       COUNT(loan_id) AS total_loans
FROM bloan GROUP BY account_id""")
ORACLE["agg_conditional_sum"] = with_binding("""
SELECT account_id,
       CAST(SUM(CASE WHEN operation = 'Credit in Cash' THEN CAST(CAST(amount AS VARCHAR) AS DECIMAL(30,6))
                ELSE 0 END) AS DOUBLE) AS total_in_cash_credit,
       CAST(SUM(CASE WHEN operation = 'Cash Withdrawal' THEN CAST(CAST(amount AS VARCHAR) AS DECIMAL(30,6))
                ELSE 0 END) AS DOUBLE) AS total_withdrawal_credit
FROM btxn GROUP BY account_id""")
ORACLE["agg_conditional_count_compat"] = with_binding("""
SELECT account_id,
       COUNT(CASE WHEN operation = 'Credit in Cash' THEN 1 ELSE 0 END) AS total_in_cash_transaction,
       COUNT(CASE WHEN operation = 'Cash Withdrawal' THEN 1 ELSE 0 END) AS total_withdrawal_transaction
FROM btxn GROUP BY account_id""")
ORACLE["agg_conditional_count"] = with_binding("""
SELECT account_id,
       COUNT(*) FILTER (WHERE operation = 'Credit in Cash') AS total_in_cash_transaction,
       COUNT(*) FILTER (WHERE operation = 'Cash Withdrawal') AS total_withdrawal_transaction
FROM btxn GROUP BY account_id""")
ORACLE["agg_distinct_list"] = with_binding("""
SELECT d.account_id, COALESCE(string_agg(DISTINCT c.type, ', ' ORDER BY c.type), '') AS card_types
FROM bdisposition d LEFT JOIN bcard c ON d.disp_id = c.disp_id
WHERE d.account_id IS NOT NULL
GROUP BY d.account_id""")
ORACLE["agg_by_period"] = with_binding(f"""
SELECT account_id, year, month, COUNT(trans_id) AS total_count,
       CAST({ROUNDED.format('amount')} AS DOUBLE) AS total_amount
FROM btxn GROUP BY account_id, year, month""")
ORACLE["fn_date"] = with_binding(
    "SELECT trans_id, CAST(fulldatewithtime AS DATE) AS txn_date FROM btxn")
ORACLE["fn_coalesce_default"] = with_binding(f"""
SELECT a.account_id, COALESCE(o.n, 0) AS total_orders,
       CAST(COALESCE(o.s, 0) AS DOUBLE) AS total_order_amount
FROM baccount a LEFT JOIN (SELECT account_id, COUNT(order_id) AS n,
                                  {MONEY_SUM.format('amount')} AS s
                           FROM border GROUP BY account_id) o ON a.account_id = o.account_id""")
ORACLE["fn_period_key"] = with_binding("""
SELECT trans_id, account_id, CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') AS pkey
FROM btxn""")
ORACLE["fn_exact_decimal"] = with_binding(f"""
SELECT account_id, CAST({ROUNDED.format('amount')} AS DECIMAL(18,2)) AS total_spent
FROM btxn GROUP BY account_id""")

# ---------------------------------------------------------------------------
# landing keys
# ---------------------------------------------------------------------------

_RAW_JOBS = ", ".join(f"'{t}'" for t in ("account", "card", "client", "disposition", "district",
                                          "loan", "loan_portfolio", "order", "transaction"))
_DAILY_JOBS = ", ".join(f"'{t}'" for t in ("account", "card", "client", "disposition", "district",
                                            "loan", "order", "transaction"))
ORACLE["landing_route"] = f"""
WITH k AS (
  SELECT CASE event_type
           WHEN 'signup' THEN 'raw_data/loan/' || CAST(event_id AS VARCHAR) || '.csv'
           WHEN 'purchase' THEN 'stage_data/order/part-' || CAST(event_id AS VARCHAR) || '.parquet'
           WHEN 'click' THEN 'stage_data/loan_portfolio/' || CAST(event_id AS VARCHAR) || '+v1.csv'
           WHEN 'view' THEN 'raw_data%2Ftransaction%2F' || CAST(event_id AS VARCHAR) || '%zz.csv'
           ELSE 'other/' || CAST(event_id AS VARCHAR) || '.csv' END AS key
  FROM events),
d AS (SELECT key, url_decode(replace(key, '+', ' ')) AS decoded_key FROM k),
p AS (SELECT key, decoded_key, string_split(decoded_key, '/') AS parts FROM d),
r AS (
  SELECT key, decoded_key, parts[1] AS layer,
         len(parts) > 2 AND parts[1] IN ('raw_data', 'stage_data') AS accepted, parts
  FROM p),
a AS (
  SELECT key, decoded_key, layer, accepted,
         CASE WHEN accepted THEN parts[2] END AS table_name,
         CASE WHEN accepted AND layer = 'raw_data' THEN 'stage'
              WHEN accepted AND layer = 'stage_data' THEN 'publish_daily' END AS action
  FROM r)
SELECT key, decoded_key, layer, table_name, action, accepted,
       CASE WHEN action = 'stage' THEN table_name IN ({_RAW_JOBS})
            WHEN action = 'publish_daily' THEN table_name IN ({_DAILY_JOBS})
            ELSE false END AS job_exists
FROM a
"""
