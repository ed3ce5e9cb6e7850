"""Registry of every query: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the bank tables from the driver tables of ``sf_dir``
(see ``ledgerlake.sources.binding``) and runs one operator or composite job over
the whole tables.  Sink queries write below the shared work folder (a new
folder per call) and return the read-back of what they wrote.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.catalog.oracle import START_MONTH, START_YEAR
from ledgerlake.functions.scalars import (coalesce_default, exact_decimal, money_sum, rounded,
                                          nonempty, period_key, period_literal, to_day)
from ledgerlake.operators import aggregates as agg
from ledgerlake.operators import export, publish, zones
from ledgerlake.operators.filters import filter_date_from, filter_nonempty
from ledgerlake.operators.joins import (join_chain, latest_rows, left_join_aggregated,
                                        left_join_hot_right, left_join_residual)
from ledgerlake.operators.mapping import apply_mapping, to_raw_strings
from ledgerlake.operators.store import FolderStore, export_to_store
from ledgerlake.plans import jobs, marts
from ledgerlake.plans.staging import stage_table
from ledgerlake.schemas import CASH_WITHDRAWAL, CREDIT_IN_CASH, PARTITIONS, mapping_for
from ledgerlake.session import fresh_dir
from ledgerlake.sources.binding import bank_tables, register_bank_views
from ledgerlake.sources.csv_landing import scan_csv_by_name
from ledgerlake.sources.tables import scan_partitioned_parquet, scan_table
from ledgerlake.streaming.ingest import ingest_landing, publish_on_stage_change, read_ingested
from ledgerlake.streaming.routing import landing_route

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# The period queries run for this month and, for the export, the next one.
NEXT_YEAR, NEXT_MONTH = (START_YEAR, START_MONTH + 1) if START_MONTH < 12 else (START_YEAR + 1, 1)


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


# ---------------------------------------------------------------------------
# raw inputs derived from the driver tables
# ---------------------------------------------------------------------------

def raw_table(b: dict[str, DataFrame], table: str) -> DataFrame:
    """Landing (all-text) form of a bank table."""
    if table == "loan_portfolio":
        src = b["loan"].select(F.col("loan_id"), F.col("amount").alias("funded_amount"),
                               F.col("fulldate").alias("funded_date"))
    else:
        src = b[table]
    return to_raw_strings(src, mapping_for(table))


def _stage(spark, sf_dir, table):
    b = bank_tables(spark, sf_dir)
    return stage_table(spark, raw_table(b, table), table, fresh_dir(spark, f"stage-{table}"))


for _t in ("account", "card", "client", "disposition", "district", "loan", "loan_portfolio",
           "order", "transaction"):
    QUERIES[f"stage_{_t}"] = (lambda t: lambda spark, sf_dir: _stage(spark, sf_dir, t))(_t)


# ---------------------------------------------------------------------------
# scans
# ---------------------------------------------------------------------------

@query("scan_table")
def q_scan_table(spark, sf_dir):
    register_bank_views(spark, sf_dir, prefix="bank_")
    return scan_table(spark, "bank_transaction")


def _published_transactions(spark, sf_dir, partition_cols=("year", "month")) -> tuple[str, DataFrame]:
    b = bank_tables(spark, sf_dir)
    path = fresh_dir(spark, "published-transaction")
    publish.publish_rebuild(b["transaction"], path, partition_cols)
    return path, b["transaction"]


@query("scan_partitioned_parquet")
def q_scan_partitioned_parquet(spark, sf_dir):
    path, txn = _published_transactions(spark, sf_dir)
    return scan_partitioned_parquet(spark, path, schema=txn.schema)


@query("scan_csv_by_name")
def q_scan_csv_by_name(spark, sf_dir):
    """Card landing files in two column orders (one with an extra column)."""
    b = bank_tables(spark, sf_dir)
    raw = raw_table(b, "card")
    landing = fresh_dir(spark, "landing-card")
    first = F.coalesce(F.col("type"), F.lit("")) < F.lit("M")
    (raw.where(first).select("card_id", "disp_id", "type", "year", "month", "day", "fulldate")
     .write.option("header", True).csv(f"{landing}/a"))
    (raw.where(~first).select("fulldate", "day", "month", "year", "type",
                              F.lit("x").alias("extra_col"), "disp_id", "card_id")
     .write.option("header", True).csv(f"{landing}/b"))
    return scan_csv_by_name(spark, [f"{landing}/a", f"{landing}/b"],
                            mapping_for("card").source_names)


# ---------------------------------------------------------------------------
# mapping
# ---------------------------------------------------------------------------

@query("apply_mapping")
def q_apply_mapping(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return apply_mapping(raw_table(b, "transaction"), mapping_for("transaction"),
                         Observation("transaction_rejects"))


# ---------------------------------------------------------------------------
# publishing
# ---------------------------------------------------------------------------

@query("stage_full_refresh")
def q_stage_full_refresh(spark, sf_dir):
    """Two staging loads of the same table: the second replaces the first."""
    b = bank_tables(spark, sf_dir)
    path = fresh_dir(spark, "stage-transaction")
    raw = raw_table(b, "transaction")
    stage_table(spark, raw, "transaction", path)
    return stage_table(spark, raw, "transaction", path)


@query("publish_rebuild_monthly")
def q_publish_rebuild_monthly(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    path = fresh_dir(spark, "published-account")
    publish.publish_rebuild(b["account"], path, PARTITIONS["account"])
    publish.publish_rebuild(b["account"], path, PARTITIONS["account"])
    return publish.read_back(spark, path, b["account"].schema)


@query("publish_rebuild_daily")
def q_publish_rebuild_daily(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    path = fresh_dir(spark, "published-transaction-daily")
    publish.publish_rebuild(b["transaction"], path, PARTITIONS["transaction"])
    return publish.read_back(spark, path, b["transaction"].schema)


def _latest_period(df: DataFrame, date_col: str) -> tuple:
    """Latest date and its (year, month) -- one small aggregate."""
    row = df.agg(F.max(date_col).alias("d")).first()
    d = row["d"]
    return d, d.year, d.month


def _base_and_batch(b):
    """Account rows before the latest day, and the complete latest month."""
    acc = b["account"]
    last_day, y, m = _latest_period(acc, "parseddate")
    base = acc.where(F.col("parseddate") < F.lit(last_day))
    batch = acc.where((F.col("year") == y) & (F.col("month") == m))
    return acc, base, batch


@query("publish_refresh_period")
def q_publish_refresh_period(spark, sf_dir):
    """Base without the last day, then the complete latest month, twice:
    the period is replaced, the re-run changes nothing."""
    b = bank_tables(spark, sf_dir)
    acc, base, batch = _base_and_batch(b)
    path = fresh_dir(spark, "published-account")
    parts = PARTITIONS["account"]
    publish.publish_rebuild(base, path, parts)
    publish.publish_refresh_period(batch, path, parts)
    publish.publish_refresh_period(batch, path, parts)
    return publish.read_back(spark, path, acc.schema)


@query("publish_append")
def q_publish_append(spark, sf_dir):
    """Published daily behaviour: the batch is appended on every run."""
    b = bank_tables(spark, sf_dir)
    acc, base, batch = _base_and_batch(b)
    path = fresh_dir(spark, "published-account")
    parts = PARTITIONS["account"]
    publish.publish_rebuild(base, path, parts)
    publish.publish_append(batch, path, parts)
    publish.publish_append(batch, path, parts)
    return publish.read_back(spark, path, acc.schema)


@query("publish_snapshot")
def q_publish_snapshot(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    path = fresh_dir(spark, "published-order")
    publish.publish_snapshot(b["order"], path)
    publish.publish_snapshot(b["order"], path)
    return publish.read_back(spark, path, b["order"].schema)


@query("publish_schema_evolution")
def q_publish_schema_evolution(spark, sf_dir):
    """Older periods were published without ``frequency``; the latest
    period's refresh adds it.  Older rows read it as NULL."""
    b = bank_tables(spark, sf_dir)
    acc, base, batch = _base_and_batch(b)
    path = fresh_dir(spark, "published-account")
    parts = PARTITIONS["account"]
    publish.publish_evolving(spark, base.drop("frequency"), path, parts)
    out = publish.publish_evolving(spark, batch, path, parts)
    return out.select(*acc.columns)


@query("period_scope")
def q_period_scope(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return publish.period_scope(b["transaction"], PARTITIONS["transaction"])


def _bank_args(b, *names):
    return [b[n] for n in names]


@query("write_mart")
def q_write_mart(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    mart = marts.account_summary(*_bank_args(b, "account", "transaction", "order",
                                             "disposition", "card"))
    path = fresh_dir(spark, "mart-account-summary")
    publish.write_mart(mart, path)
    return publish.read_back(spark, path, mart.schema)


def _summary_exact(b, year, month):
    return marts.customer_summary_exact(*_bank_args(b, "client", "disposition", "account",
                                                    "district", "transaction", "loan"),
                                        year, month)


@query("export_customer_summary_upsert")
def q_export_customer_summary_upsert(spark, sf_dir):
    """Export month 1, then month 2, then month 1 again: every key once."""
    b = bank_tables(spark, sf_dir)
    root = fresh_dir(spark, "export-customer-summary")
    first = export.summary_items(_summary_exact(b, START_YEAR, START_MONTH))
    second = export.summary_items(_summary_exact(b, NEXT_YEAR, NEXT_MONTH))
    export.upsert_keyed(spark, first, root, periods=[period_literal(START_YEAR, START_MONTH)])
    export.upsert_keyed(spark, second, root, periods=[period_literal(NEXT_YEAR, NEXT_MONTH)])
    return export.upsert_keyed(spark, first, root, periods=[period_literal(START_YEAR, START_MONTH)])


@query("export_store_items")
def q_export_store_items(spark, sf_dir):
    """Items of month 1, month 2 and month 1 again put to a store outside the
    tables: every key once."""
    b = bank_tables(spark, sf_dir)
    root = fresh_dir(spark, "store-customer-summary")
    first = export.summary_items(_summary_exact(b, START_YEAR, START_MONTH))
    second = export.summary_items(_summary_exact(b, NEXT_YEAR, NEXT_MONTH))
    for items in (first, second, first):
        export_to_store(items, FolderStore(spark, root), batch_size=5000)
    return FolderStore.items(spark, root, first.schema, export.SUMMARY_KEYS)


@query("stage_job_landing")
def q_stage_job_landing(spark, sf_dir):
    """The staging job over landing files of two column orders, read back by
    its catalogue name."""
    raw = raw_table(bank_tables(spark, sf_dir), "card")
    root = fresh_dir(spark, "lake-card")
    half = F.coalesce(F.pmod(F.xxhash64("card_id"), F.lit(2)), F.lit(0))
    for i, columns in enumerate((raw.columns, raw.columns[::-1])):
        raw.where(half == i).select(*columns).write.mode("append").option("header", True).csv(f"{root}/landing/card")
    database = f"lake_{root[-12:]}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{root}/catalogue'")
    jobs.stage_job(spark, root, "card", database)
    return scan_table(spark, f"{database}.stage_card")


# ---------------------------------------------------------------------------
# filters and projections
# ---------------------------------------------------------------------------

@query("filter_nonempty")
def q_filter_nonempty(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return filter_nonempty(b["transaction"], "operation").select(
        "trans_id", "account_id", "operation", "amount")


@query("filter_date_from")
def q_filter_date_from(spark, sf_dir):
    """On the (year, month)-partitioned layout: the implied period predicate
    prunes partitions, the date predicate is exact."""
    path, txn = _published_transactions(spark, sf_dir)
    df = scan_partitioned_parquet(spark, path, schema=txn.schema)
    return filter_date_from(df, START_YEAR, START_MONTH, "fulldate", ("year", "month")).select(
        "trans_id", "account_id", "fulldate", "amount", "year", "month")


@query("with_period_column")
def q_with_period_column(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["account"].select("account_id", "frequency",
                               F.lit(period_literal(START_YEAR, START_MONTH)).alias("pdate"))


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------

@query("inner_join_chain")
def q_inner_join_chain(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    cln = b["client"].select("client_id")
    d = b["disposition"].select(F.col("client_id").alias("d_client"),
                                F.col("account_id").alias("d_account"), "type")
    acc = b["account"].select("account_id", "frequency", F.col("district_id").alias("a_district"))
    dist = b["district"].select(F.col("district_id").alias("dt_district"), F.col("city").alias("branch"))
    out = join_chain(cln, [(d, cln.client_id == d.d_client, "inner"),
                           (acc, F.col("d_account") == acc.account_id, "inner"),
                           (dist, F.col("a_district") == F.col("dt_district"), "inner")])
    return out.select("client_id", "account_id", "frequency", "branch", "type")


@query("left_join_chain")
def q_left_join_chain(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    cln = b["client"].select("client_id")
    d = b["disposition"].select(F.col("client_id").alias("d_client"),
                                F.col("account_id").alias("d_account"), "type")
    acc = b["account"].select("account_id", "frequency", "parseddate")
    out = join_chain(left_join_hot_right(cln, d, "client_id", "d_client"),
                     [(acc, F.col("d_account") == acc.account_id, "left")])
    return out.select("client_id", "type", "account_id", "frequency", "parseddate")


@query("left_join_residual")
def q_left_join_residual(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    acc = b["account"].select("account_id")
    txn = b["transaction"].select("account_id", "trans_id", "operation", "amount")
    return left_join_residual(acc, txn, "account_id", nonempty("operation"))


@query("left_join_aggregated")
def q_left_join_aggregated(spark, sf_dir):
    """account LEFT JOIN (transactions per account and month since the start)
    LEFT JOIN (loans per account and month since the start), on the account."""
    b = bank_tables(spark, sf_dir)
    txn = (filter_date_from(b["transaction"], START_YEAR, START_MONTH)
           .groupBy("account_id", "year", "month")
           .agg(agg.rounded_total("amount").cast("double").alias("total_spent"),
                F.count("trans_id").alias("total_transactions"))
           .drop("year", "month"))
    loans = (filter_date_from(b["loan"], START_YEAR, START_MONTH)
             .groupBy("account_id", "year", "month")
             .agg(agg.rounded_total("amount").cast("double").alias("total_loan_amount"),
                  F.count("loan_id").alias("total_loans"))
             .drop("year", "month"))
    acc = b["account"].select("account_id")
    return left_join_aggregated(acc, [txn, loans], "account_id").select(
        "account_id", coalesce_default("total_transactions").alias("total_transactions"),
        coalesce_default("total_spent").cast("double").alias("total_spent"),
        coalesce_default("total_loan_amount").cast("double").alias("total_loan_amount"),
        coalesce_default("total_loans").alias("total_loans"))


@query("latest_by_key")
def q_latest_by_key(spark, sf_dir):
    """Rows carrying their account's latest timestamp (ties kept)."""
    b = bank_tables(spark, sf_dir)
    txn = b["transaction"].select("account_id", "trans_id", "balance", "fulldatewithtime")
    return latest_rows(txn, "account_id", "fulldatewithtime")


@query("self_join_latest")
def q_self_join_latest(spark, sf_dir):
    """Non-empty-operation transactions joined to their account's latest
    balances, grouped per (account, balance): joined row counts."""
    b = bank_tables(spark, sf_dir)
    per_balance = (b["transaction"].where(F.col("account_id").isNotNull())
                   .groupBy("account_id", "fulldatewithtime", "balance")
                   .agg(F.count(F.lit(1)).alias("m"), F.count_if(nonempty("operation")).alias("n")))
    totals = (per_balance.groupBy(F.col("account_id").alias("account"))
              .agg(F.max("fulldatewithtime").alias("latest"), F.sum("n").alias("rows"), F.sum("m").alias("all"))
              .where("all >= rows and rows > 0 and latest is not null"))
    ties = per_balance.where("m >= n").select("account_id", "fulldatewithtime", "balance", "m")
    return (ties.join(totals, (F.col("account_id") == F.col("account")) & F.col("fulldatewithtime").eqNullSafe(F.col("latest")))
            .select("account_id", "balance", (F.col("rows") * F.col("m")).alias("joined_rows")))


# ---------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------

@query("agg_count_sum")
def q_agg_count_sum(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return agg.count_sum(b["transaction"], ["account_id"], "trans_id", "amount",
                         "total_transactions", "total_transaction_amount")


@query("agg_rounded_total")
def q_agg_rounded_total(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["loan"].groupBy("account_id").agg(
        agg.rounded_total("amount").cast("double").alias("total_loan_amount"),
        F.count("loan_id").alias("total_loans"))


@query("agg_conditional_sum")
def q_agg_conditional_sum(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["transaction"].groupBy("account_id").agg(
        agg.conditional_sum("amount", "operation", CREDIT_IN_CASH).cast("double")
        .alias("total_in_cash_credit"),
        agg.conditional_sum("amount", "operation", CASH_WITHDRAWAL).cast("double")
        .alias("total_withdrawal_credit"))


@query("agg_conditional_count_compat")
def q_agg_conditional_count_compat(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["transaction"].groupBy("account_id").agg(
        agg.conditional_count_compat("operation", CREDIT_IN_CASH).alias("total_in_cash_transaction"),
        agg.conditional_count_compat("operation", CASH_WITHDRAWAL).alias("total_withdrawal_transaction"))


@query("agg_conditional_count")
def q_agg_conditional_count(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["transaction"].groupBy("account_id").agg(
        agg.conditional_count("operation", CREDIT_IN_CASH).alias("total_in_cash_transaction"),
        agg.conditional_count("operation", CASH_WITHDRAWAL).alias("total_withdrawal_transaction"))


@query("agg_distinct_list")
def q_agg_distinct_list(spark, sf_dir):
    """Card types per account over disposition LEFT JOIN card; cards are
    reduced to distinct (disp_id, type) before the join."""
    b = bank_tables(spark, sf_dir)
    types = b["card"].where(F.col("disp_id").isNotNull()).select("disp_id", "type").distinct()
    d = b["disposition"].where(F.col("account_id").isNotNull()).select("account_id", "disp_id")
    return (d.join(types, "disp_id", "left").groupBy("account_id")
            .agg(agg.distinct_list("type").alias("card_types")))


@query("agg_by_period")
def q_agg_by_period(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return agg.agg_by_period(b["transaction"], "account_id", "trans_id", "amount")


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------

@query("fn_date")
def q_fn_date(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["transaction"].select("trans_id", to_day("fulldatewithtime").alias("txn_date"))


@query("fn_coalesce_default")
def q_fn_coalesce_default(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    orders = b["order"].groupBy("account_id").agg(
        F.count("order_id").alias("n"), money_sum("amount").alias("s"))
    return (b["account"].select("account_id").join(orders, "account_id", "left")
            .select("account_id", coalesce_default("n").alias("total_orders"),
                    rounded(coalesce_default("s")).alias("total_order_amount")))


@query("fn_period_key")
def q_fn_period_key(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return b["transaction"].select("trans_id", "account_id", period_key("year", "month").alias("pkey"))


@query("fn_exact_decimal")
def q_fn_exact_decimal(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    spent = b["transaction"].groupBy("account_id").agg(
        agg.rounded_total("amount").cast("double").alias("total_spent"))
    return spent.select("account_id", exact_decimal("total_spent").alias("total_spent"))


# ---------------------------------------------------------------------------
# incremental intake
# ---------------------------------------------------------------------------

@query("stream_ingest_landing")
def q_stream_ingest_landing(spark, sf_dir):
    """Account landing files arrive in two drops with different column
    orders; the stream runs after each drop and once more with nothing new."""
    b = bank_tables(spark, sf_dir)
    raw = raw_table(b, "account")
    landing = fresh_dir(spark, "landing-account")
    stage_root = fresh_dir(spark, "stage-account-stream")
    checkpoint = fresh_dir(spark, "checkpoint-account-stream")
    urgent = F.col("frequency").isin("1-URGENT", "2-HIGH")
    raw.where(urgent).write.option("header", True).csv(landing)
    ingest_landing(spark, landing, "account", stage_root, checkpoint)
    (raw.where(~urgent | F.col("frequency").isNull())
     .select("day", "month", "year", "parseddate", "frequency", "district_id", "account_id")
     .write.mode("append").option("header", True).csv(landing))
    ingest_landing(spark, landing, "account", stage_root, checkpoint)
    ingest_landing(spark, landing, "account", stage_root, checkpoint)
    return read_ingested(spark, "account", stage_root)


@query("stream_ingest_publish")
def q_stream_ingest_publish(spark, sf_dir):
    """Landing drops ingested and published per micro-batch: each batch
    refreshes exactly the periods it touches in the published layer."""
    b = bank_tables(spark, sf_dir)
    raw = raw_table(b, "account")
    landing = fresh_dir(spark, "landing-account")
    stage_root = fresh_dir(spark, "stage-account-stream")
    published = fresh_dir(spark, "transformed-account-stream")
    checkpoint = fresh_dir(spark, "checkpoint-account-ingest-publish")
    urgent = F.col("frequency").isin("1-URGENT", "2-HIGH")
    raw.where(urgent).write.option("header", True).csv(landing)
    ingest_landing(spark, landing, "account", stage_root, checkpoint, publish_root=published)
    (raw.where(~urgent | F.col("frequency").isNull())
     .write.mode("append").option("header", True).csv(landing))
    ingest_landing(spark, landing, "account", stage_root, checkpoint, publish_root=published)
    ingest_landing(spark, landing, "account", stage_root, checkpoint, publish_root=published)
    return publish.read_back(spark, published, mapping_for("account").target_schema())


@query("stream_publish_stage")
def q_stream_publish_stage(spark, sf_dir):
    """Staging writes trigger the daily publish: first all accounts but the
    latest day, then a staging write holding the complete latest month; the
    stream publishes after each, and once more with nothing new."""
    b = bank_tables(spark, sf_dir)
    acc, base, batch = _base_and_batch(b)
    stage_dir = fresh_dir(spark, "stage-account")
    transformed = fresh_dir(spark, "transformed-account")
    checkpoint = fresh_dir(spark, "checkpoint-account-publish")
    mapping = mapping_for("account")
    publish.stage_full_refresh(apply_mapping(to_raw_strings(base, mapping), mapping), stage_dir)
    publish_on_stage_change(spark, stage_dir, "account", transformed, checkpoint)
    publish.stage_full_refresh(apply_mapping(to_raw_strings(batch, mapping), mapping), stage_dir)
    publish_on_stage_change(spark, stage_dir, "account", transformed, checkpoint)
    publish_on_stage_change(spark, stage_dir, "account", transformed, checkpoint)
    return publish.read_back(spark, transformed, mapping.target_schema())


@query("landing_route")
def q_landing_route(spark, sf_dir):
    """Object keys of several shapes, built from the events table."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    eid = F.col("event_id").cast("string")
    key = (F.when(F.col("event_type") == "signup", F.concat(F.lit("raw_data/loan/"), eid, F.lit(".csv")))
           .when(F.col("event_type") == "purchase",
                 F.concat(F.lit("stage_data/order/part-"), eid, F.lit(".parquet")))
           .when(F.col("event_type") == "click",
                 F.concat(F.lit("stage_data/loan_portfolio/"), eid, F.lit("+v1.csv")))
           .when(F.col("event_type") == "view",
                 F.concat(F.lit("raw_data%2Ftransaction%2F"), eid, F.lit("%zz.csv")))
           .otherwise(F.concat(F.lit("other/"), eid, F.lit(".csv"))))
    return landing_route(events.select(key.alias("key")))


# ---------------------------------------------------------------------------
# marts
# ---------------------------------------------------------------------------

@query("account_summary")
def q_account_summary(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return marts.account_summary(*_bank_args(b, "account", "transaction", "order",
                                             "disposition", "card"))


@query("account_summary_exact")
def q_account_summary_exact(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return marts.account_summary_exact(*_bank_args(b, "account", "transaction", "order",
                                                   "disposition", "card"))


@query("customer_master")
def q_customer_master(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return marts.customer_master(*_bank_args(b, "client", "disposition", "account", "transaction"))


@query("customer_master_exact")
def q_customer_master_exact(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return marts.customer_master_exact(*_bank_args(b, "client", "disposition", "account",
                                                   "transaction"))


@query("customer_summary")
def q_customer_summary(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return marts.customer_summary(*_bank_args(b, "client", "disposition", "account", "district",
                                              "transaction", "loan"), START_YEAR, START_MONTH)


@query("customer_summary_exact")
def q_customer_summary_exact(spark, sf_dir):
    b = bank_tables(spark, sf_dir)
    return _summary_exact(b, START_YEAR, START_MONTH)


@query("publish_catalog_table")
def q_publish_catalog_table(spark, sf_dir):
    """A published table read by its catalogue name after a refresh that adds
    a partition: the refresh itself enters the last month's folder."""
    account = bank_tables(spark, sf_dir)["account"]
    path, parts = fresh_dir(spark, "catalog-account"), ["year", "month"]
    last = account.agg(F.max(F.col("year") * 12 + F.col("month"))).first()[0]
    month = F.col("year") * 12 + F.col("month")
    name = f"`default`.`published_account_{abs(hash(path)):x}`"
    publish.publish_rebuild(account.where(month < last), path, parts)
    publish.register_table(spark, name, path, account.schema, parts)
    publish.publish_checked(spark, account.where(month == last), path, parts, "parseddate", table=name)
    return scan_table(spark, name)


@query("stream_ingest_mixed_headers")
def q_stream_ingest_mixed_headers(spark, sf_dir):
    """Landing files in two column orders, under names with a blank, brackets
    and a plus, taken by one stream."""
    raw = raw_table(bank_tables(spark, sf_dir), "account")
    landing, stage, ckpt = (fresh_dir(spark, n) for n in ("landing-mixed", "stage-mixed", "ckpt-mixed"))
    half = F.pmod(F.xxhash64("account_id"), F.lit(3))
    names = ["a b", "a[1]", "a+c"]
    for i, name in enumerate(names):
        columns = raw.columns if i else raw.columns[::-1]
        raw.where(half == i).select(*columns).write.option("header", True).csv(f"{landing}/{name}")
    ingest_landing(spark, f"{landing}/*", "account", stage, ckpt)
    return read_ingested(spark, "account", stage)


def _odd_transactions(txn: DataFrame) -> DataFrame:
    """Transactions plus copies whose stored date parts are missing, shifted to
    another month, or no calendar day (31 February)."""
    last = F.col("trans_id") % 10
    def odd(which, **parts):
        return txn.where(last == which).withColumns(
            {"trans_id": -F.col("trans_id"), **{c: v.cast("int") for c, v in parts.items()}})
    return (txn.union(odd(1, year=F.lit(None), month=F.lit(None))).union(odd(2, year=F.col("year") - 1, month=F.lit(12)))
            .union(odd(3, month=F.lit(2), day=F.lit(31))))


def _published_bank(spark, sf_dir) -> str:
    """A lake whose published layer holds the bank tables, the transactions
    with odd date parts among them."""
    root = fresh_dir(spark, "lake")
    for name, df in bank_tables(spark, sf_dir).items():
        if name in PARTITIONS:
            df = _odd_transactions(df) if name == "transaction" else df
            jobs.publish_table(spark, df, root, name, rebuild=True)
    return root


def _bound_schema(b: dict[str, DataFrame]):
    return {n: df.schema for n, df in b.items()}


@query("publish_evolving_pruned")
def q_publish_evolving_pruned(spark, sf_dir):
    """Transactions published by an evolving refresh, odd date parts among
    them, read from the start month on with the folders that the recorded
    dates rule out pruned away."""
    txn = _odd_transactions(bank_tables(spark, sf_dir)["transaction"])
    path, parts = fresh_dir(spark, "evolving-transaction"), ["year", "month"]
    publish.publish_rebuild(txn.limit(0), path, parts, date_col="fulldate")
    publish.publish_evolving(spark, txn, path, parts, date_col="fulldate")
    start = datetime.date(START_YEAR, START_MONTH, 1)
    df = scan_partitioned_parquet(spark, path, schema=txn.schema)
    dated = zones.within(spark, path, parts, lo=start)
    return df.where(dated).where(F.col("fulldate") >= F.lit(start)).select("trans_id", "account_id", "fulldate", "amount", "year", "month")


@query("customer_master_published")
def q_customer_master_published(spark, sf_dir):
    """The job's plan over the day-partitioned published layout."""
    return jobs.customer_master(spark, _published_bank(spark, sf_dir), schemas=_bound_schema(bank_tables(spark, sf_dir)))


@query("customer_summary_published")
def q_customer_summary_published(spark, sf_dir):
    """The job's plan over the published layout, from a start month."""
    return jobs.customer_summary(spark, _published_bank(spark, sf_dir), START_YEAR, START_MONTH, exact=False,
                                 schemas=_bound_schema(bank_tables(spark, sf_dir)))
