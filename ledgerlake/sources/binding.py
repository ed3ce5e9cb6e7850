"""Binding of the bank data model to the driver's TPC-H-like tables.

The pipeline itself reads the transformed bank tables; this module only
derives those nine tables from the test tables, lazily, so every query
reads the given tables and its work grows with them.  Attributes with no
counterpart in the test tables are typed NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schemas import CASH_WITHDRAWAL, CREDIT_IN_CASH

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


# Declared input schemas (only the columns the binding uses).  Declaring them
# skips footer-based schema inference on every read.
DRIVER_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "part": "p_partkey bigint, p_type string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class BankTables(dict):
    """The nine bank tables, each built on first access (a query pays only
    for the tables it reads)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def _src(self, name: str) -> DataFrame:
        return _read(self._spark, self._dir, name)

    def __missing__(self, name: str) -> DataFrame:
        builder = getattr(self, f"_build_{name}", None)
        if builder is None:
            raise KeyError(name)
        df = builder()
        self[name] = df
        return df

    def keys(self):  # every table, built or not
        return list(BANK_TABLE_NAMES)

    def items(self):
        return [(n, self[n]) for n in BANK_TABLE_NAMES]

    # Each table is one projection of SQL expressions: parsed and analysed
    # once in the JVM instead of one driver round trip per column.

    def _build_client(self) -> DataFrame:
        return self._src("customer").selectExpr(
            "c_custkey AS client_id", "CAST(NULL AS STRING) AS sex", "CAST(NULL AS DATE) AS fulldate",
            "CAST(NULL AS INT) AS day", "CAST(NULL AS INT) AS month", "CAST(NULL AS INT) AS year",
            "CAST(NULL AS INT) AS age", "CAST(NULL AS STRING) AS social", "c_name AS first",
            "CAST(NULL AS STRING) AS middle", "CAST(NULL AS STRING) AS last",
            "CAST(NULL AS STRING) AS phone", "CAST(NULL AS STRING) AS email",
            "CAST(NULL AS STRING) AS address_1", "CAST(NULL AS STRING) AS address_2",
            "CAST(NULL AS STRING) AS city", "CAST(NULL AS STRING) AS state",
            "CAST(NULL AS BIGINT) AS zipcode", "CAST(c_nationkey AS BIGINT) AS district_id")

    def _build_district(self) -> DataFrame:
        return self._src("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS district_id", "n_name AS city",
            "CAST(NULL AS STRING) AS state_name", "CAST(NULL AS STRING) AS state_abbrev",
            "CAST(NULL AS STRING) AS region", "CAST(NULL AS STRING) AS division")

    def _build_account(self) -> DataFrame:
        orders, customer = self._src("orders"), self._src("customer")
        return (orders.join(customer, orders.o_custkey == customer.c_custkey)
                .selectExpr("o_orderkey AS account_id", "CAST(c_nationkey AS BIGINT) AS district_id",
                            "o_orderpriority AS frequency", "CAST(o_orderdate AS DATE) AS parseddate")
                .selectExpr("*", *_DATE_PARTS.format(d="parseddate").split(";")))

    def _build_disposition(self) -> DataFrame:
        return self._src("orders").selectExpr(
            "o_orderkey AS disp_id", "o_custkey AS client_id", "o_orderkey AS account_id",
            "o_orderstatus AS type")

    def _build_transaction(self) -> DataFrame:
        return self._src("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS trans_id", "l_orderkey AS account_id",
            "CAST(NULL AS STRING) AS type",
            f"CASE l_returnflag WHEN 'A' THEN '{CREDIT_IN_CASH}' WHEN 'R' THEN '{CASH_WITHDRAWAL}' "
            "ELSE '' END AS operation",
            "l_extendedprice AS amount", "l_quantity AS balance", "CAST(NULL AS STRING) AS k_symbol",
            "CAST(NULL AS STRING) AS bank", "CAST(NULL AS STRING) AS account",
            *_DATE_PARTS.format(d="CAST(l_shipdate AS DATE)").split(";"),
            "CAST(l_shipdate AS DATE) AS fulldate", "CAST(NULL AS STRING) AS fulltime",
            "l_shipdate AS fulldatewithtime")

    def _build_loan(self) -> DataFrame:
        return self._src("events").where("event_type = 'signup'").selectExpr(
            "event_id AS loan_id", "user_id AS account_id", "value AS amount",
            "CAST(NULL AS BIGINT) AS duration", "CAST(NULL AS BIGINT) AS payments",
            "CAST(NULL AS STRING) AS status", *_DATE_PARTS.format(d="CAST(ts AS DATE)").split(";"),
            "CAST(ts AS DATE) AS fulldate", "CAST(NULL AS BIGINT) AS location",
            "CAST(NULL AS STRING) AS purpose")

    def _build_order(self) -> DataFrame:
        return self._src("events").where("event_type = 'purchase'").selectExpr(
            "event_id AS order_id", "user_id AS account_id", "CAST(NULL AS STRING) AS bank_to",
            "CAST(NULL AS BIGINT) AS account_to", "value AS amount",
            "CAST(NULL AS STRING) AS k_symbol")

    def _build_card(self) -> DataFrame:
        return self._src("part").selectExpr(
            "p_partkey AS card_id", "CAST(floor(p_partkey / 2) AS BIGINT) AS disp_id",
            "p_type AS type", "CAST(NULL AS INT) AS day", "CAST(NULL AS INT) AS month",
            "CAST(NULL AS INT) AS year", "CAST(NULL AS DATE) AS fulldate")


_DATE_PARTS = "year({d}) AS year;month({d}) AS month;dayofmonth({d}) AS day"


BANK_TABLE_NAMES = ("client", "district", "account", "disposition", "transaction", "loan",
                    "order", "card")


def bank_tables(spark: SparkSession, sf_dir: str) -> BankTables:
    return BankTables(spark, sf_dir)


def register_bank_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> dict[str, DataFrame]:
    tables = bank_tables(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return tables
