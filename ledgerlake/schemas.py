"""Declared schemas of the nine bank tables and their staging mappings.

A mapping entry is (source name, source type, target name, target type).
Columns a mapping does not list are dropped at the stage boundary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The stage mappings of the bank data set.  Column names, their
# order and their types must equal the source system's contract.  One
# deliberate change: loan_portfolio "address 2" maps to address_2 (the
# source contract misspells the target name).
# ---------------------------------------------------------------------------
MAPPINGS: dict[str, list[tuple[str, str, str, str]]] = {
    "account": [
        ("account_id", "string", "account_id", "string"),
        ("district_id", "bigint", "district_id", "bigint"),
        ("frequency", "string", "frequency", "string"),
        ("parseddate", "string", "parseddate", "date"),
        ("year", "bigint", "year", "int"),
        ("month", "bigint", "month", "int"),
        ("day", "bigint", "day", "int"),
    ],
    "card": [
        ("card_id", "string", "card_id", "string"),
        ("disp_id", "string", "disp_id", "string"),
        ("type", "string", "type", "string"),
        ("day", "long", "day", "int"),
        ("month", "long", "month", "int"),
        ("year", "long", "year", "int"),
        ("fulldate", "string", "fulldate", "date"),
    ],
    "client": [
        ("client_id", "string", "client_id", "string"),
        ("sex", "string", "sex", "string"),
        ("fulldate", "string", "fulldate", "date"),
        ("day", "long", "day", "int"),
        ("month", "long", "month", "int"),
        ("year", "long", "year", "int"),
        ("age", "long", "age", "int"),
        ("social", "string", "social", "string"),
        ("first", "string", "first", "string"),
        ("middle", "string", "middle", "string"),
        ("last", "string", "last", "string"),
        ("phone", "string", "phone", "string"),
        ("email", "string", "email", "string"),
        ("address_1", "string", "address_1", "string"),
        ("address_2", "string", "address_2", "string"),
        ("city", "string", "city", "string"),
        ("state", "string", "state", "string"),
        ("zipcode", "long", "zipcode", "long"),
        ("district_id", "long", "district_id", "long"),
    ],
    "disposition": [
        ("disp_id", "string", "disp_id", "string"),
        ("client_id", "string", "client_id", "string"),
        ("account_id", "string", "account_id", "string"),
        ("type", "string", "type", "string"),
    ],
    "district": [
        ("district_id", "bigint", "district_id", "bigint"),
        ("city", "string", "city", "string"),
        ("state_name", "string", "state_name", "string"),
        ("state_abbrev", "string", "state_abbrev", "string"),
        ("region", "string", "region", "string"),
        ("division", "string", "division", "string"),
    ],
    "loan": [
        ("loan_id", "string", "loan_id", "string"),
        ("account_id", "string", "account_id", "string"),
        ("amount", "long", "amount", "long"),
        ("duration", "long", "duration", "long"),
        ("payments", "long", "payments", "long"),
        ("status", "string", "status", "string"),
        ("year", "long", "year", "int"),
        ("month", "long", "month", "int"),
        ("day", "long", "day", "int"),
        ("fulldate", "string", "fulldate", "date"),
        ("location", "long", "location", "long"),
        ("purpose", "string", "purpose", "string"),
    ],
    "loan_portfolio": [
        ("loan_id", "string", "loan_id", "string"),
        ("funded_amount", "double", "funded_amount", "double"),
        ("funded_date", "string", "funded_date", "date"),
        ("duration years", "long", "duration_years", "int"),
        ("duration months", "long", "duration_months", "int"),
        ("10 yr treasury index date funded", "double", "10_yr_treasury_index_date_funded", "double"),
        ("interest rate percent", "double", "interest_rate_percent", "double"),
        ("interest rate", "double", "interest_rate", "double"),
        ("payments", "double", "payments", "double"),
        ("total past payments", "long", "total_past_payments", "long"),
        ("loan balance", "double", "loan_balance", "double"),
        ("property value", "double", "property_value", "double"),
        ("purpose", "string", "purpose", "string"),
        ("firstname", "string", "firstname", "string"),
        ("middlename", "string", "middlename", "string"),
        ("lastname", "string", "lastname", "string"),
        ("social", "string", "social", "string"),
        ("phone", "string", "phone", "string"),
        ("title", "string", "title", "string"),
        ("employment length", "long", "employment_length", "long"),
        ("building class category", "string", "building_class_category", "string"),
        ("tax class at present", "string", "tax_class_at_present", "string"),
        ("building class at present", "string", "building_class_at_present", "string"),
        ("address 1", "string", "address_1", "string"),
        ("address 2", "string", "address_2", "string"),
        ("zip code", "long", "zip_code", "int"),
        ("city", "string", "city", "string"),
        ("state", "string", "state", "string"),
        ("total units", "long", "total_units", "long"),
        ("tax class at time of sale", "long", "tax_class_at_time_of_sale", "long"),
    ],
    "order": [
        ("order_id", "long", "order_id", "long"),
        ("account_id", "string", "account_id", "string"),
        ("bank_to", "string", "bank_to", "string"),
        ("account_to", "long", "account_to", "long"),
        ("amount", "double", "amount", "double"),
        ("k_symbol", "string", "k_symbol", "string"),
    ],
    "transaction": [
        ("trans_id", "string", "trans_id", "string"),
        ("account_id", "string", "account_id", "string"),
        ("type", "string", "type", "string"),
        ("operation", "string", "operation", "string"),
        ("amount", "double", "amount", "double"),
        ("balance", "double", "balance", "double"),
        ("k_symbol", "string", "k_symbol", "string"),
        ("bank", "string", "bank", "string"),
        ("account", "string", "account", "string"),
        ("year", "long", "year", "int"),
        ("month", "long", "month", "int"),
        ("day", "long", "day", "int"),
        ("fulldate", "string", "fulldate", "date"),
        ("fulltime", "string", "fulltime", "string"),
        ("fulldatewithtime", "string", "fulldatewithtime", "timestamp"),
    ],
}

# Published-layer layout: partition columns per table (empty = unpartitioned).
PARTITIONS: dict[str, tuple[str, ...]] = {
    "account": ("year", "month"),
    "card": ("year", "month"),
    "client": ("year", "month"),
    "loan": ("year", "month"),
    "transaction": ("year", "month", "day"),
    "order": (),
    "district": (),
    "disposition": (),
}

# The date that a table's stored year, month and day should come from.
DATE_OF = {"account": "parseddate", "card": "fulldate", "client": "fulldate", "loan": "fulldate", "transaction": "fulldate"}

# ---------------------------------------------------------------------------
# Literals the published results depend on.
# ---------------------------------------------------------------------------
# Operation categories the customer master classifies on.
CREDIT_IN_CASH = "Credit in Cash"
CASH_WITHDRAWAL = "Cash Withdrawal"
# Separator of the joined card-type list in the account summary.
CARD_TYPES_SEPARATOR = ", "
# Landing key prefixes: raw files start a staging load, staging files a daily publish.
RAW_PREFIX = "raw_data"
STAGE_PREFIX = "stage_data"

_TYPE_NAMES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    # Wall-clock timestamps without a zone, like the landing strings.
    "timestamp": T.TimestampNTZType(),
}


def spark_type(name: str) -> T.DataType:
    try:
        return _TYPE_NAMES[name]
    except KeyError:
        return T._parse_datatype_string(name)


@dataclass(frozen=True)
class Mapping:
    """A declared schema mapping for one table."""

    table: str
    entries: tuple[tuple[str, str, str, str], ...]

    @property
    def source_names(self) -> list[str]:
        return [e[0] for e in self.entries]

    @property
    def target_names(self) -> list[str]:
        return [e[2] for e in self.entries]

    def target_schema(self) -> T.StructType:
        return T.StructType([T.StructField(dst, spark_type(dt), True)
                             for _, _, dst, dt in self.entries])


def mapping_for(table: str) -> Mapping:
    return Mapping(table, tuple(MAPPINGS[table]))
