"""Job entry points over a lake layout: one per step of the bank ETL.

Layout below ``root`` (any file system Spark can write, e.g. an object store):

    landing/<table>/*.csv            raw landing files (headed CSV)
    stage/<table>/                   typed staging tables (full replace)
    transformed/<table>/             published layer, partitioned per table
    analysis/<mart>/                 marts (full replace)
    export/customer_summary/         keyed export (versioned per period)
    _checkpoints/                    stream checkpoints

Every job is a Spark plan from scan to write; nothing but file names,
period values and reject counts reaches the driver.

    python -m ledgerlake.plans.jobs <job> --root <root> [--table T] [--year Y --month M]
"""

from __future__ import annotations

import argparse
import datetime
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import period_literal, validate_period
from ledgerlake.operators import export, publish, zones
from ledgerlake.operators.mapping import apply_mapping, reject_counts
from ledgerlake.plans import marts
from ledgerlake.schemas import DATE_OF, MAPPINGS, PARTITIONS, mapping_for
from ledgerlake.sources.csv_landing import scan_csv_by_name
from ledgerlake.sources.tables import scan_partitioned_parquet
from ledgerlake.streaming.ingest import ingest_landing, publish_on_stage_change


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def read_transformed(spark: SparkSession, root: str, table: str, schema=None) -> DataFrame:
    """A published table with its declared schema (no inference, stable
    partition column types); filters on partition columns prune folders."""
    return scan_partitioned_parquet(spark, _p(root, "transformed", table),
                                    schema=schema or mapping_for(table).target_schema())


def read_stage(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(mapping_for(table).target_schema()).parquet(_p(root, "stage", table))


# --- raw -> stage -----------------------------------------------------------

def stage_job(spark: SparkSession, root: str, table: str, database: str | None = None) -> dict[str, int]:
    """Landing CSV (bound by header name) -> declared mapping -> staging table,
    entered as ``<database>.stage_<table>`` where a database is named.
    Returns the reject count per column, and of ragged rows."""
    mapping = mapping_for(table)
    landing, target = _p(root, "landing", table), _p(root, "stage", table)
    obs, ragged = Observation(f"{table}_rejects"), Observation(f"{table}_ragged")
    raw = scan_csv_by_name(spark, [landing], mapping.source_names, observation=ragged, need_header=True)
    publish.stage_full_refresh(apply_mapping(raw, mapping, obs), target)
    if database is not None:
        publish.update_catalogue(spark, f"`{database}`.`stage_{table}`", target, mapping.target_schema())
    return {**reject_counts(obs), **reject_counts(ragged)}


def register_job(spark: SparkSession, root: str, table: str, database: str = "default") -> list[str]:
    """Enter the staging and the published table in the session's catalogue,
    as ``<database>.stage_<table>`` and ``<database>.<table>``."""
    schema = mapping_for(table).target_schema()
    names = [f"`{database}`.`stage_{table}`"]
    publish.register_table(spark, names[0], _p(root, "stage", table), schema)
    if table in PARTITIONS:
        target = _p(root, "transformed", table)
        names.append(f"`{database}`.`{table}`")
        publish.register_table(spark, names[1], target, publish.existing_schema(spark, target) or schema, PARTITIONS[table])
    return names


def ingest_job(spark: SparkSession, root: str, table: str, archive: bool = False,
               publish_batches: bool = False) -> None:
    """Incremental form of the staging load: new landing files only, each once.

    ``archive`` moves processed files to ``landing_archive/<table>`` (then the
    stream is the only consumer of the landing folder); ``publish_batches``
    also refreshes, per micro-batch, the published periods it touches (its
    staging folder is ``stage_by_period``)."""
    if publish_batches:
        _published_layout(table)
    stage = "stage_by_period" if publish_batches else "stage_incremental"
    ingest_landing(spark, _p(root, "landing", table), table, _p(root, stage, table),
                   _p(root, "_checkpoints", f"ingest-{table}"),
                   archive_dir=_p(root, "landing_archive", table) if archive else None,
                   publish_root=_p(root, "transformed", table) if publish_batches else None)


# --- stage -> transformed ---------------------------------------------------

def publish_stream_job(spark: SparkSession, root: str, table: str) -> None:
    """Daily publish driven by new staging files (each staging write once)."""
    _published_layout(table)
    publish_on_stage_change(spark, _p(root, "stage", table), table, _p(root, "transformed", table),
                            _p(root, "_checkpoints", f"publish-{table}"))


def _published_layout(table: str) -> tuple[str, ...]:
    if table not in PARTITIONS:
        raise ValueError(f"{table} has no published layer (it is staged only)")
    return PARTITIONS[table]


def publish_table(spark: SparkSession, df: DataFrame, root: str, table: str, rebuild: bool = False, append: bool = False,
                  database: str | None = None) -> None:
    """Write a table to the published layer: all of it, or (daily) exactly the
    batch's periods; or append as the published jobs did.  The table may gain
    columns and wider types.  With ``database`` its catalogue entry
    ``<database>.<table>`` is brought up to date as part of the publish."""
    parts = _published_layout(table)
    target = _p(root, "transformed", table)
    name = f"`{database}`.`{table}`" if database is not None else None
    if not parts:
        publish.publish_snapshot(df, target)
        if name is not None:
            publish.update_catalogue(spark, name, target, df.schema)
        return
    if not rebuild:
        df = publish.align_to_schema(df, publish.existing_schema(spark, target))
        publish.write_table_schema(spark, target, df.schema)
    publish.publish_checked(spark, df, target, parts, DATE_OF.get(table),
                            "rebuild" if rebuild else "append" if append else "refresh", table=name)
    if rebuild:
        publish.write_table_schema(spark, target, df.schema)


def publish_daily_job(spark: SparkSession, root: str, table: str, compat_append: bool = False, database: str | None = None) -> None:
    """Publish the staged batch: replace exactly its periods (or, with
    ``compat_append``, append as the published jobs did); unpartitioned
    tables are replaced whole.  The table may gain columns and wider types; a
    type that the table cannot be widened to is refused before anything is
    written."""
    publish_table(spark, read_stage(spark, root, table), root, table, append=compat_append, database=database)


def publish_firstday_job(spark: SparkSession, root: str, table: str, database: str | None = None) -> None:
    """Rebuild the whole published table from the staged data."""
    publish_table(spark, read_stage(spark, root, table), root, table, rebuild=True, database=database)


# --- marts ------------------------------------------------------------------

def account_summary_job(spark: SparkSession, root: str, exact: bool = False) -> str:
    t = {n: read_transformed(spark, root, n) for n in
         ("account", "transaction", "order", "disposition", "card")}
    fn = marts.account_summary_exact if exact else marts.account_summary
    out = fn(t["account"], t["transaction"], t["order"], t["disposition"], t["card"])
    return publish.write_mart(out, _p(root, "analysis", "account_summary" + ("_exact" if exact else "")))


def customer_master(spark: SparkSession, root: str, exact: bool = False, schemas: dict | None = None) -> DataFrame:
    """Customer master over the published layout."""
    t = {n: read_transformed(spark, root, n, (schemas or {}).get(n)) for n in ("client", "disposition", "account", "transaction")}
    fn = marts.customer_master_exact if exact else marts.customer_master
    return fn(t["client"], t["disposition"], t["account"], t["transaction"])


def customer_master_job(spark: SparkSession, root: str, exact: bool = False) -> str:
    return publish.write_mart(customer_master(spark, root, exact),
                              _p(root, "analysis", "customer_master" + ("_exact" if exact else "")))


def customer_summary(spark: SparkSession, root: str, year: int, month: int, exact: bool = True,
                     schemas: dict | None = None) -> DataFrame:
    """Period summary over the published layout.  Transaction and loan folders
    are pruned by (year, month) where all rows are known to lie in the folder
    that their date names, and otherwise by the recorded dates of every
    folder; without records the date alone decides (Parquet statistics skip
    row groups)."""
    t = {n: read_transformed(spark, root, n, (schemas or {}).get(n)) for n in
         ("client", "disposition", "account", "district", "transaction", "loan")}
    fn = marts.customer_summary_exact if exact else marts.customer_summary
    places = {n: _p(root, "transformed", n) for n in ("transaction", "loan")}
    agree = all(publish.periods_agree(spark, place) for place in places.values())
    if not agree:
        start = datetime.date(*validate_period(year, month), 1)
        end = (start + datetime.timedelta(days=31)).replace(day=1) if exact and year < 9999 else None
        for n, place in places.items():
            dated = zones.within(spark, place, PARTITIONS[n], start, end)
            if dated is not None:
                t[n] = t[n].where(dated)
    return fn(t["client"], t["disposition"], t["account"], t["district"], t["transaction"],
              t["loan"], year, month, period_cols=("year", "month") if agree else None)


def customer_summary_export_job(spark: SparkSession, root: str, year: int, month: int,
                                put_batch: object | Callable[[list[dict]], None] | None = None) -> DataFrame:
    """Keyed export of the month's summary: an upsert into the versioned
    export table, and optionally batched puts to an external store from the
    executors or another store (``operators.store``)."""
    items = export.summary_items(customer_summary(spark, root, year, month, exact=True))
    table = export.upsert_keyed(spark, items, _p(root, "export", "customer_summary"), periods=[period_literal(year, month)])
    if put_batch is not None:
        # Send the committed rows of this period (a scan), not a recomputation.
        export.export_to_store(table.where(F.col(export.PERIOD_COL) == period_literal(year, month)), put_batch)
    return table


JOBS = {
    "stage": stage_job,
    "ingest": ingest_job,
    "publish_daily": publish_daily_job,
    "publish_stream": publish_stream_job,
    "publish_firstday": publish_firstday_job,
    "register": register_job,
    "account_summary": account_summary_job,
    "customer_master": customer_master_job,
    "customer_summary_export": customer_summary_export_job,
}


def main(argv: list[str] | None = None) -> None:
    from ledgerlake.session import CLUSTER_CONF, build_session

    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--root", required=True)
    ap.add_argument("--table", choices=sorted(MAPPINGS))
    ap.add_argument("--year", type=int)
    ap.add_argument("--month", type=int)
    ap.add_argument("--exact", action="store_true")
    ap.add_argument("--compat-append", action="store_true")
    ap.add_argument("--archive", action="store_true", help="ingest: archive processed landing files")
    ap.add_argument("--publish", action="store_true", help="ingest: publish each micro-batch's periods")
    ap.add_argument("--database", default=None, help="enter what is written in this database of the catalogue")
    ap.add_argument("--master", default=None, help="omit on a cluster (launcher decides)")
    args = ap.parse_args(argv)
    spark = build_session(master=args.master, shuffle_partitions=None,
                          extra=CLUSTER_CONF if args.master is None else None)
    if args.job == "ingest":
        result = ingest_job(spark, args.root, args.table, args.archive, args.publish)
    elif args.job in ("stage", "publish_firstday"):
        result = JOBS[args.job](spark, args.root, args.table, database=args.database)
    elif args.job in ("publish_stream", "register"):
        result = JOBS[args.job](spark, args.root, args.table)
    elif args.job == "publish_daily":
        result = publish_daily_job(spark, args.root, args.table, args.compat_append, args.database)
    elif args.job in ("account_summary", "customer_master"):
        result = JOBS[args.job](spark, args.root, args.exact)
    else:
        customer_summary_export_job(spark, args.root, args.year, args.month)
        result = "ok"
    print(json.dumps({"job": args.job, "result": result}, default=str))


if __name__ == "__main__":
    main()
