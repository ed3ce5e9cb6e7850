"""Sinks: staging loads and the published (period-partitioned) layer.

Every write goes through ``DataFrameWriter``; the overwrite mode decides
what is replaced:

* full refresh / rebuild / snapshot -- static overwrite of the whole path;
* period refresh -- dynamic partition overwrite: exactly the partitions
  present in the batch are replaced, the others are untouched, and a re-run
  of the same batch leaves the table unchanged;
* append -- adds rows (published behaviour of the daily job, where re-runs
  duplicate).

Before a partitioned write the rows are rebalanced on the partition
columns: AQE then splits a hot partition value over several tasks and packs
small ones together, so files are neither tiny nor huge.  Unpartitioned
writes add no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ledgerlake.operators import zones
from ledgerlake.sources.tables import scan_partitioned_parquet


def _prepare(df: DataFrame, partition_cols: Sequence[str], cluster: bool = True) -> DataFrame:
    # Partitioned writes: cluster rows by partition value, otherwise every task
    # writes a file into every partition it sees.  ``cluster=False`` skips that
    # shuffle for input already laid out by period (e.g. one landing file per
    # day).  Unpartitioned writes keep their input splits / AQE-sized shuffle
    # partitions (no extra shuffle).
    if partition_cols and cluster:
        return df.hint("rebalance", *partition_cols)
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_cols: Sequence[str] = (), dynamic: bool = False,
                  cluster: bool = True) -> str:
    writer = _prepare(df, partition_cols, cluster).write.mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.parquet(path)
    return path


def stage_full_refresh(df: DataFrame, path: str) -> str:
    """Staging load: replace the whole table with ``df``."""
    return write_parquet(df, path, "overwrite")


def publish_rebuild(df: DataFrame, path: str, partition_cols: Sequence[str],
                    cluster: bool = True, date_col: str | None = None) -> str:
    """First-day rebuild: replace every partition of the table.  With
    ``date_col`` the dates of every folder are recorded (``zones``)."""
    zones.recorded_write(df, path, partition_cols, date_col, "rebuild", lambda: write_parquet(
        df, path, "overwrite", partition_cols, dynamic=False, cluster=cluster))
    return path


def publish_refresh_period(df: DataFrame, path: str, partition_cols: Sequence[str],
                           cluster: bool = True, date_col: str | None = None) -> str:
    """Replace exactly the partitions present in ``df`` (idempotent).

    The batch must hold the complete content of each period it touches.
    An empty batch replaces nothing.  Without ``date_col`` a table that has
    zone records is no longer pruned by them (until it is rebuilt).
    """
    zones.recorded_write(df, path, partition_cols, date_col, "refresh", lambda: write_parquet(
        df, path, "overwrite", partition_cols, dynamic=True, cluster=cluster))
    return path


def publish_append(df: DataFrame, path: str, partition_cols: Sequence[str] = (), date_col: str | None = None) -> str:
    """Add the batch to the table (re-running duplicates rows); ``date_col``
    as for a refresh."""
    zones.recorded_write(df, path, partition_cols, date_col, "append", lambda: write_parquet(df, path, "append", partition_cols))
    return path


def publish_snapshot(df: DataFrame, path: str) -> str:
    """Unpartitioned full publish."""
    return write_parquet(df, path, "overwrite")


def write_mart(df: DataFrame, path: str) -> str:
    """Analysis mart: full replace, unpartitioned."""
    return write_parquet(df, path, "overwrite")


def period_scope(df: DataFrame, period_cols: Sequence[str] = ("year", "month")) -> DataFrame:
    """The distinct periods a batch touches (not one arbitrary row's)."""
    return df.select(*period_cols).distinct()


def publish_checked(spark: SparkSession, df: DataFrame, path: str, partition_cols: Sequence[str], date_col: str | None,
                    how: str = "refresh", cluster: bool = True, table: str | None = None) -> int:
    """Write a partitioned table (``how``: rebuild, refresh or append) with a
    zone record of the dates in every folder, made before the data is written
    (``ledgerlake.operators.zones``).  With ``table`` the catalogue's entry of
    that name learns the touched folders and new columns.  Returns how many
    rows lie in a folder that their date does not name; they stay as they are."""
    def write() -> None:
        if how == "append":
            write_parquet(df, path, "append", partition_cols)
        else:
            write_parquet(df, path, "overwrite", partition_cols, dynamic=how == "refresh", cluster=cluster)
    found = zones.recorded_write(df, path, partition_cols, date_col, how, write)
    if table is not None:
        update_catalogue(spark, table, path, df.schema, partition_cols,
                         period_scope(df, partition_cols) if how != "rebuild" else None)
    return sum(z["odd"] for z in found or [])


def periods_agree(spark: SparkSession, path: str) -> bool:
    """True when all rows are known to lie in the folder that their date names."""
    return zones.odd_rows(spark, path) == 0


SCHEMA_SIDECAR = "_table_schema"   # '_' prefix: ignored by the Parquet reader


def _sidecar(path: str) -> str:
    return f"{path.rstrip('/')}/{SCHEMA_SIDECAR}"


def write_table_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    (spark.createDataFrame([(schema.json(),)], "schema string")
     .coalesce(1).write.mode("overwrite").text(_sidecar(path)))


def existing_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's schema: from its sidecar (one small file), else -- for a
    table published without one -- merged from the Parquet footers."""
    try:
        row = spark.read.text(_sidecar(path)).first()
        if row is not None:
            return T.StructType.fromJson(json.loads(row[0]))
    except AnalysisException as error:
        _only_missing(error)
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as error:
        _only_missing(error, "UNABLE_TO_INFER_SCHEMA")
        return None


def _only_missing(error: AnalysisException, *more: str) -> None:
    """Raise unless the error says that there is nothing at the path yet."""
    if error.getCondition() not in ("PATH_NOT_FOUND", *more):
        raise error


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both and that files of
    either type can be read as (Parquet type widening); None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if T.DoubleType() in (a, b) and {a, b} <= {T.FloatType(), T.DoubleType(), *_WHOLE[:3]}:
        return T.DoubleType()
    if {a, b} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        sides = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[t], 0)
                 for t in (a, b) if isinstance(t, T.DecimalType) or t in _DIGITS]
        whole, scale = max(s[0] for s in sides), max(s[1] for s in sides)
        if len(sides) == 2 and whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    return None


def align_to_schema(df: DataFrame, table_schema: T.StructType | None) -> DataFrame:
    """Columns of the table first (missing ones as typed NULLs), then new
    ones.  Where the types differ the column gets the one that holds both, so
    the table may be widened by a batch (``publish_evolving`` and the daily
    publish keep the schema beside the data, and older files are read as the
    wider type).  Raises TypeError where no type holds both."""
    if table_schema is None:
        return df
    names = df.columns
    have = set(names)
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in table_schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        both = common_type(f.dataType, types[f.name])
        if both is None:
            raise TypeError(f"column {f.name}: the table has {f.dataType.simpleString()}, "
                            f"the batch {types[f.name].simpleString()}; nothing was written")
        cols.append(F.col(f.name) if types[f.name] == both else F.col(f.name).cast(both).alias(f.name))
    known = {f.name for f in table_schema.fields}
    cols += [F.col(c) for c in names if c not in known]
    return df.select(*cols)


def publish_evolving(spark: SparkSession, df: DataFrame, path: str,
                     partition_cols: Sequence[str], date_col: str | None = None) -> DataFrame:
    """Period refresh that lets the table gain columns and wider types.

    Columns the batch lacks are written as NULL; columns the table lacks are
    added, and older files read them as NULL; a column whose type the table
    cannot hold widens the table (int, long, decimal; float, double; date,
    timestamp), and older files are read as the wider type.  The table's
    schema is kept in a sidecar next to the data, written before the data (a
    wider schema reads the old files as well), so neither the write nor the
    read merges footers of the whole table.  ``date_col`` as for a refresh.
    Returns the read-back of the table.
    """
    aligned = align_to_schema(df, existing_schema(spark, path))
    write_table_schema(spark, path, aligned.schema)
    publish_refresh_period(aligned, path, partition_cols, date_col=date_col)
    # Reading with the declared superset schema: older files lack the new
    # columns and read them as NULL -- no footer merge over the whole table.
    return scan_partitioned_parquet(spark, path, schema=aligned.schema)


def _table_ddl(schema: T.StructType, names: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return ", ".join(f"`{n}` {types[n]}" for n in names)


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_cols: Sequence[str] = ()) -> None:
    """Enter a written table in the session's catalogue under ``name`` (or
    bring its partitions up to date): queries then read it by name."""
    if not spark.catalog.tableExists(name):
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({_table_ddl(schema, schema.names)}) USING parquet {parts} LOCATION '{place}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def update_catalogue(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_cols: Sequence[str] = (),
                     touched: DataFrame | None = None) -> None:
    """What a publish changed in the catalogue's entry ``name``: the folders of
    ``touched`` (one row each) are added and new columns appended, without
    listing the table.  A table that is not entered yet, that was rebuilt
    (``touched`` None) or whose column types changed is entered anew."""
    entered = spark.catalog.tableExists(name)
    known = {f.name: f.dataType for f in spark.table(name).schema.fields} if entered else {}
    if not entered or (touched is None and partition_cols) or any(known.get(f.name, f.dataType) != f.dataType for f in schema.fields):
        if entered:
            spark.sql(f"DROP TABLE {name}")   # of the entry only: the table is external
        register_table(spark, name, path, schema, partition_cols)
        return
    if new := [f.name for f in schema.fields if f.name not in known]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_table_ddl(schema, new)})")
    if partition_cols and touched is not None:
        folders = touched.select(*partition_cols).distinct().collect()   # as many as the batch has periods
        for i in range(0, len(folders), 200):
            specs = " ".join("PARTITION (" + ", ".join(
                f"`{c}`={'null' if r[c] is None else repr(r[c])}" for c in partition_cols) + ")" for r in folders[i:i + 200])
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(name)


def read_back(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return scan_partitioned_parquet(spark, path, schema=schema)
