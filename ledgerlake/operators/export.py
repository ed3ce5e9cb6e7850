"""Keyed export of the customer summary.

The key-value semantics "one put per item replaces any item with the same
key" become a keyed upsert written by Spark: rows of the current version
whose key is in the batch are dropped (anti join), the batch is added, and
the result is written as a *new* version of the touched periods -- a plan
never overwrites the path it reads, and a month's export costs that month,
not the table's history.  A manifest file per version names the folders of
its periods, relative to the root; creating it (only where there is none)
commits the version, so of two writers one is refused before its commit.
Readers take the latest version of each period.

Items for an external store are sent by ``ledgerlake.operators.store``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ledgerlake import files
from ledgerlake.functions.scalars import exact_decimal
from ledgerlake.operators.store import export_to_store  # noqa: F401  (part of the export)

MANIFEST_SCHEMA = T.StructType([T.StructField("period", T.StringType(), False),
                                T.StructField("version", T.LongType(), False),
                                T.StructField("path", T.StringType(), False)])

SUMMARY_KEYS = ("client_id", "account_id", "pdate")
PERIOD_COL = "pdate"
# Folder column of a version: the period again, so that the files keep the period itself.
_FOLDER_COL = "p"


def summary_items(summary: DataFrame) -> DataFrame:
    """Row -> item projection: 14 attributes, money as exact decimals (wide
    enough for any total)."""
    return summary.select(
        "client_id", "age", "sex", "email", "phone", "address_1", "account_id", "frequency",
        "branch", "total_transactions",
        exact_decimal("total_spent", 38).alias("total_spent"),
        exact_decimal("total_loan_amount", 38).alias("total_loan_amount"),
        "total_loans", "pdate")


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # an unreadable manifest is not an empty table
            raise
        return None


def _next_version(spark: SparkSession, root: str) -> int:
    """One more than the greatest version that was ever begun to be committed
    (a writer that died while creating its manifest file used its number)."""
    used = [int(m[1]) for m in (re.fullmatch(r"v(\d+)\.json", n) for n in files.names(spark, f"{root}/_manifest")) if m]
    return 1 + max(used, default=0)


def _commit(spark: SparkSession, root: str, version: int, folders: dict[str, str]) -> None:
    rows = [{"period": p, "version": version, "path": path} for p, path in folders.items()]
    if not files.create_lines(spark, f"{root}/_manifest/v{version:08d}.json", rows):
        raise RuntimeError(f"version {version} of {root} was committed by another export meanwhile; "
                           "nothing was committed, run this one again")


def current_versions(spark: SparkSession, root: str) -> dict[str, tuple[int, str]]:
    """Latest committed (version, path below the root) per period -- one row per period."""
    manifest = _manifest(spark, root)
    if manifest is None:
        return {}
    latest = manifest.groupBy("period").agg(F.max(F.struct("version", "path")).alias("v"))
    return {r["period"]: (int(r["v"]["version"]), r["v"]["path"]) for r in latest.collect()}


def _read_periods(spark: SparkSession, root: str, versions: dict[str, tuple[int, str]], periods,
                  schema: T.StructType | None) -> DataFrame | None:
    """Rows of the given periods, each from the folder of its current version, in one read."""
    paths = sorted(f"{root}/{versions[p][1]}" for p in periods if p in versions)
    if not paths:
        return None
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(*paths)


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    root = root.rstrip("/")
    versions = current_versions(spark, root)
    return _read_periods(spark, root, versions, versions.keys(), schema)


def batch_profile(df: DataFrame, keys: Sequence[str], period_col: str) -> tuple[int, list[str | None]]:
    """Largest number of rows sharing a key, and the batch's distinct periods
    (bounded by the number of periods), from one aggregate."""
    row = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.max("_n").alias("n"), F.collect_set(F.struct(period_col)).alias("periods"))).first()
    return int(row["n"] or 0), sorted((p[0] for p in row["periods"] or []), key=lambda p: (p is not None, p))


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"batch has several rows for key {dup[0].asDict()}")


def upsert_keyed(spark: SparkSession, batch: DataFrame, root: str,
                 keys: Sequence[str] = SUMMARY_KEYS, period_col: str = PERIOD_COL,
                 check_unique: bool = True, periods: Sequence[str] | None = None) -> DataFrame:
    """Replace-or-insert ``batch`` into the keyed table at ``root``.

    The period column is part of the key, so only periods present in the
    batch can change: their current rows minus the batch's keys, plus the
    batch, are written as a new version, one folder per period; untouched
    periods are neither read nor rewritten.  The version's manifest file
    commits it; a failed run leaves an unreferenced folder and the previous
    state intact.  ``periods`` names the batch's periods where
    the caller knows them; a batch into periods that the table lacks is then
    written straight away.  The version is checked before it is committed: a
    row without a period, of another period than named, or with a key that
    occurs twice is refused (ValueError).

    Several writers are safe: a version that someone else has committed
    meanwhile makes the commit fail (RuntimeError) and leaves the other's in
    place.  Keys compare NULL-safely.  Returns the read-back of the whole table.
    """
    if period_col not in keys:
        raise ValueError("the period column must be part of the key")
    root = root.rstrip("/")
    version = _next_version(spark, root)   # before the versions it builds on
    versions = current_versions(spark, root)
    run = uuid.uuid4().hex[:12]    # retries after a failure never reuse a folder
    if periods is None or any(p in versions for p in periods):
        # The batch is read twice below: staged as a written table, computed once.
        staged = f"{root}/_staging/v{version:08d}-{run}"
        batch.write.mode("overwrite").parquet(staged)
        batch = spark.read.schema(batch.schema).parquet(staged)
        _check_batch(batch, keys, period_col, check_unique, periods)
    if periods is None:
        periods = [r[0] for r in batch.select(period_col).distinct().collect()]
    if bad := [p for p in periods if not re.fullmatch(r"[\w-]+", p)]:
        raise ValueError(f"periods {bad} cannot name a folder")
    current = _read_periods(spark, root, versions, periods, batch.schema)
    merged = batch
    if current is not None:
        new_keys = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        cond = [current[k].eqNullSafe(new_keys[f"_k_{k}"]) for k in keys]
        merged = current.join(new_keys, cond, "left_anti").unionByName(batch)
    target = f"data/v{version:08d}-{run}"
    (merged.withColumn(_FOLDER_COL, F.col(period_col)).hint("rebalance", _FOLDER_COL).write.mode("errorifexists")
     .partitionBy(_FOLDER_COL).parquet(f"{root}/{target}"))
    if current is None and not any(p in versions for p in periods):
        _check_batch(spark.read.schema(batch.schema).parquet(f"{root}/{target}"), keys, period_col, check_unique, periods)
    made = set(files.names(spark, f"{root}/{target}"))   # a named period may have no rows
    written = {p: f"{target}/{_FOLDER_COL}={p}" for p in sorted(periods) if f"{_FOLDER_COL}={p}" in made}
    if written:
        _commit(spark, root, version, written)
    versions.update({p: (version, path) for p, path in written.items()})
    return _read_periods(spark, root, versions, versions.keys(), batch.schema)


def _check_batch(df: DataFrame, keys, period_col: str, check_unique: bool, periods) -> None:
    most, found = batch_profile(df, keys, period_col)
    if None in found:
        raise ValueError("rows without a period cannot be exported")
    if periods is not None and set(found) - set(periods):
        raise ValueError(f"the batch holds periods {sorted(set(found) - set(periods))} that were not named")
    if check_unique and most > 1:
        assert_unique_keys(df, keys)          # raises, naming one duplicated key


def remove_superseded(spark: SparkSession, root: str) -> int:
    """Delete the staged batches and the version folders that no period uses
    any more; returns how many.  Folders are compared by their names below the
    root, so any spelling of the root will do.  Not while an export or a
    reader of an older version runs.  Refuses (ValueError) a manifest with a
    path that is not a version folder below the root."""
    root = root.rstrip("/")
    used = set()
    for _, path in current_versions(spark, root).values():
        place = re.fullmatch(r"data/([^/]+)/[^/]+", path)
        if place is None:
            raise ValueError(f"{path!r} in the manifest of {root} is not a folder below it; nothing was deleted")
        used.add(place[1])
    removed = 0
    for part in ("data", "_staging"):
        for name in files.names(spark, f"{root}/{part}"):
            if part == "_staging" or name not in used:
                removed += files.delete(spark, f"{root}/{part}/{name}")
    return removed
