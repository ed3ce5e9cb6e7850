"""Incremental intake of landing files with Structured Streaming.

A file stream over the landing folder (``binaryFile`` source with only the
path column selected, so file contents are not read by the stream itself)
yields the new files of each micro-batch; the checkpoint records which
files were taken, so every file is ingested once across runs.  Each
micro-batch reads its files by header name, applies the declared mapping
and writes its rows as partition ``ingest_batch=<id>`` (below the table's
period folders where batches are published) with dynamic overwrite -- a micro-batch replayed after a
failure replaces its own output instead of duplicating it.  The id holds the
stream's own id, which a new checkpoint changes, so batches of an earlier
stream are never replaced.  Counts of rejected values and ragged rows are
kept in ``_rejects`` beside the data, a file per batch that a replay replaces.

Small batches of periods that are over are put together by
``compact_ingested``: their rows are written as one batch, a record names the
batches it replaces, and only then their folders are deleted.  Readers go by
the records, so every row is read once at any moment.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import files
from ledgerlake.operators.mapping import apply_mapping, reject_counts
from ledgerlake.operators.publish import publish_checked, publish_snapshot
from ledgerlake.schemas import DATE_OF, PARTITIONS, mapping_for
from ledgerlake.sources.csv_landing import literal_path, scan_csv_by_name
from ledgerlake.sources.tables import scan_partitioned_parquet

BATCH_COL = "ingest_batch"
REJECTS = "_rejects"

# Fixed schema of Spark's binaryFile source (a stream needs it declared).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def ingest_landing(spark: SparkSession, landing_dir: str, table: str, stage_root: str,
                   checkpoint_dir: str, max_files_per_trigger: int = 1000,
                   file_glob: str = "*.csv", archive_dir: str | None = None,
                   publish_root: str | None = None, by_period: bool | None = None) -> None:
    """Ingest every landing file not yet ingested, then stop (availableNow).

    With ``archive_dir`` the file source moves processed files there
    (``cleanSource=archive``), so the landing folder -- listed on every
    trigger -- does not grow without bound.

    With ``publish_root`` every micro-batch is also published: for each
    period the batch touches (a short list), all ingested rows of that period
    replace the published period (dynamic overwrite), so the work follows the
    touched periods and a replay is idempotent.  Unpartitioned tables are
    republished whole.  ``by_period`` (default: only when publishing) puts the
    batch folders below the table's period folders, so that a refresh reads the
    touched periods only; one staging folder has one layout.
    """
    mapping = mapping_for(table)
    parts = PARTITIONS.get(table, ())
    if by_period is None:
        by_period = publish_root is not None
    folders = [*(parts if by_period else ()), BATCH_COL]

    def process(files: DataFrame, batch_id: int) -> None:
        # Only file names reach the driver, at most max_files_per_trigger; a listing
        # may name a file with escaped characters twice.
        paths = sorted({r["path"] for r in files.select("path").collect()})
        if not paths:
            return
        session = files.sparkSession
        batch = f"{_stream_id(session, checkpoint_dir)}-{batch_id:08d}"
        rejects, ragged = Observation(), Observation()
        raw = scan_csv_by_name(session, [literal_path(p) for p in paths], mapping.source_names, observation=ragged)
        staged = apply_mapping(raw, mapping, rejects).withColumn(BATCH_COL, F.lit(batch))
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*folders).parquet(stage_root))
        counts = {**reject_counts(rejects), **reject_counts(ragged)}
        _keep_rejects(session, stage_root, batch, counts)
        if publish_root is None:
            return
        ingested = read_ingested(session, table, stage_root)
        if not parts:
            publish_snapshot(ingested, publish_root)
            return
        mine = read_ingested(session, table, stage_root, keep_batch=True).where(F.col(BATCH_COL) == batch)
        periods = mine.select(*parts).distinct()
        touched = _of_periods(ingested, periods, parts)
        publish_checked(session, touched, publish_root, parts, DATE_OF.get(table))

    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", file_glob)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.load(landing_dir).select("path")
    query = (stream.writeStream.foreachBatch(process)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def _keep_rejects(spark: SparkSession, stage_root: str, batch: str, counts: dict[str, int]) -> None:
    """One small file per batch, by its id: a replay replaces its own counts.
    The new file is complete before the one it replaces goes."""
    folder = f"{stage_root.rstrip('/')}/{REJECTS}"
    before = [n for n in files.names(spark, folder) if n.startswith(f"{batch}.")]
    attempt = 1 + max((int(n.split(".")[1]) for n in before), default=0)
    files.create_lines(spark, f"{folder}/{batch}.{attempt}.json",
                       [{"ingest_batch": batch, "column": c, "rejects": n} for c, n in counts.items()])
    for name in before:
        files.delete(spark, f"{folder}/{name}")


def read_rejects(spark: SparkSession, stage_root: str) -> DataFrame:
    """(ingest_batch, column, rejects): what the batches rejected, each once
    (of a batch whose replay was cut short the later counts)."""
    rows = (spark.read.schema("ingest_batch string, column string, rejects long").json(f"{stage_root.rstrip('/')}/{REJECTS}")
            .withColumn("_attempt", F.regexp_extract(F.col("_metadata.file_name"), r"\.(\d+)\.json$", 1).cast("int")))
    return (rows.groupBy("ingest_batch", "column").agg(F.max_by("rejects", "_attempt").alias("rejects")))


def _stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """Id of the stream: kept in its checkpoint, new with a new one."""
    text = "".join(r.value for r in spark.read.text(f"{checkpoint_dir.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"]


def _of_periods(df: DataFrame, periods: DataFrame, parts) -> DataFrame:
    """Rows of the given periods.  The periods (a list bounded by the
    calendar) become literals, which prune folders, then an exact join."""
    found = periods.collect()
    pruned = df
    for i, c in enumerate(parts):
        values = sorted({r[i] for r in found if r[i] is not None})
        wanted = F.col(c).isin(values) if values else F.lit(False)
        if any(r[i] is None for r in found):
            wanted = wanted | F.col(c).isNull()
        pruned = pruned.where(wanted)
    names = periods.toDF(*[f"_p_{c}" for c in parts])
    return pruned.join(names, [pruned[c].eqNullSafe(names[f"_p_{c}"]) for c in parts], "left_semi")


def read_ingested(spark: SparkSession, table: str, stage_root: str,
                  keep_batch: bool = False) -> DataFrame:
    """All ingested rows; batches that a compaction replaced are left out, and
    so are those of a compaction that was not recorded (folders are pruned)."""
    schema = mapping_for(table).target_schema().add(BATCH_COL, "string")
    df = scan_partitioned_parquet(spark, stage_root, schema=schema).select(*schema.names)
    known = _compactions(spark, stage_root)
    if known is not None:
        replaced, made = known
        batch = F.col(BATCH_COL)
        df = df.where((~batch.startswith(_COMPACT) | batch.isin(sorted(made))) & ~batch.isin(sorted(replaced)))
    return df if keep_batch else df.drop(BATCH_COL)


_COMPACT = "compact-"
COMPACTIONS = "_compactions"


def _compactions(spark: SparkSession, stage_root: str) -> tuple[set[str], set[str]] | None:
    """Batches that were replaced, and the compacted batches that count; None
    where no compaction ever began."""
    folder = f"{stage_root.rstrip('/')}/{COMPACTIONS}"
    if not files.names(spark, folder):
        return None
    rows = spark.read.schema("made string, replaced string").json(folder).where("replaced is not null").collect()
    replaced = {r.replaced for r in rows}
    return replaced, {r.made for r in rows} - replaced


def compact_ingested(spark: SparkSession, table: str, stage_root: str, closed_before: tuple | None = None) -> list[str]:
    """Put the batches of an incremental staging folder together; returns the
    ids of the batches that were replaced (none if there was nothing to do).

    The last batch of every stream stays as it is: it is the one that the
    stream may replay, and a replay must find its own folder.  On the layout
    with period folders ``closed_before`` (values of the period parts) leaves
    out batches that touch that period or a later one.  Not while another
    compaction or a reader runs (its folders go); the stream may run.
    """
    root = stage_root.rstrip("/")
    parts = PARTITIONS.get(table, ())
    if not any(n.startswith(f"{c}=") for c in parts[:1] for n in files.names(spark, root)):
        parts = ()   # the layout without period folders
    rows = read_ingested(spark, table, stage_root, keep_batch=True)
    last = F.max(F.struct(*[F.col(c) for c in parts])).alias("last") if parts else F.lit(None).alias("last")
    found = rows.groupBy(BATCH_COL).agg(last).collect()   # a row per batch
    newest: dict[str, str] = {}
    for name in sorted(r[BATCH_COL] for r in found):
        newest[name.rpartition("-")[0]] = name
    old = [r[BATCH_COL] for r in found if r[BATCH_COL].startswith(_COMPACT) or newest[r[BATCH_COL].rpartition("-")[0]] != r[BATCH_COL]]
    if closed_before is not None and parts:
        open_ = {r[BATCH_COL] for r in found if r["last"] is None or any(v is None for v in r["last"]) or tuple(r["last"]) >= tuple(closed_before)}
        old = [b for b in old if b not in open_]
    if len(old) < 2:
        return []
    number = 1 + sum(n.endswith(".begun") for n in files.names(spark, f"{root}/{COMPACTIONS}"))
    if not files.create(spark, f"{root}/{COMPACTIONS}/v{number:08d}.begun"):
        raise RuntimeError(f"another compaction of {stage_root} runs")
    made = f"{_COMPACT}{number:08d}-{uuid.uuid4().hex[:8]}"
    folders = [*parts, BATCH_COL]
    together = rows.where(F.col(BATCH_COL).isin(old)).withColumn(BATCH_COL, F.lit(made))
    (together.hint("rebalance", *folders).write.mode("append").partitionBy(*folders).parquet(root))
    files.create_lines(spark, f"{root}/{COMPACTIONS}/v{number:08d}.json", [{"made": made, "replaced": b} for b in sorted(old)])
    for folder in _batch_folders(spark, root, parts, set(old)):
        files.delete(spark, folder)
    return sorted(old)


def _batch_folders(spark: SparkSession, root: str, parts, batches: set[str]):
    """Folders of the given batches, below the period folders where there are some."""
    level = [root]
    for part in parts:
        level = [f"{at}/{n}" for at in level for n in files.names(spark, at) if n.startswith(f"{part}=")]
    for at in level:
        for n in files.names(spark, at):
            if n.startswith(f"{BATCH_COL}=") and n.partition("=")[2] in batches:
                yield f"{at}/{n}"


def publish_on_stage_change(spark: SparkSession, stage_dir: str, table: str,
                            transformed_root: str, checkpoint_dir: str,
                            file_glob: str = "*.parquet") -> None:
    """Daily publish triggered by new staging files, then stop (availableNow).

    New files only signal that the staging table was rewritten; every
    micro-batch with new files publishes the *whole* current staging table
    (period refresh, or a snapshot for unpartitioned tables), so a staging
    write split over several micro-batches never publishes a partial period,
    and replays are idempotent.  Only the current staging table is published:
    a staging load replaced by another between two triggers is not (publish
    from the incremental staging, ``ingest_landing``, to keep every load).
    """
    schema = mapping_for(table).target_schema()
    parts = PARTITIONS[table]

    def process(files: DataFrame, batch_id: int) -> None:
        if files.isEmpty():
            return
        session = files.sparkSession
        current = session.read.schema(schema).parquet(stage_dir)
        if parts:
            publish_checked(session, current, transformed_root, parts, DATE_OF.get(table))
        else:
            publish_snapshot(current, transformed_root)

    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", file_glob)
              .load(stage_dir)
              .select("path"))
    query = (stream.writeStream.foreachBatch(process)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
