"""Items sent to a store outside Spark, as a batch sink.

``export_to_store`` writes a DataFrame through a Python data source: every
task hands its rows to the store in batches and reports its attempt in a
commit message; when all tasks are done the store publishes exactly the
attempts that reported, and after a failure it discards them.  Nothing but
names of attempts reaches the driver.

A store is any picklable object with

    put(attempt, items)   a batch of items (dicts) of one task attempt
    publish(attempts)     all tasks are done; these attempts count
    discard(attempts)     the write failed; these attempts had finished

or a plain function of a list of items, for a key-value store whose put
replaces an item: a repeated task then sends its items again, which changes
nothing.  ``FolderStore`` is a store in a folder that all machines share.

NULL values are None, decimals stay exact.  An empty DataFrame publishes no
attempt that holds an item.  Rows that repeat a key are sent as they come.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Sequence

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ledgerlake import files

# Stores and the sink go to the tasks whole: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RUNS = "_runs"
_ITEMS = "items"
_RUN_SCHEMA = "run string, file string, n long"


class Attempt(WriterCommitMessage):
    """Commit message of a task: its attempt and the number of its items."""

    def __init__(self, name: str, items: int):
        self.name, self.items = name, items


class _Function:
    """A store made of a function that puts a batch of items."""

    def __init__(self, put_batch: Callable[[list[dict]], None]):
        self.put_batch = put_batch

    def put(self, attempt: str, items: list[dict]) -> None:
        self.put_batch(items)

    def publish(self, attempts: list[Attempt]) -> None:
        pass

    def discard(self, attempts: list[Attempt]) -> None:
        pass


def _sink(format_name: str, store, batch_size: int) -> type[DataSource]:
    """The data source that writes to ``store``."""

    class Writer(DataSourceArrowWriter):
        def write(self, iterator):
            name, sent, buffer = uuid.uuid4().hex, 0, []
            for batch in iterator:
                for at in range(0, batch.num_rows, batch_size):
                    buffer += batch.slice(at, batch_size).to_pylist()
                    while len(buffer) >= batch_size:
                        store.put(name, buffer[:batch_size])
                        sent, buffer = sent + batch_size, buffer[batch_size:]
            if buffer:
                store.put(name, buffer)
            return Attempt(name, sent + len(buffer))

        def commit(self, messages):
            store.publish([m for m in messages if m is not None])

        def abort(self, messages):
            store.discard([m for m in messages if m is not None])

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def writer(self, schema, overwrite):
            return Writer()

    return Sink


def export_to_store(df: DataFrame, store, batch_size: int = 25) -> None:
    """Send every row as an item to ``store`` (see the module), in batches of
    at most ``batch_size`` from the tasks; publishes when all are done."""
    if batch_size < 1:
        raise ValueError("a batch holds at least one item")
    if not hasattr(store, "publish"):
        store = _Function(store)
    name = f"items_{uuid.uuid4().hex}"   # a write of its own, beside others of the session
    df.sparkSession.dataSource.register(_sink(name, store, batch_size))
    df.write.format(name).mode("append").save()


class FolderStore:
    """A keyed store of JSON items in a shared folder.

    Batches are files of the attempt that put them; a run's record of its
    attempts publishes them, so items of lost or repeated attempts are never
    read.  A later run's put replaces items with the same key
    (:meth:`items`).  Runs that overlap are both published, in the order of
    their numbers and names."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        number = 1 + len(files.names(spark, f"{self.root}/{_RUNS}"))
        self.run = f"{number:08d}-{uuid.uuid4().hex[:8]}"

    def _place(self, *parts: str):
        uri = "/".join([self.root, *parts])
        if uri.startswith("file:"):   # file:/x and file:///x alike
            uri = "/" + uri[5:].lstrip("/")
        return fs.FileSystem.from_uri(uri)

    def _write(self, text: str, *parts: str) -> None:
        system, path = self._place(*parts)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path) as out:
            out.write(text.encode())

    def put(self, attempt: str, items: list[dict]) -> None:
        lines = "".join(json.dumps(item, default=str) + "\n" for item in items)
        self._write(lines, _ITEMS, self.run, attempt, f"{uuid.uuid4().hex}.json")

    def publish(self, attempts: list[Attempt]) -> None:
        lines = "".join(json.dumps({"run": self.run, "file": a.name, "n": a.items}) + "\n" for a in attempts)
        self._write(lines, _RUNS, f"{self.run}.json")

    def discard(self, attempts: list[Attempt]) -> None:
        system, path = self._place(_ITEMS, self.run)
        if system.get_file_info(path).type != fs.FileType.NotFound:
            system.delete_dir(path)

    @staticmethod
    def items(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
        """The published items, of equal keys (NULLs are equal) the latest run's."""
        root = root.rstrip("/")
        if not files.names(spark, f"{root}/{_RUNS}") or not files.exists(spark, f"{root}/{_ITEMS}"):
            return spark.createDataFrame([], schema)
        published = spark.read.schema(_RUN_SCHEMA).json(f"{root}/{_RUNS}").where("n > 0").select("run", "file")
        put = (spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{root}/{_ITEMS}")
               .select(F.struct(*schema.names).alias("_item"),
                       F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("file")))
        rows = put.join(published, "file")
        latest = rows.groupBy(*[F.col(f"_item.{k}").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.max_by("_item", "run").alias("_item"))
        return latest.select("_item.*")
