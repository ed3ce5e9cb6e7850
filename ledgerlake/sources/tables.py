"""Table scans: catalogue / path tables and partitioned Parquet roots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_table(spark: SparkSession, name: str, root: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A named table: the catalogue entry if one exists, else ``root/name``.

    Either way the result is a lazy scan, so projections and filters applied
    later are pushed into the reader by Catalyst.
    """
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if root is None:
        raise ValueError(f"table {name!r} is not registered and no root was given")
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")


def scan_partitioned_parquet(spark: SparkSession, root: str,
                             schema: T.StructType | None = None,
                             merge_schema: bool = False) -> DataFrame:
    """Read a partitioned Parquet root with partition discovery.

    Always the root (never ``root/*``): a glob makes the partition
    directories leaf tables, which breaks discovery.  Giving the declared
    schema keeps partition column types stable and skips inference.
    """
    reader = spark.read.option("basePath", root)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root)
