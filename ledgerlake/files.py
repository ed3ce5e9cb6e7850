"""Small file-system steps beside Spark's reads and writes.

Listing names, deleting a folder and creating a file only where there is none
go through the file system that Spark itself uses for a path (its Hadoop
client), so any store that Spark can write works.  This is the only module
that reaches for that client; it needs a classic session (not Spark Connect).
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    try:
        context = spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(context._jsc.hadoopConfiguration())
    except Exception as error:
        raise RuntimeError(f"no file system for {path}: this step needs a classic Spark session") from error


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where it does not exist."""
    place, system = _system(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _system(spark, path)
    return bool(system.exists(place))


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False where there was none."""
    place, system = _system(spark, path)
    return bool(system.delete(place, True))


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with ``text`` unless it exists; False where it does.
    Of two callers one succeeds (on stores with an exclusive create)."""
    place, system = _system(spark, path)
    if system.exists(place):
        return False
    try:
        out = system.create(place, False)
    except Exception as error:  # raised on the JVM side: the other caller was first
        if "AlreadyExists" in str(error):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def create_lines(spark: SparkSession, path: str, rows: list[dict]) -> bool:
    """``create`` with a JSON line per row."""
    return create(spark, path, "".join(json.dumps(row) + "\n" for row in rows))
