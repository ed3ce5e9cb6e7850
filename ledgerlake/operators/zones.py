"""Zone records of a published table: the dates that every folder holds.

Beside a table partitioned by stored date parts lies ``_zones``.  A publish
leaves there

* ``v<n>.json`` -- before any data is written: a line per folder it touches
  with the least and the greatest date of the batch in it and the number of
  rows whose parts disagree with their date;
* ``v<n>.done`` -- after the data was written.

A publish that is done and replaced a folder sets what the folder holds; one
that appended, or that died before it was done, adds to it (its rows may be
there or not).  So the records never claim less than a folder holds, whatever
fails when.  A writer that doesn't know the dates leaves ``v<n>.unknown``,
which switches the records off until the next rebuild; a rebuild replaces the
table and its records.

From the records follows which folders hold no row of a range of dates, also
where rows lie in a folder that their date does not name.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import files

ZONES = "_zones"   # '_' prefix: ignored by the Parquet reader

_PART = {"year": F.year, "month": F.month, "day": F.day}
_SCHEMA = "publish long, kind string, parts string, folder string, lo date, hi date, odd long"


def _key(parts: Sequence[str]) -> Column:
    """The stored parts of a row as one text."""
    return F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("~")) for p in parts])


def _place(path: str) -> str:
    return f"{path.rstrip('/')}/{ZONES}"


def _states(spark: SparkSession, path: str) -> dict[int, str]:
    found: dict[int, str] = {}
    for name in files.names(spark, _place(path)):
        if m := re.fullmatch(r"v(\d+)\.(json|done|unknown)", name):
            found[int(m[1])] = "done" if m[2] == "done" else found.get(int(m[1]), m[2])
    return found


def folder_dates(df: DataFrame, parts: Sequence[str], date_col: str) -> list:
    """A row per folder of a batch: folder, lo, hi, odd.  As many as the batch
    has folders."""
    day, agrees = F.col(date_col).cast("date"), F.lit(True)
    for p in parts:
        agrees = agrees & F.col(p).eqNullSafe(_PART[p](F.col(date_col)))
    return df.groupBy(_key(parts).alias("folder")).agg(F.min(day).alias("lo"), F.max(day).alias("hi"),
                                                       F.count_if(~agrees).alias("odd")).collect()


def recorded_write(df: DataFrame, path: str, parts: Sequence[str], date_col: str | None, kind: str,
                   write: Callable[[], object]) -> list | None:
    """Run ``write`` (a rebuild, refresh or append of ``df``) with its zone
    record around it.  Returns the folders of the batch, None where no date
    column was named."""
    spark = df.sparkSession
    if not parts:
        write()
        return None
    if date_col is None:
        if kind != "rebuild" and (states := _states(spark, path)):
            files.create(spark, f"{_place(path)}/v{1 + max(states):08d}.unknown")
        write()
        return None
    if kind == "rebuild":  # replaces the records, too
        write()
    zones = folder_dates(df, parts, date_col)
    number = 1 + max(_states(spark, path), default=0)
    lines = [{"publish": number, "kind": kind, "parts": ",".join(parts), "folder": z["folder"], "odd": z["odd"],
              **{c: z[c].isoformat() for c in ("lo", "hi") if z[c] is not None}} for z in zones]
    if not files.create_lines(spark, f"{_place(path)}/v{number:08d}.json", lines):
        raise RuntimeError(f"another publish into {path} began at the same time")
    if kind != "rebuild":
        write()
    files.create(spark, f"{_place(path)}/v{number:08d}.done")
    return zones


def recorded(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> list | None:
    """What the folders hold: rows (folder, lo, hi, odd), a list bounded by
    the number of folders; None where that isn't known."""
    states = _states(spark, path)
    if not states or "unknown" in states.values():
        return None
    done = [n for n, state in states.items() if state == "done"]
    rows = spark.read.schema(_SCHEMA).json(f"{_place(path)}/*.json").where("folder is not null")
    if parts is not None:
        rows = rows.where(F.col("parts") == ",".join(parts))
    replaced = F.max(F.when((F.col("kind") != "append") & F.col("publish").isin(done), F.col("publish")))
    last = rows.groupBy("folder").agg(F.coalesce(replaced, F.lit(0)).alias("since"))
    return (rows.join(last, "folder").where("publish >= since").groupBy("folder")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("odd").alias("odd")).collect())


def odd_rows(spark: SparkSession, path: str) -> int | None:
    """Rows that lie in a folder their date does not name; None if unknown."""
    zones = recorded(spark, path)
    return None if zones is None else sum(z["odd"] for z in zones)


def within(spark: SparkSession, path: str, parts: Sequence[str], lo: dt.date | None = None,
           hi: dt.date | None = None) -> Column | None:
    """A filter on the stored parts that leaves out every folder known to hold
    no date of lo <= date < hi; None where nothing is known.  Folders without
    a record stay in."""
    zones = recorded(spark, path, parts)
    if zones is None:
        return None
    out = sorted(z["folder"] for z in zones if (lo is not None or hi is not None) and (
        z["hi"] is None or (lo is not None and z["hi"] < lo) or (hi is not None and z["lo"] >= hi)))
    return ~_key(parts).isin(out) if out else F.lit(True)
