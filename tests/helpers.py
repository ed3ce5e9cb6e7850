"""Small-table builders and comparison helpers for the tests."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.schemas import mapping_for

D = dt.date
TS = dt.datetime


def bank_df(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    """A transformed bank table from partial rows (missing attributes NULL)."""
    schema = mapping_for(table).target_schema()
    names = [f.name for f in schema.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, f"{round(v, 6):.6f}")
    return (1, str(v))


def norm_row(r) -> tuple:
    out = []
    for v in r:
        if isinstance(v, float) and not math.isnan(v):
            v = round(v, 6)
        out.append(v)
    return tuple(out)


def rows(df: DataFrame, cols: list[str] | None = None) -> list[tuple]:
    cols = cols or df.columns
    got = [norm_row(tuple(r[c] for c in cols)) for r in df.collect()]
    return sorted(got, key=lambda t: tuple(_key(v) for v in t))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    assert sorted(a.columns) == sorted(b.columns), (a.columns, b.columns)
    cols = sorted(a.columns)
    return rows(a, cols) == rows(b, cols)


def equals_dicts(df: DataFrame, expected: list[dict]) -> bool:
    """Whether the rows of ``df`` are those of a plain list of dicts."""
    cols = sorted(df.columns)
    want = sorted((norm_row(tuple(e[c] for c in cols)) for e in expected), key=lambda t: tuple(_key(v) for v in t))
    return rows(df, cols) == want


def string_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])
