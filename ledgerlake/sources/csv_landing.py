"""CSV landing files, bound to columns by header name.

Landing files may list the same columns in different orders, carry extra
columns or miss some.  The first record of every file is its header; a small
table of headers (one row per file) says at which position of a file a wanted
column stands.  Headers are known before anything is written, so nothing is
read on trial.

The headers are read apart, from the beginning of every file only: a task per
file stops after the first record, quoted commas and line breaks included.
The data themselves are scanned once.

A row whose number of fields is not its header's is counted as ragged
(``observation``), its missing fields being NULL; a quoted line break splits a
row unless ``multi_line`` is set or the file's header has one, and shows as
ragged rows.  Files without any wanted column are refused.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import fresh_dir

# A comma outside quotes.
_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
RAGGED = "_ragged"


def literal_path(path: str) -> str:
    """A file's path as the reader takes it: glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _fields(line: Column) -> Column:
    return F.split(line, _COMMA, -1)


def _names(line: Column) -> Column:
    line = F.regexp_replace(F.regexp_replace(line, "^\ufeff", ""), "\r$", "")
    return F.transform(_fields(line), lambda x: F.lower(F.trim(F.regexp_replace(F.trim(x), '(?s)^"(.*)"$', "$1"))))


def _head_reader():
    """For a task: the first record of its file, which is the first line that
    is not blank and the lines after it while a quote is open.  Stops reading
    there.  An inner function goes to the tasks whole, so that they need no
    copy of this package."""
    def run(batches):
        lines: list[str] = []
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            name = batch.column("file")[0].as_py()
            if batch.column("start")[0].as_py():   # not the beginning of its file
                return
            for line in batch.column("value").to_pylist():
                if lines or line.strip("\ufeff \t\r"):
                    lines.append(line)
                    if "\n".join(lines).count('"') % 2 == 0:
                        yield pa.RecordBatch.from_pydict({"file": [name], "record": ["\n".join(lines)], "lines": [len(lines)]})
                        return
        if lines:
            yield pa.RecordBatch.from_pydict({"file": [name], "record": ["\n".join(lines)], "lines": [len(lines)]})
    return run


_first_record = _head_reader()

#: Lines that a task takes before it looks for the end of the header.
_HEAD_LINES = 16


def csv_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, names, lines): the lower-cased header fields of every file that
    has a line which is not blank, and the lines that the header takes.

    A small written table.  In a session of its own, so that every split is a
    task of its own and comes in small batches; tasks of later splits of a
    file end at once."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _HEAD_LINES)
    lines = apart.read.text(paths).select(F.col("_metadata.file_path").alias("file"),
                                          F.col("_metadata.file_block_start").alias("start"), "value")
    heads = (lines.mapInArrow(_first_record, "file string, record string, lines long")
             .select("file", _names(F.col("record")).alias("names"), "lines"))
    place = fresh_dir(spark, "csv-headers")
    heads.write.parquet(place)
    return spark.read.schema(heads.schema).parquet(place)


def scan_csv_by_name(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], with_file: bool = False,
                     observation: Observation | None = None, multi_line: bool = False, need_header: bool = False) -> DataFrame:
    """All rows of the CSV files under ``paths`` as string columns ``columns``.

    Columns are bound by header name in each file (case and outer blanks do
    not matter, the first of equal names counts); names a file lacks are
    NULL, names it has beyond ``columns`` are dropped.  Paths are globs; use
    :func:`literal_path` for the name of a file.  Raises ValueError for files
    that have none of the columns and, with ``need_header``, where no file has
    a header.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    wanted = list(columns)
    fields = [T.StructField(c, T.StringType(), True) for c in wanted]
    if with_file:
        fields.append(T.StructField("_source_file", T.StringType(), True))
    if not paths:
        return spark.createDataFrame([], T.StructType(fields))
    headers = csv_headers(spark, paths)
    known = F.expr(f"array({', '.join(_text(c.lower()) for c in wanted)})")
    facts = headers.agg(
        F.max(F.size("names")).alias("width"), F.collect_set(F.when(F.col("lines") > 1, F.col("file"))).alias("broken"),
        F.slice(F.collect_set(F.when(~F.arrays_overlap("names", known), F.col("file"))), 1, 5).alias("strange")).first()
    if facts.strange:
        raise ValueError("no wanted column in " + ", ".join(unquote(f) for f in facts.strange))
    width = facts.width or 0
    if not width:
        if need_header:
            raise ValueError(f"{', '.join(paths)} holds no header; nothing was read")
        return spark.createDataFrame([], T.StructType(fields))
    shape = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(width)]
                         + [T.StructField("_corrupt", T.StringType(), True)])

    def read(multi: bool) -> DataFrame:
        return (spark.read.schema(shape).option("header", True).option("mode", "PERMISSIVE").option("multiLine", multi)
                .option("columnNameOfCorruptRecord", "_corrupt").csv(paths))
    name = F.col("_metadata.file_path")
    if facts.broken and not multi_line:   # files whose header spans lines; a filter on the name leaves files out
        cols = [*[f"_c{i}" for i in range(width)], "_corrupt", name.alias("_file")]
        rows = (read(False).where(~name.isin(facts.broken)).select(*cols)
                .unionByName(read(True).where(name.isin(facts.broken)).select(*cols)))
    else:
        rows = read(multi_line).withColumn("_file", name)
    rows = rows.selectExpr(f"array({', '.join(f'_c{i}' for i in range(width))}) as values", "_corrupt", "_file")
    rows = rows.join(headers.drop("lines"), F.col("_file") == F.col("file"))
    count = F.when(F.col("_corrupt").isNull(), width).otherwise(F.size(_fields(F.col("_corrupt"))))
    if observation is not None:
        rows = rows.observe(observation, F.count_if(count != F.size("names")).alias(RAGGED))

    # as SQL text, which is one call for all columns
    out = [f"element_at(values, cast(nullif(array_position(names, {_text(c.lower())}), 0) as int)) as {_quoted(c)}" for c in wanted]
    if with_file:
        out.append("_file as _source_file")
    return rows.selectExpr(*out)
