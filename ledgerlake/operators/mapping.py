"""Declared schema mapping: select, rename, cast, drop the rest.

Values that do not convert (and doubles that are no amount: NaN, infinities,
10^15 and beyond) become NULL and are counted per target column while the data
flows (``DataFrame.observe``), so the reject counts cost no extra scan; they
are available after the first action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import amount_test
from ledgerlake.schemas import Mapping, spark_type


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apply_mapping(df: DataFrame, mapping: Mapping,
                  observation: Observation | None = None) -> DataFrame:
    """Project ``df`` through ``mapping``; source columns are bound by name.

    With ``observation`` the reject count of every target column (source
    value present, converted value NULL) is recorded as a metric named after
    the column.
    """
    columns = set(df.columns)
    sources = [_quoted(src) if src in columns else "cast(null as string)" for src, _, _, _ in mapping.entries]
    names = [dst for _, _, dst, _ in mapping.entries]
    kinds = [kind for _, _, _, kind in mapping.entries]
    # Each value is converted once; the checks see it beside its source (text
    # needs none).  As SQL text, which is one call for all columns.
    checked = [i for i, kind in enumerate(kinds) if kind != "string"] if observation is not None else []
    beside = [f"_s{i}" for i in checked]
    out = df.selectExpr(*[f"{sources[i]} as _s{i}" for i in checked],
                        *[f"try_cast({c} as {spark_type(kind).simpleString()}) as _t{i}" for i, (c, kind) in enumerate(zip(sources, kinds))])
    out = out.selectExpr(*beside, *[
        f"case when {amount_test(f'_t{i}')} then _t{i} end as _t{i}" if kind == "double" else f"_t{i}" for i, kind in enumerate(kinds)])
    if observation is not None:
        out = out.observe(observation, *[
            F.expr(f"count_if({f'_s{i} is not null and _t{i} is null' if i in checked else 'false'}) as {_quoted(name)}")
            for i, name in enumerate(names)])
    return out.selectExpr(*[f"_t{i} as {_quoted(name)}" for i, name in enumerate(names)])


def reject_counts(observation: Observation) -> dict[str, int]:
    """Reject counts per target column (call after an action ran)."""
    return {k: int(v) for k, v in observation.get.items()}


def to_raw_strings(df: DataFrame, mapping: Mapping) -> DataFrame:
    """The landing form of a typed table: every mapped source column as text.

    Used to build raw inputs from typed tables; attributes ``df`` lacks are
    NULL strings.
    """
    cols = []
    columns = set(df.columns)
    for src, _st, dst, _dt in mapping.entries:
        value = F.col(f"`{dst}`").cast("string") if dst in columns else F.lit(None).cast("string")
        cols.append(value.alias(src))
    return df.select(*cols)
