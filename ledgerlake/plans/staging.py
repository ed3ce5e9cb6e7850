"""Raw -> stage: declared mapping, then a full-refresh staging load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerlake.operators.mapping import apply_mapping
from ledgerlake.operators.publish import read_back, stage_full_refresh
from ledgerlake.schemas import mapping_for


def stage_table(spark: SparkSession, raw: DataFrame, table: str, path: str,
                observation: Observation | None = None) -> DataFrame:
    """Map ``raw`` (columns bound by name) to the stage types of ``table``,
    replace the stage table at ``path`` and return its read-back."""
    mapping = mapping_for(table)
    stage_full_refresh(apply_mapping(raw, mapping, observation), path)
    return read_back(spark, path, mapping.target_schema())
