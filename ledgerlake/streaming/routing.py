"""Routing of landing object keys to the job that handles them.

A key ``raw_data/<table>/...`` starts the staging load of <table>; a key
``stage_data/<table>/...`` starts the daily publish of <table>.  Keys are
URL-decoded first (``+`` is a space).  Anything with two parts or fewer,
or another first part, is not routed.  Pure column expressions, so routing
a manifest of millions of keys is one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import decode_object_key
from ledgerlake.schemas import MAPPINGS, PARTITIONS, RAW_PREFIX, STAGE_PREFIX


def landing_route(keys: DataFrame, key_col: str = "key") -> DataFrame:
    decoded = decode_object_key(key_col)
    parts = F.split(decoded, "/", -1)
    layer = F.element_at(parts, 1)
    routed = (F.size(parts) > 2) & layer.isin(RAW_PREFIX, STAGE_PREFIX)
    table = F.when(routed, F.element_at(parts, 2))
    action = (F.when(routed & (layer == RAW_PREFIX), F.lit("stage"))
              .when(routed & (layer == STAGE_PREFIX), F.lit("publish_daily")))
    known = (F.when(action == "stage", table.isin(*sorted(MAPPINGS)))
             .when(action == "publish_daily", table.isin(*sorted(PARTITIONS)))
             .otherwise(F.lit(False)))
    return keys.select(
        F.col(key_col).alias("key"), decoded.alias("decoded_key"), layer.alias("layer"),
        table.alias("table_name"), action.alias("action"), routed.alias("accepted"),
        known.alias("job_exists"))
