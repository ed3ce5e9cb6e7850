"""Connected components of a link table, wholly on the executors.

Alternating large-star / small-star contraction: every step is a grouped
minimum (combined map-side, so a hub node is cheap) and one join back, cut by
a table written to the shared folder.  Neither links nor labels reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import fresh_dir


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A class with more than this part of all rows is joined apart (so there are fewer than 1000).
_HOT = 1000


def join_classes(rows: DataFrame, classes: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` joined to their class by ``keys``, a class being one row of
    ``classes`` with its number of rows in ``copies``.  The few classes that
    hold a large part of all rows are broadcast, so that no task gets a whole
    group of copies; every row must have a class."""
    hot = classes.where(F.col("copies") * _HOT > F.lit(total))
    some = F.broadcast(hot.select(keys))
    light = rows.join(some, keys, "left_anti").join(classes.join(some, keys, "left_anti"), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(light)


def connected_components(spark: SparkSession, links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``links`` (a, b), any orientation -> (id, component_id), one row per id
    that has a link; component_id is the smallest reachable id.

    Self links, nulls and repeated links do not matter.  Raises when the
    rounds do not suffice (they grow with the logarithm of the diameter).
    """
    edges = (links.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = written(spark, edges, "cc")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    for _ in range(most_rounds):
        # done when every node has one parent and no parent has one
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_nodes = (ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
                      .where("up > 1 or (up = 1 and down = 1)"))
        if open_nodes.isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        large = written(spark, large.distinct(), "cc")
        # small star: the node and its smaller neighbours go to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = (large.join(least, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))))
        edges = written(spark, small.distinct(), "cc")
    raise RuntimeError(f"not done after {most_rounds} rounds")
