"""Sink properties: replace, period refresh idempotence, untouched periods,
empty batch, append, schema evolution, partition pruning."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import bank_df, rows
from ledgerlake.operators import publish
from ledgerlake.operators.filters import filter_date_from
from ledgerlake.session import fresh_dir
from ledgerlake.sources.tables import scan_partitioned_parquet

PARTS = ("year", "month")


def _acc(spark, specs):
    return bank_df(spark, "account", [
        {"account_id": a, "district_id": 1, "frequency": f, "parseddate": d,
         "year": d.year, "month": d.month, "day": d.day} for a, f, d in specs])


def test_refresh_period_replaces_only_batch_periods(spark):
    path = fresh_dir(spark, "t-pub")
    base = _acc(spark, [("A1", "m", dt.date(2018, 1, 5)), ("A2", "m", dt.date(2018, 1, 9)),
                        ("A3", "m", dt.date(2018, 2, 1))])
    publish.publish_rebuild(base, path, PARTS)
    batch = _acc(spark, [("A3", "w", dt.date(2018, 2, 1)), ("A4", "w", dt.date(2018, 2, 3))])
    publish.publish_refresh_period(batch, path, PARTS)
    once = rows(publish.read_back(spark, path, base.schema))
    publish.publish_refresh_period(batch, path, PARTS)          # re-run: no change
    twice = rows(publish.read_back(spark, path, base.schema))
    assert once == twice and len(once) == 4
    jan = publish.read_back(spark, path, base.schema).where("month = 1")
    assert sorted(r["account_id"] for r in jan.collect()) == ["A1", "A2"]   # untouched
    publish.publish_refresh_period(batch.limit(0), path, PARTS)             # empty batch
    assert rows(publish.read_back(spark, path, base.schema)) == once


def test_append_duplicates_on_rerun(spark):
    path = fresh_dir(spark, "t-app")
    batch = _acc(spark, [("A1", "m", dt.date(2018, 1, 5))])
    publish.publish_append(batch, path, PARTS)
    publish.publish_append(batch, path, PARTS)
    assert publish.read_back(spark, path, batch.schema).count() == 2


def test_full_refresh_and_snapshot_replace(spark):
    path = fresh_dir(spark, "t-full")
    a = _acc(spark, [("A1", "m", dt.date(2018, 1, 5)), ("A2", "m", dt.date(2018, 1, 6))])
    publish.stage_full_refresh(a, path)
    publish.stage_full_refresh(a.limit(1), path)
    assert spark.read.parquet(path).count() == 1
    publish.publish_rebuild(a, path + "-p", PARTS)
    publish.publish_rebuild(a.where("account_id = 'A2'"), path + "-p", PARTS)
    assert [r["account_id"] for r in publish.read_back(spark, path + "-p", a.schema).collect()] == ["A2"]


def test_schema_evolution_adds_column(spark):
    path = fresh_dir(spark, "t-evo")
    old = _acc(spark, [("A1", "m", dt.date(2018, 1, 5))]).drop("frequency")
    publish.publish_evolving(spark, old, path, PARTS)
    new = _acc(spark, [("A2", "w", dt.date(2018, 2, 5))]).withColumn("segment", F.lit("retail"))
    out = publish.publish_evolving(spark, new, path, PARTS)
    got = {r["account_id"]: r for r in out.collect()}
    assert got["A1"]["frequency"] is None and got["A1"]["segment"] is None
    assert (got["A2"]["frequency"], got["A2"]["segment"]) == ("w", "retail")
    # a later batch lacking a column still writes it (as NULL)
    out = publish.publish_evolving(spark, _acc(spark, [("A3", "x", dt.date(2018, 3, 1))]), path, PARTS)
    assert out.where("account_id = 'A3'").first()["segment"] is None


def test_period_scope_is_all_periods_of_batch(spark):
    batch = _acc(spark, [("A1", "m", dt.date(2018, 1, 5)), ("A2", "m", dt.date(2018, 2, 5)),
                         ("A3", "m", dt.date(2018, 2, 6))])
    assert rows(publish.period_scope(batch)) == [(2018, 1), (2018, 2)]


def test_filter_date_from_prunes_partitions(spark):
    path = fresh_dir(spark, "t-prune")
    a = _acc(spark, [("A1", "m", dt.date(2017, 12, 31)), ("A2", "m", dt.date(2018, 1, 1)),
                     ("A3", "m", dt.date(2019, 5, 1))])
    publish.publish_rebuild(a, path, PARTS)
    df = scan_partitioned_parquet(spark, path, schema=a.schema)
    out = filter_date_from(df, 2018, 1, "parseddate", PARTS)
    assert sorted(r["account_id"] for r in out.collect()) == ["A2", "A3"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_hot_period_is_split_over_several_files(spark):
    """A period holding most rows is written by several tasks (AQE splits the
    rebalance partition), not by one."""
    import os
    from ledgerlake.session import local_path
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(40000).select(
            F.col("id").cast("string").alias("account_id"),
            F.when(F.col("id") < 36000, F.lit(1)).otherwise(F.lit(2)).alias("month"),
            F.lit(2018).alias("year"))
        path = fresh_dir(spark, "t-hot-period")
        publish.publish_rebuild(df, path, PARTS)
        hot = os.path.join(local_path(path), "year=2018", "month=1")
        files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
        assert len(files) > 1
        assert spark.read.parquet(path).count() == 40000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_unclustered_write_skips_the_shuffle(spark):
    df = _acc(spark, [("A1", "m", dt.date(2018, 1, 5)), ("A2", "m", dt.date(2018, 2, 5))])
    assert "Rebalance" in publish._prepare(df, PARTS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" not in publish._prepare(df, PARTS, cluster=False)._jdf.queryExecution() \
        .optimizedPlan().toString()
    path = fresh_dir(spark, "t-uncl")
    publish.publish_rebuild(df, path, PARTS, cluster=False)
    assert publish.read_back(spark, path, df.schema).count() == 2
