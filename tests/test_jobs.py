"""End to end over a lake layout: landing CSV -> stage -> transformed ->
marts -> export, on the sf0.001 driver tables."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.catalog.queries import raw_table
from ledgerlake.plans import jobs, marts
from ledgerlake.schemas import MAPPINGS
from ledgerlake.session import fresh_dir
from ledgerlake.sources.binding import bank_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    root = fresh_dir(spark, "t-lake")
    b = bank_tables(spark, SF)
    for table in MAPPINGS:
        raw_table(b, table).write.option("header", True).csv(f"{root}/landing/{table}")
    rejects = {t: jobs.stage_job(spark, root, t) for t in MAPPINGS}
    for t in MAPPINGS:
        if t != "loan_portfolio":
            jobs.publish_firstday_job(spark, root, t)
    return root, b, rejects


def test_stage_rejects(lake):
    _, _, rejects = lake
    assert sum(rejects["account"].values()) == 0
    assert rejects["loan"]["amount"] > 0          # fractional amounts do not fit a long


def test_marts_over_published_layout(spark, lake):
    root, b, _ = lake
    jobs.account_summary_job(spark, root)
    jobs.customer_master_job(spark, root)
    got = spark.read.parquet(f"{root}/analysis/account_summary")
    want = marts.account_summary(b["account"], b["transaction"], b["order"], b["disposition"], b["card"])
    cols = ["total_transactions", "total_orders", "total_cards"]
    agg = [F.count(F.lit(1))] + [F.sum(c) for c in cols]
    assert got.agg(*agg).first() == want.agg(*agg).first()
    cm = spark.read.parquet(f"{root}/analysis/customer_master")
    cm_want = marts.customer_master(b["client"], b["disposition"], b["account"], b["transaction"])
    agg = [F.count(F.lit(1)), F.sum("total_in_cash_transaction"), F.sum("balance")]
    assert cm.agg(*agg).first() == cm_want.agg(*agg).first()


def test_daily_refresh_is_idempotent(spark, lake):
    root, _, _ = lake
    before = jobs.read_transformed(spark, root, "account").count()
    jobs.publish_daily_job(spark, root, "account")
    jobs.publish_daily_job(spark, root, "account")
    assert jobs.read_transformed(spark, root, "account").count() == before


def test_export_job_prunes_and_upserts(spark, lake):
    root, _, _ = lake
    summary = jobs.customer_summary(spark, root, 1998, 1)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    first = jobs.customer_summary_export_job(spark, root, 1998, 1)
    n = first.count()
    again = jobs.customer_summary_export_job(spark, root, 1998, 1)
    assert again.count() == n
    both = jobs.customer_summary_export_job(spark, root, 1998, 2)
    assert both.count() == 2 * n


def test_odd_date_parts_are_not_pruned_away(spark, tmp_path):
    """Rows whose stored year and month are missing or shifted still count."""
    from helpers import D, bank_df
    root = str(tmp_path)
    rows = [{"loan_id": "L", "account_id": "A", "amount": 7, "fulldate": D(2018, 1, 10), "year": y, "month": m, "day": d}
            for y, m, d in ((2018, 1, 10), (None, None, None), (2017, 12, 10), (2018, 2, 31))]
    jobs.publish_table(spark, bank_df(spark, "loan", rows), root, "loan", rebuild=True)
    target = f"{root}/transformed/loan"
    assert not jobs.publish.periods_agree(spark, target)
    assert jobs.read_transformed(spark, root, "loan").where("fulldate >= '2018-01-01'").count() == 4
    jobs.publish_table(spark, bank_df(spark, "loan", rows[:1]), root, "loan", rebuild=True)
    assert jobs.publish.periods_agree(spark, target)
    jobs.publish_table(spark, bank_df(spark, "loan", rows[2:3]), root, "loan", rebuild=False)
    assert not jobs.publish.periods_agree(spark, target)


def test_daily_publish_refuses_a_type_the_table_cannot_hold(spark, tmp_path):
    import pytest
    path = str(tmp_path / "t")
    jobs.publish.publish_evolving(spark, spark.sql("select 1 as a, 2018 as year, 1 as month"), path, ["year", "month"])
    with pytest.raises(TypeError):
        jobs.publish.publish_evolving(spark, spark.sql("select 'x' as a, 2018 as year, 2 as month"), path, ["year", "month"])
    assert [r.a for r in jobs.publish.read_back(spark, path).collect()] == [1]


def test_export_job_sends_committed_items(spark, lake, tmp_path):
    import os
    root, _, _ = lake
    out_dir = str(tmp_path)

    def put_batch(items):
        import json
        import uuid
        with open(os.path.join(out_dir, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(json.dumps([i["client_id"], i["account_id"], i["pdate"]]) for i in items))

    table = jobs.customer_summary_export_job(spark, root, 1998, 3, put_batch=put_batch)
    import json
    sent = []
    for name in os.listdir(out_dir):
        sent += [tuple(json.loads(line)) for line in open(os.path.join(out_dir, name)) if line.strip()]
    month = [(r["client_id"], r["account_id"], r["pdate"])
             for r in table.where(F.col("pdate") == "199803").collect()]
    assert sorted(sent) == sorted(month) and len(sent) > 0
