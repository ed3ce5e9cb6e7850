"""Plan shape: skew-safe joins, no Python or window in the marts, pushdown."""

from pyspark.sql import functions as F

from helpers import same_rows
from ledgerlake.catalog.queries import QUERIES
from ledgerlake.operators.joins import latest_rows, latest_value, left_join_hot_right

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_join_hot_right_equals_left_join(spark):
    left = spark.createDataFrame([(k,) for k in ["c1", "c2", "c3", None]], "client_id string")
    hot = [("c1", f"a{i}") for i in range(500)]
    right = spark.createDataFrame(hot + [("c2", "b"), (None, "z"), ("c9", "y")],
                                  "d_client string, account string")
    fast = left_join_hot_right(left, right, "client_id", "d_client")
    plain = left.join(right, left.client_id == right.d_client, "left")
    assert same_rows(fast, plain)
    assert fast.count() == 500 + 1 + 2          # c1 x500, c2, c3 and NULL unmatched


def test_latest_helpers(spark):
    df = spark.createDataFrame([("a", 1, 10.0, "t1"), ("a", 2, 20.0, "t2"), ("a", 2, 30.0, "t3"),
                                ("b", None, 5.0, "t4"), (None, 3, 1.0, "t5")],
                               "k string, ts int, bal double, id string")
    ties = sorted(r["id"] for r in latest_rows(df, "k", "ts").collect())
    assert ties == ["t2", "t3"]
    one = {r["k"]: r["bal"] for r in latest_value(df, "k", ["ts", "id"], "bal").collect()}
    assert one == {"a": 30.0}


def test_marts_have_no_python_and_no_window(spark):
    for name in ["account_summary", "account_summary_exact", "customer_master",
                 "customer_master_exact", "customer_summary", "customer_summary_exact"]:
        plan = _plan(QUERIES[name](spark, SF))
        assert "Python" not in plan and "ArrowEval" not in plan, name
        assert "Window" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(QUERIES["customer_summary"](spark, SF))
    lineitem = [ln for ln in plan.split("\n") if "lineitem.parquet" in ln][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_shipdate" in lineitem
    assert "l_shipdate" in lineitem.split("DataFilters:")[1]
    plan = _plan(QUERIES["filter_nonempty"](spark, SF).where(F.col("amount") > 100))
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,100.0)" in plan


def test_hot_right_key_is_split_by_aqe(spark):
    """With one client holding most dispositions, AQE splits the skewed
    partition of the inner half of ``left_join_hot_right``; a plain
    ``LEFT JOIN`` cannot be split (the skew is on its non-preserved side)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(200).select(F.col("id").cast("string").alias("client_id"))
        right = spark.range(60000).select(
            F.when(F.col("id") % 4 != 0, F.lit("7")).otherwise((F.col("id") % 200).cast("string"))
            .alias("d_client"), F.col("id").alias("account"))
        safe = left_join_hot_right(left, right, "client_id", "d_client")
        safe.collect()
        plain = left.join(right, left.client_id == right.d_client, "left")
        plain.collect()
        assert "SortMergeJoin(skew=true)" in _plan(safe)
        assert "skew=true" not in _plan(plain)
        assert same_rows(safe, plain)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_latest_balances_read_the_fact_once(spark):
    for name in ("customer_master", "latest_by_key", "self_join_latest"):
        df = QUERIES[name](spark, SF)
        df.collect()                      # the executed plan shows a reused exchange without its scan
        plan = _plan(df).split("== Initial Plan ==")[0]
        scans = [ln for ln in plan.split("\n") if "lineitem.parquet" in ln]
        assert len(scans) == 1, name
