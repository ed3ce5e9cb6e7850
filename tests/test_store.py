"""Items sent to a store outside the tables: published attempts, retries, failures."""

import decimal
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.store import FolderStore, export_to_store
from ledgerlake.session import fresh_dir

KEYS = ["client_id", "pdate"]
SCHEMA = "client_id string, pdate string, total decimal(38,2), at date, n long"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _items(spark, n, offset=0):
    return (spark.range(n).select(F.concat(F.lit("C"), "id").alias("client_id"), F.lit("201801").alias("pdate"),
                                  (F.col("id") + F.lit(decimal.Decimal(offset) + decimal.Decimal("0.10"))).cast("decimal(38,2)").alias("total"),
                                  F.lit("2018-01-31").cast("date").alias("at"), F.col("id").alias("n")).repartition(5))


def test_later_put_replaces_items_of_equal_key(spark):
    root = fresh_dir(spark, "t-store")
    first, second = _items(spark, 60), _items(spark, 20, offset=10**20)
    export_to_store(first, FolderStore(spark, root), batch_size=7)
    export_to_store(second, FolderStore(spark, root), batch_size=7)
    export_to_store(spark.createDataFrame([(None, "201801", None, None, None)] * 2, SCHEMA), FolderStore(spark, root))
    want = _rows(first.where("n >= 20").union(second)) + [(None, "201801", None, None, None)]
    assert _rows(FolderStore.items(spark, root, first.schema, KEYS)) == sorted(want, key=str)


def test_no_items(spark):
    root = fresh_dir(spark, "t-store-empty")
    schema = _items(spark, 1).schema
    assert FolderStore.items(spark, root, schema, KEYS).collect() == []
    export_to_store(spark.createDataFrame([], schema), FolderStore(spark, root))
    assert FolderStore.items(spark, root, schema, KEYS).collect() == []
    with pytest.raises(ValueError):
        export_to_store(_items(spark, 1), FolderStore(spark, root), batch_size=0)


def test_a_failed_write_leaves_no_item(spark):
    root = fresh_dir(spark, "t-store-failed")
    good = _items(spark, 30)
    export_to_store(good, FolderStore(spark, root))
    bad = _items(spark, 30, offset=5).withColumn("n", F.when(F.col("n") == 29, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    failing = FolderStore(spark, root)
    with pytest.raises(Exception, match="lost"):
        export_to_store(bad, failing, batch_size=1)
    assert _rows(FolderStore.items(spark, root, good.schema, KEYS)) == _rows(good)
    export_to_store(_items(spark, 30, offset=5), FolderStore(spark, root))
    assert _rows(FolderStore.items(spark, root, good.schema, KEYS)) == _rows(_items(spark, 30, offset=5))


def test_items_of_a_lost_attempt_are_not_read(spark):
    root = fresh_dir(spark, "t-store-lost")
    store = FolderStore(spark, root)
    store.put("lost", [{"client_id": "X", "pdate": "201801"}])   # its task never reported
    export_to_store(_items(spark, 3), store)
    found = FolderStore.items(spark, root, _items(spark, 1).schema, KEYS)
    assert sorted(r.client_id for r in found.collect()) == ["C0", "C1", "C2"]


def test_attempts_publish_once_when_a_task_is_repeated(tmp_path):
    """A task that dies after some puts is run again; only its second attempt counts."""
    code = f"""
from ledgerlake.session import build_session
from ledgerlake.operators.store import FolderStore, export_to_store
spark = build_session(master="local[2, 3]", shuffle_partitions=2)

class Breaks(FolderStore):
    def put(self, attempt, items):
        import os
        FolderStore.put(self, attempt, items)
        try:
            os.close(os.open("{tmp_path}/once", os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return
        raise RuntimeError("first attempt")

df = spark.range(40).selectExpr("id as k", "id * 2 as v").repartition(1)
export_to_store(df, Breaks(spark, "{tmp_path}/store"), batch_size=10)
assert spark.read.json("{tmp_path}/store/items", recursiveFileLookup=True).count() == 50
found = FolderStore.items(spark, "{tmp_path}/store", df.schema, ["k"])
assert sorted((r.k, r.v) for r in found.collect()) == [(i, 2 * i) for i in range(40)]
print("right")
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                          env={**os.environ, "PYTHONPATH": repo}, cwd=str(tmp_path))
    assert "right" in done.stdout, done.stderr[-2000:]
