"""Keyed export upsert, incremental landing intake, landing key routing."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerlake.operators import export
from ledgerlake.operators.export import export_to_store, read_current, upsert_keyed
from ledgerlake.session import fresh_dir, local_path
from ledgerlake.streaming.ingest import compact_ingested, ingest_landing, read_ingested, read_rejects
from ledgerlake.streaming.routing import landing_route

KEYS = ("client_id", "account_id", "pdate")


def _items(spark, data):
    return spark.createDataFrame(data, "client_id string, account_id string, pdate string, total double")


def test_upsert_replaces_and_inserts(spark):
    root = fresh_dir(spark, "t-export")
    upsert_keyed(spark, _items(spark, [("C1", "A1", "201801", 1.0), ("C2", "A2", "201801", 2.0),
                                       ("C3", None, "201801", 3.0)]), root, KEYS)
    out = upsert_keyed(spark, _items(spark, [("C2", "A2", "201801", 20.0),      # changed
                                             ("C3", None, "201801", 30.0),      # NULL key part
                                             ("C4", "A4", "201801", 4.0)]),     # new
                       root, KEYS)
    assert rows(out) == [("C1", "A1", "201801", 1.0), ("C2", "A2", "201801", 20.0),
                         ("C3", None, "201801", 30.0), ("C4", "A4", "201801", 4.0)]
    assert rows(read_current(spark, root, out.schema)) == rows(out)


def test_upsert_rejects_duplicate_keys(spark):
    root = fresh_dir(spark, "t-export-dup")
    with pytest.raises(ValueError):
        upsert_keyed(spark, _items(spark, [("C1", "A1", "201801", 1.0),
                                           ("C1", "A1", "201801", 2.0)]), root, KEYS)


def test_export_to_store_batches_on_executors(spark, tmp_path):
    out_dir = str(tmp_path)

    def put_batch(items):
        import uuid
        with open(os.path.join(out_dir, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(i["client_id"] for i in items))

    export_to_store(_items(spark, [(f"C{i}", "A", "201801", 1.0) for i in range(60)]).repartition(2),
                    put_batch, batch_size=25)
    sent = []
    for name in os.listdir(out_dir):
        sent += open(os.path.join(out_dir, name)).read().split("\n")
    assert sorted(sent) == sorted(f"C{i}" for i in range(60))


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_stream_ingests_each_file_once(spark):
    landing = local_path(fresh_dir(spark, "t-landing"))
    os.makedirs(landing)
    stage, ckpt = fresh_dir(spark, "t-stage"), fresh_dir(spark, "t-ckpt")
    _write(landing, "a.csv", "account_id,district_id,frequency,parseddate,year,month,day\n"
                             "A1,1,monthly,2017-12-30,2017,12,30\nA2,2,weekly,2017-12-30,2017,12,30\n")
    ingest_landing(spark, landing, "account", stage, ckpt)
    ingest_landing(spark, landing, "account", stage, ckpt)          # nothing new
    assert read_ingested(spark, "account", stage).count() == 2
    _write(landing, "b.csv", "day,month,year,parseddate,frequency,district_id,account_id\n"
                             "31,12,2017,2017-12-31,monthly,3,A3\n")
    ingest_landing(spark, landing, "account", stage, ckpt)
    got = {r["account_id"]: r for r in read_ingested(spark, "account", stage).collect()}
    assert sorted(got) == ["A1", "A2", "A3"]
    assert (got["A3"]["district_id"], got["A3"]["day"]) == (3, 31)


def test_landing_route(spark):
    keys = spark.createDataFrame([("raw_data/card/f.csv",), ("raw_data/f.csv",), ("other/card/f.csv",),
                                  ("raw_data/card/delta+2018.csv",), ("raw_data/card/x%zz.csv",),
                                  ("stage_data/loan_portfolio/p.parquet",),
                                  ("stage_data%2Forder%2Fp.parquet",)], "key string")
    got = {r["key"]: r for r in landing_route(keys).collect()}
    assert (got["raw_data/card/f.csv"]["action"], got["raw_data/card/f.csv"]["table_name"]) == ("stage", "card")
    assert not got["raw_data/f.csv"]["accepted"] and got["raw_data/f.csv"]["table_name"] is None
    assert not got["other/card/f.csv"]["accepted"]
    assert got["raw_data/card/delta+2018.csv"]["decoded_key"] == "raw_data/card/delta 2018.csv"
    assert got["raw_data/card/x%zz.csv"]["decoded_key"] == "raw_data/card/x%zz.csv"
    lp = got["stage_data/loan_portfolio/p.parquet"]
    assert lp["action"] == "publish_daily" and lp["job_exists"] is False
    assert got["stage_data%2Forder%2Fp.parquet"]["table_name"] == "order"


def test_upsert_survives_an_uncommitted_version(spark):
    """A run that wrote its data but died before the manifest row leaves an
    unreferenced folder; the next run commits normally."""
    root = fresh_dir(spark, "t-export-retry")
    upsert_keyed(spark, _items(spark, [("C1", "A1", "201801", 1.0)]), root, KEYS)
    _items(spark, [("C9", "A9", "201801", 9.0)]).write.partitionBy("pdate").parquet(
        f"{root}/data/v00000002-deadbeef0000")
    out = upsert_keyed(spark, _items(spark, [("C2", "A2", "201801", 2.0)]), root, KEYS)
    assert sorted(r["client_id"] for r in out.collect()) == ["C1", "C2"]


def test_stream_splits_files_over_micro_batches(spark):
    landing = local_path(fresh_dir(spark, "t-landing-many"))
    os.makedirs(landing)
    stage, ckpt = fresh_dir(spark, "t-stage-many"), fresh_dir(spark, "t-ckpt-many")
    head = "account_id,district_id,frequency,parseddate,year,month,day\n"
    for i in range(3):
        _write(landing, f"f{i}.csv", head + f"A{i},1,monthly,2017-12-30,2017,12,30\n")
    ingest_landing(spark, landing, "account", stage, ckpt, max_files_per_trigger=1)
    got = read_ingested(spark, "account", stage, keep_batch=True)
    assert sorted(r["account_id"] for r in got.collect()) == ["A0", "A1", "A2"]
    assert got.select("ingest_batch").distinct().count() == 3


def test_stream_archives_processed_files(spark):
    base = local_path(fresh_dir(spark, "t-landing-archive"))
    landing = os.path.join(base, "landing", "account")
    os.makedirs(landing)
    stage, ckpt = fresh_dir(spark, "t-stage-arch"), fresh_dir(spark, "t-ckpt-arch")
    archive = os.path.join(base, "archive")
    head = "account_id,district_id,frequency,parseddate,year,month,day\n"
    _write(landing, "a.csv", head + "A1,1,monthly,2017-12-30,2017,12,30\n")
    ingest_landing(spark, landing, "account", stage, ckpt, archive_dir=archive)
    _write(landing, "b.csv", head + "A2,1,monthly,2017-12-30,2017,12,30\n")
    ingest_landing(spark, landing, "account", stage, ckpt, archive_dir=archive)
    assert read_ingested(spark, "account", stage).count() == 2
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert "a.csv" in archived             # moved once a later batch committed


def test_stream_publishes_touched_periods_only(spark):
    from ledgerlake.operators.publish import read_back
    from ledgerlake.schemas import mapping_for
    landing = local_path(fresh_dir(spark, "t-landing-pub"))
    os.makedirs(landing)
    stage, ckpt, pub = (fresh_dir(spark, "t-stage-pub"), fresh_dir(spark, "t-ckpt-pub"),
                        fresh_dir(spark, "t-pub-pub"))
    head = "account_id,district_id,frequency,parseddate,year,month,day\n"
    _write(landing, "a.csv", head + "A1,1,m,2018-01-05,2018,1,5\nA2,1,m,2018-02-05,2018,2,5\n")
    ingest_landing(spark, landing, "account", stage, ckpt, publish_root=pub)
    _write(landing, "b.csv", head + "A3,1,m,2018-02-09,2018,2,9\n")
    ingest_landing(spark, landing, "account", stage, ckpt, publish_root=pub)
    got = read_back(spark, pub, mapping_for("account").target_schema())
    assert sorted((r["month"], r["account_id"]) for r in got.collect()) == [
        (1, "A1"), (2, "A2"), (2, "A3")]


def test_stream_batch_with_mixed_headers_falls_back(spark):
    landing = local_path(fresh_dir(spark, "t-landing-mixed"))
    os.makedirs(landing)
    stage, ckpt = fresh_dir(spark, "t-stage-mixed"), fresh_dir(spark, "t-ckpt-mixed")
    _write(landing, "a.csv", "account_id,district_id,frequency,parseddate,year,month,day\n"
                             "A1,1,monthly,2017-12-30,2017,12,30\n")
    _write(landing, "b.csv", "day,month,year,parseddate,frequency,district_id,account_id\n"
                             "31,12,2017,2017-12-31,weekly,3,A2\n")
    ingest_landing(spark, landing, "account", stage, ckpt)         # one micro-batch, two headers
    got = {r["account_id"]: r for r in read_ingested(spark, "account", stage).collect()}
    assert sorted(got) == ["A1", "A2"]
    assert (got["A2"]["district_id"], got["A2"]["day"], got["A1"]["day"]) == (3, 31, 30)


def _landing(spark, name, files):
    import os
    from ledgerlake.session import local_path
    base = local_path(fresh_dir(spark, name))
    os.makedirs(base)
    for file, text in files.items():
        with open(os.path.join(base, file), "w") as f:
            f.write(text)
    return base


HEAD = "account_id,district_id,frequency,parseddate,year,month,day\n"


def test_names_with_glob_characters_are_files_of_their_own(spark):
    landing = _landing(spark, "t-glob", {"a[1].csv": HEAD + "AA,1,m,2018-01-02,2018,1,2\n",
                                         "a1.csv": HEAD + "BB,1,m,2018-01-02,2018,1,2\n",
                                         "a b.csv": HEAD + "CC,1,m,2018-01-02,2018,1,2\n"})
    stage, ckpt = fresh_dir(spark, "t-glob-stage"), fresh_dir(spark, "t-glob-ckpt")
    ingest_landing(spark, landing, "account", stage, ckpt)
    assert sorted(r.account_id for r in read_ingested(spark, "account", stage).collect()) == ["AA", "BB", "CC"]


def test_a_new_checkpoint_replaces_no_earlier_batch(spark):
    import os
    landing = _landing(spark, "t-reset", {"1.csv": HEAD + "A1,1,m,2018-01-02,2018,1,2\n"})
    stage = fresh_dir(spark, "t-reset-stage")
    ingest_landing(spark, landing, "account", stage, fresh_dir(spark, "t-reset-ckpt"))
    os.remove(os.path.join(landing, "1.csv"))                      # archived
    with open(os.path.join(landing, "2.csv"), "w") as f:
        f.write(HEAD + "A2,1,m,2018-01-02,2018,1,2\n")
    ingest_landing(spark, landing, "account", stage, fresh_dir(spark, "t-reset-ckpt"))
    assert sorted(r.account_id for r in read_ingested(spark, "account", stage).collect()) == ["A1", "A2"]


def test_rejects_and_ragged_rows_of_a_stream_are_counted(spark):
    landing = _landing(spark, "t-rejects", {"1.csv": HEAD + "A1,x,m,2018-01-02,2018,1,2\nA2,1\n"})
    stage = fresh_dir(spark, "t-rejects-stage")
    ingest_landing(spark, landing, "account", stage, fresh_dir(spark, "t-rejects-ckpt"))
    counts = {r["column"]: r["rejects"] for r in read_rejects(spark, stage).collect()}
    assert counts["district_id"] == 1 and counts["_ragged"] == 1 and counts["account_id"] == 0


def test_files_without_a_wanted_column_and_empty_landings_are_refused(spark):
    from ledgerlake.plans import jobs
    import os
    root = fresh_dir(spark, "t-refuse")
    base = _landing(spark, "t-refuse-files", {"1.csv": "foo,bar\n1,2\n"})
    os.makedirs(f"{jobs._p(root.replace('file:', ''), 'landing')}")
    os.symlink(base, f"{root.replace('file:', '')}/landing/account")
    spark.createDataFrame([("A",)], "account_id string").write.parquet(f"{root}/stage/account")
    with pytest.raises(ValueError, match="1.csv"):
        jobs.stage_job(spark, root, "account")
    open(os.path.join(base, "1.csv"), "w").close()                 # zero bytes
    with pytest.raises(ValueError, match="no header"):
        jobs.stage_job(spark, root, "account")
    assert spark.read.parquet(f"{root}/stage/account").count() == 1


def test_export_refuses_rows_without_a_period(spark):
    root = fresh_dir(spark, "t-null-period")
    df = spark.createDataFrame([("c", "a", None), ("c", "b", "201801")], "client_id string, account_id string, pdate string")
    for named in (None, ["201801"]):
        with pytest.raises(ValueError, match="period"):
            export.upsert_keyed(spark, df, root, periods=named)
    assert export.current_versions(spark, root) == {}


def test_superseded_versions_can_be_removed(spark):
    root = fresh_dir(spark, "t-gc")
    df = spark.createDataFrame([("c", "a", "201801", 1)], "client_id string, account_id string, pdate string, v int")
    export.upsert_keyed(spark, df, root)
    export.upsert_keyed(spark, df.withColumn("v", df.v + 1), root)
    assert export.remove_superseded(spark, root) >= 2
    assert [r.v for r in export.read_current(spark, root).collect()] == [2]


def test_the_refresh_of_a_batch_prunes_to_its_periods(spark):
    from ledgerlake.streaming.ingest import _of_periods
    landing = _landing(spark, "t-prune", {f"{m}.csv": HEAD + f"A{m},1,m,2018-0{m}-02,2018,{m},2\n" for m in (1, 2, 3)})
    stage = fresh_dir(spark, "t-prune-stage")
    ingest_landing(spark, landing, "account", stage, fresh_dir(spark, "t-prune-ckpt"), by_period=True)
    periods = spark.createDataFrame([(2018, 2)], "year int, month int")
    touched = _of_periods(read_ingested(spark, "account", stage), periods, ["year", "month"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "= 2018" in filters and "= 2)" in filters, filters
    assert [r.account_id for r in touched.collect()] == ["A2"]


def _drops(spark, name, publish_root=None, by_period=False):
    """Three drops, each its own micro-batch: (landing, stage, checkpoint)."""
    landing = _landing(spark, name, {})
    stage, ckpt = fresh_dir(spark, f"{name}-stage"), fresh_dir(spark, f"{name}-ckpt")
    for m in (1, 2, 3):
        _write(landing, f"{m}.csv", HEAD + f"A{m},1,m,2018-0{m}-02,2018,{m},2\nB{m},x,m,2018-0{m}-03,2018,{m},3\n")
        ingest_landing(spark, landing, "account", stage, ckpt, by_period=by_period, publish_root=publish_root)
    return landing, stage, ckpt


def _data_files(stage):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(local_path(stage)) for f in fs if f.endswith(".parquet"))


def _replay(spark, landing, stage, ckpt, **kwargs):
    """The last batch again, as after a failure before its commit."""
    commits = os.path.join(local_path(ckpt), "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(os.path.join(commits, n)):
            os.remove(os.path.join(commits, n))
    ingest_landing(spark, landing, "account", stage, ckpt, **kwargs)


def test_a_replayed_batch_counts_its_rejects_once(spark):
    landing, stage, ckpt = _drops(spark, "t-replay")
    count = lambda: {(r.ingest_batch[-1], r["column"]): r.rejects for r in read_rejects(spark, stage).collect() if r.rejects}
    once = count()
    assert once == {(str(i), "district_id"): 1 for i in range(3)}
    _replay(spark, landing, stage, ckpt)
    assert count() == once and read_ingested(spark, "account", stage).count() == 6


@pytest.mark.parametrize("by_period", [False, True])
def test_compaction_puts_batches_together_and_leaves_the_last(spark, by_period):
    landing, stage, ckpt = _drops(spark, "t-compact", by_period=by_period)
    before, ids = _data_files(stage), ["A1", "A2", "A3", "B1", "B2", "B3"]
    for m in (1, 2, 3):
        _write(landing, f"again{m}.csv", HEAD + f"C{m},1,m,2018-01-02,2018,1,2\n")
        ingest_landing(spark, landing, "account", stage, ckpt, by_period=by_period)
    ids = sorted(ids + ["C1", "C2", "C3"])
    before = _data_files(stage)
    replaced = compact_ingested(spark, "account", stage)
    seen = lambda: sorted(r.account_id for r in read_ingested(spark, "account", stage).collect())
    assert len(replaced) == 5 and seen() == ids and len(_data_files(stage)) < len(before)
    _replay(spark, landing, stage, ckpt, by_period=by_period)      # replaces its own rows only
    assert seen() == ids
    assert compact_ingested(spark, "account", stage) == []
    _write(landing, "more.csv", HEAD + "D,1,m,2018-03-02,2018,3,2\n")
    ingest_landing(spark, landing, "account", stage, ckpt, by_period=by_period)
    assert len(compact_ingested(spark, "account", stage)) == 2 and seen() == sorted(ids + ["D"])


def test_a_compaction_that_died_is_not_read(spark, monkeypatch):
    from ledgerlake import files
    _, stage, _ = _drops(spark, "t-compact-dead", by_period=True)
    ids = sorted(r.account_id for r in read_ingested(spark, "account", stage).collect())
    for step in ("create_lines", "delete"):        # before the record, and before the folders went
        def dies(*args):
            raise OSError("lost")
        monkeypatch.setattr(files, step, dies)
        with pytest.raises(OSError):
            compact_ingested(spark, "account", stage)
        monkeypatch.undo()
        assert sorted(r.account_id for r in read_ingested(spark, "account", stage).collect()) == ids


def test_compaction_leaves_open_periods(spark):
    _, stage, _ = _drops(spark, "t-compact-open", by_period=True)
    assert compact_ingested(spark, "account", stage, closed_before=(2018, 2)) == []
    assert len(compact_ingested(spark, "account", stage, closed_before=(2018, 3))) == 2
