"""Zone records, exclusive commits, clean-up, widening and catalogue entries."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D, bank_df
from ledgerlake import files
from ledgerlake.operators import export, publish, zones
from ledgerlake.session import fresh_dir, local_path
from ledgerlake.sources.tables import scan_partitioned_parquet

PARTS = ["year", "month"]


def loans(spark, *rows):
    """(id, date, stored year, stored month)"""
    return bank_df(spark, "loan", [{"loan_id": i, "account_id": "A", "amount": 1, "fulldate": d, "year": y, "month": m, "day": 1}
                                   for i, d, y, m in rows])


def seen_from(spark, path, schema, lo, hi=None):
    """Ids of a pruned read, and its plan."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    df = scan_partitioned_parquet(spark, path, schema=schema)
    dated = zones.within(spark, path, PARTS, lo, hi)
    out = (df if dated is None else df.where(dated)).where(F.col("fulldate") >= F.lit(lo))
    if hi is not None:
        out = out.where(F.col("fulldate") < F.lit(hi))
    return sorted(r.loan_id for r in out.collect()), out._jdf.queryExecution().executedPlan().toString()


def test_files_are_created_once(spark):
    base = fresh_dir(spark, "t-files")
    assert files.names(spark, base) == []
    assert files.create_lines(spark, f"{base}/a.json", [{"x": 1}, {"x": 2}])
    assert not files.create(spark, f"{base}/a.json", "other")
    assert files.names(spark, base) == ["a.json"] and spark.read.json(f"{base}/a.json").count() == 2
    assert files.delete(spark, f"{base}/a.json") and not files.exists(spark, f"{base}/a.json")


def test_odd_rows_stay_visible_and_pruning_stays_on(spark):
    path = fresh_dir(spark, "t-zones")
    df = loans(spark, ("in", D(2018, 3, 5), 2018, 3), ("odd", D(2018, 3, 6), 2017, 12), ("none", D(2018, 4, 1), None, None),
               ("old", D(2017, 1, 1), 2017, 1), ("older", D(2016, 1, 1), 2016, 1), ("undated", None, 2015, 1))
    publish.publish_rebuild(df, path, PARTS, date_col="fulldate")
    assert not publish.periods_agree(spark, path) and zones.odd_rows(spark, path) == 3
    ids, plan = seen_from(spark, path, df.schema, D(2018, 1, 1))
    assert ids == ["in", "none", "odd"]
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "2016/1" in filters and "2017/1" in filters and "2015/1" in filters and "2017/12" not in filters
    assert seen_from(spark, path, df.schema, D(2016, 1, 1), D(2017, 1, 1))[0] == ["older"]


def test_refresh_replaces_and_append_adds_to_what_a_folder_holds(spark):
    path = fresh_dir(spark, "t-zones-kinds")
    base = loans(spark, ("a", D(2018, 1, 5), 2017, 12), ("b", D(2017, 11, 5), 2017, 11))
    publish.publish_rebuild(base, path, PARTS, date_col="fulldate")
    assert seen_from(spark, path, base.schema, D(2018, 1, 1))[0] == ["a"]
    publish.publish_refresh_period(loans(spark, ("c", D(2017, 12, 5), 2017, 12)), path, PARTS, date_col="fulldate")
    assert publish.periods_agree(spark, path) and seen_from(spark, path, base.schema, D(2018, 1, 1))[0] == []
    publish.publish_append(loans(spark, ("d", D(2018, 2, 5), 2017, 11)), path, PARTS, date_col="fulldate")
    assert seen_from(spark, path, base.schema, D(2018, 1, 1))[0] == ["d"]
    publish.publish_append(loans(spark, ("e", D(2018, 2, 5), 2017, 12)), path, PARTS)       # dates not named
    assert zones.recorded(spark, path) is None and seen_from(spark, path, base.schema, D(2018, 1, 1))[0] == ["d", "e"]
    publish.publish_rebuild(base, path, PARTS, date_col="fulldate")
    assert seen_from(spark, path, base.schema, D(2018, 1, 1))[0] == ["a"]


@pytest.mark.parametrize("written", [False, True])
def test_a_publish_that_dies_leaves_no_wrong_record(spark, monkeypatch, written):
    """Before or after its rows are there, they are not pruned away."""
    path = fresh_dir(spark, "t-zones-crash")
    base = loans(spark, ("a", D(2017, 12, 5), 2017, 12))
    publish.publish_rebuild(base, path, PARTS, date_col="fulldate")
    plain = publish.write_parquet

    def dying(*args, **kwargs):
        if written:
            plain(*args, **kwargs)
        raise OSError("lost")
    monkeypatch.setattr(publish, "write_parquet", dying)
    odd = loans(spark, ("late", D(2018, 3, 5), 2017, 12))
    with pytest.raises(OSError):
        publish.publish_checked(spark, odd, path, PARTS, "fulldate")
    monkeypatch.undo()
    assert not publish.periods_agree(spark, path)
    assert seen_from(spark, path, base.schema, D(2018, 1, 1))[0] == (["late"] if written else [])
    assert seen_from(spark, path, base.schema, D(2017, 1, 1))[0] == (["late"] if written else ["a"])
    publish.publish_checked(spark, base, path, PARTS, "fulldate")                            # run again
    assert publish.periods_agree(spark, path) and seen_from(spark, path, base.schema, D(2017, 1, 1))[0] == ["a"]


def test_every_writer_of_the_published_layer_records(spark):
    path = fresh_dir(spark, "t-zones-evolving")
    publish.publish_rebuild(loans(spark, ("a", D(2017, 12, 5), 2017, 12)), path, PARTS, date_col="fulldate")
    out = publish.publish_evolving(spark, loans(spark, ("late", D(2018, 3, 5), 2017, 12)), path, PARTS, date_col="fulldate")
    assert not publish.periods_agree(spark, path)
    assert seen_from(spark, path, out.schema, D(2018, 1, 1))[0] == ["late"]
    publish.publish_evolving(spark, loans(spark, ("later", D(2018, 4, 5), 2017, 11)), path, PARTS)   # dates not named
    assert seen_from(spark, path, out.schema, D(2018, 1, 1))[0] == ["late", "later"]


ITEM = "client_id string, account_id string, pdate string, v int"


def items(spark, *rows):
    return spark.createDataFrame([("c", a, p, v) for a, p, v in rows], ITEM)


def test_of_two_writers_one_is_refused_before_its_commit(spark, monkeypatch):
    root = fresh_dir(spark, "t-two")
    export.upsert_keyed(spark, items(spark, ("a", "201801", 1)), root)
    plain, calls = export._commit, []

    def later(spark_, root_, version, folders):
        if not calls:                                  # another export commits first
            calls.append(1)
            export.upsert_keyed(spark_, items(spark_, ("b", "201801", 2)), root_)
        plain(spark_, root_, version, folders)
    monkeypatch.setattr(export, "_commit", later)
    with pytest.raises(RuntimeError, match="run this one again"):
        export.upsert_keyed(spark, items(spark, ("a", "201801", 9)), root)
    monkeypatch.undo()
    assert sorted((r.account_id, r.v) for r in export.read_current(spark, root).collect()) == [("a", 1), ("b", 2)]
    export.upsert_keyed(spark, items(spark, ("a", "201801", 9)), root)
    assert sorted((r.account_id, r.v) for r in export.read_current(spark, root).collect()) == [("a", 9), ("b", 2)]


def test_a_commit_that_died_while_it_was_written_is_passed_over(spark):
    root = fresh_dir(spark, "t-half")
    export.upsert_keyed(spark, items(spark, ("a", "201801", 1)), root)
    files.create(spark, f"{root}/_manifest/v00000002.json", "")
    export.upsert_keyed(spark, items(spark, ("a", "201801", 3)), root)
    assert [r.v for r in export.read_current(spark, root).collect()] == [3]


@pytest.mark.parametrize("spelling", ["{p}/", "file:{p}", "file://{p}/"])
def test_clean_up_under_another_spelling_keeps_the_table(spark, spelling):
    root = local_path(fresh_dir(spark, "t-spelling"))
    export.upsert_keyed(spark, items(spark, ("a", "201801", 1), ("b", "201802", 1)), root)
    export.upsert_keyed(spark, items(spark, ("a", "201801", 2)), root)
    export.upsert_keyed(spark, items(spark, ("a", "201801", 3)), root)
    other = spelling.format(p=root)
    assert export.remove_superseded(spark, other) >= 2
    for place in (root, other):
        assert sorted(r.v for r in export.read_current(spark, place).collect()) == [1, 3]


def test_clean_up_refuses_a_manifest_that_points_elsewhere(spark):
    root = fresh_dir(spark, "t-elsewhere")
    export.upsert_keyed(spark, items(spark, ("a", "201801", 1)), root)
    files.create_lines(spark, f"{root}/_manifest/v00000002.json", [{"period": "201802", "version": 2, "path": "/other/data/v2/p=201802"}])
    with pytest.raises(ValueError, match="not a folder below"):
        export.remove_superseded(spark, root)
    assert files.names(spark, f"{root}/data")


def test_types_widen_and_old_files_read_back_exactly(spark):
    path = fresh_dir(spark, "t-widen")

    def batch(month, kind, values):
        values = ", ".join(f"(cast('{v}' as {kind}), 2018, {month})" for v in values)
        return spark.sql(f"select * from values {values} as t(a, year, month)")
    publish.publish_evolving(spark, batch(1, "int", [2147483647, -5]), path, PARTS)
    publish.publish_evolving(spark, batch(2, "bigint", [9223372036854775807]), path, PARTS)
    out = publish.publish_evolving(spark, batch(3, "decimal(12,4)", ["1.2345"]), path, PARTS)
    publish.publish_evolving(spark, batch(4, "smallint", [7]), path, PARTS)
    assert out.schema["a"].dataType.simpleString() == "decimal(24,4)"
    out = scan_partitioned_parquet(spark, path, schema=publish.existing_schema(spark, path))
    assert sorted(r.a for r in out.collect()) == sorted(
        Decimal(x) for x in ("2147483647.0000", "-5.0000", "9223372036854775807.0000", "1.2345", "7.0000"))
    with pytest.raises(TypeError):
        publish.publish_evolving(spark, batch(5, "string", ["x"]), path, PARTS)
    with pytest.raises(TypeError):
        publish.publish_evolving(spark, batch(5, "double", ["1.5"]), path, PARTS)
    assert out.count() == 5


def test_a_publish_enters_folders_columns_and_types_by_itself(spark):
    from ledgerlake.plans import jobs
    root = fresh_dir(spark, "t-entered")
    spark.sql("create database if not exists t_entered")
    spark.sql("drop table if exists t_entered.loan")
    jobs.publish_table(spark, loans(spark, ("a", D(2018, 1, 5), 2018, 1)), root, "loan", rebuild=True, database="t_entered")
    jobs.publish_table(spark, loans(spark, ("b", D(2018, 2, 5), 2018, 2), ("n", None, None, None)), root, "loan", database="t_entered")
    assert sorted(r.loan_id for r in spark.table("t_entered.loan").collect()) == ["a", "b", "n"]
    more = loans(spark, ("c", D(2018, 3, 5), 2018, 3)).withColumn("branch", F.lit("north"))
    jobs.publish_table(spark, more, root, "loan", database="t_entered")
    got = {r.loan_id: r.branch for r in spark.table("t_entered.loan").collect()}
    assert got == {"a": None, "b": None, "n": None, "c": "north"}
    wider = loans(spark, ("d", D(2018, 4, 5), 2018, 4)).withColumn("amount", F.lit(2.5).cast("decimal(10,2)")).withColumn("branch", F.lit("x"))
    jobs.publish_table(spark, wider, root, "loan", database="t_entered")
    assert sorted(str(r.amount) for r in spark.table("t_entered.loan").collect()) == ["1.00"] * 4 + ["2.50"]
    assert sorted(r.loan_id for r in spark.table("t_entered.loan").where("year = 2018 and month = 4").collect()) == ["d"]


def test_exports_of_a_month_without_rows_read_back(spark):
    root = fresh_dir(spark, "t-no-rows")
    export.upsert_keyed(spark, items(spark, ("a", "201801", 1)), root, periods=["201801"])
    out = export.upsert_keyed(spark, items(spark, ("a", "201802", 1)).limit(0), root, periods=["201802"])
    assert [r.v for r in out.collect()] == [1]
