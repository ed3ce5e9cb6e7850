"""Declared mapping with rejects; CSV bound by header name; scans."""

import datetime as dt

from pyspark.sql import Observation

from helpers import string_schema
from ledgerlake.operators.mapping import apply_mapping, reject_counts
from ledgerlake.schemas import mapping_for
from ledgerlake.session import fresh_dir
from ledgerlake.sources.csv_landing import csv_headers, scan_csv_by_name


def test_mapping_converts_and_counts_rejects(spark):
    m = mapping_for("account")
    raw = spark.createDataFrame([
        ("A00000001", "18", "monthly", "2017-12-30", "2017", "12", "30"),
        ("A00000002", "x", "weekly", "bad date", "2018", "13", "1"),
        ("A00000003", "5", "weekly", "2018-13-01", "3000000000", "1", ""),
        ("A00000004", None, None, "", "2018", "1", "1"),
    ], string_schema(*m.source_names))
    obs = Observation("rejects")
    out = apply_mapping(raw, m, obs)
    got = {r["account_id"]: r for r in out.collect()}
    assert got["A00000001"]["parseddate"] == dt.date(2017, 12, 30)
    assert got["A00000001"]["district_id"] == 18 and got["A00000001"]["year"] == 2017
    assert got["A00000002"]["parseddate"] is None and got["A00000002"]["district_id"] is None
    assert got["A00000003"]["parseddate"] is None            # 2018-13-01
    assert got["A00000003"]["year"] is None                  # > 2^31 for an int column
    counts = reject_counts(obs)
    assert counts["parseddate"] == 3                         # bad, 13th month, empty
    assert counts["district_id"] == 1 and counts["year"] == 1 and counts["day"] == 1
    assert counts["account_id"] == 0 and counts["frequency"] == 0
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "string", "bigint", "string", "date", "int", "int", "int"]


def test_mapping_drops_unlisted_and_renames(spark):
    m = mapping_for("loan_portfolio")
    raw = spark.createDataFrame([("L1", "250000.5", "2015-06-01", "30", "11", "extra")],
                                string_schema("loan_id", "funded_amount", "funded_date",
                                              "duration years", "zip code", "not_mapped"))
    out = apply_mapping(raw, m)
    assert "not_mapped" not in out.columns
    assert "10_yr_treasury_index_date_funded" in out.columns and "address_2" in out.columns
    r = out.first()
    assert (r["duration_years"], r["zip_code"], r["funded_amount"]) == (30, 11, 250000.5)


def test_csv_bound_by_header_name(spark):
    landing = fresh_dir(spark, "test-landing")
    import os
    from ledgerlake.session import local_path
    base = local_path(landing)
    os.makedirs(base)
    files = {
        # order of the delta file (year, month, day, fulldate)
        "a.csv": "card_id,disp_id,type,year,month,day,fulldate\nV1,D1,gold,2018,12,3,2018-12-03\n",
        # mapping order plus an extra column
        "b.csv": "card_id,disp_id,type,day,month,year,fulldate,extra\nV2,D2,classic,4,12,2018,2018-12-04,x\n",
        # a column missing, columns reordered
        "c.csv": "fulldate,type,card_id,disp_id,day,month\n2018-12-05,junior,V3,D3,5,12\n",
        # different case and spacing in the header
        "d.csv": "Card_ID, DISP_ID ,Type,Year,Month,Day,FullDate\nV4,D4,gold,2018,12,6,2018-12-06\n",
    }
    for name, text in files.items():
        with open(os.path.join(base, name), "w") as f:
            f.write(text)
    assert csv_headers(spark, landing).count() == 4
    df = scan_csv_by_name(spark, landing, mapping_for("card").source_names)
    got = {r["card_id"]: r for r in df.collect()}
    assert (got["V1"]["day"], got["V1"]["year"]) == ("3", "2018")
    assert (got["V2"]["day"], got["V2"]["year"], got["V2"]["type"]) == ("4", "2018", "classic")
    assert got["V3"]["year"] is None and got["V3"]["disp_id"] == "D3"
    assert (got["V4"]["disp_id"], got["V4"]["day"]) == ("D4", "6")
    staged = apply_mapping(df, mapping_for("card"))
    assert staged.where("year = 2018 and day in (3, 4)").count() == 2


def _files(spark, name, files):
    import os
    from ledgerlake.session import local_path
    base = local_path(fresh_dir(spark, name))
    os.makedirs(base)
    for file, text in files.items():
        with open(os.path.join(base, file), "w", newline="") as f:
            f.write(text)
    return base


def test_headers_with_quoted_commas_and_line_breaks(spark):
    landing = _files(spark, "test-quoted", {
        "a.csv": '"type, kind",card_id,disp_id\ngold,V1,D1\n',
        "b.csv": '"note\nof, the ""day""",disp_id,"card_id"\n"two\nlines",D2,V2\nplain,D3,V3\n',
        "c.csv": '\n  \ncard_id,disp_id\r\nV4,D4\r\n',
        "empty.csv": ""})
    heads = {r.file.rsplit("/", 1)[1]: r for r in csv_headers(spark, landing).collect()}
    assert heads["a.csv"].names == ["type, kind", "card_id", "disp_id"] and heads["a.csv"].lines == 1
    assert heads["b.csv"].names[1:] == ["disp_id", "card_id"] and heads["b.csv"].lines == 2
    assert heads["c.csv"].names == ["card_id", "disp_id"] and "empty.csv" not in heads
    from pyspark.sql import Observation
    seen = Observation()
    got = scan_csv_by_name(spark, landing, ["card_id", "disp_id"], observation=seen).collect()
    assert sorted(tuple(r) for r in got) == [("V1", "D1"), ("V2", "D2"), ("V3", "D3"), ("V4", "D4")]
    assert seen.get["_ragged"] == 0


def test_headers_are_read_from_the_heads_of_files(spark):
    """A file of several splits: one scan of the data, and the header's job
    takes a small part of the bytes."""
    import os
    body = "".join(f"{i},{'x' * 200}\n" for i in range(60_000))    # 12 MB
    landing = _files(spark, "test-heads", {"big.csv": "id,filler\n" + body})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        df = scan_csv_by_name(spark, landing, ["id"])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
        assert df.count() == 60_000 and df.where("id = '59999'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert os.path.getsize(f"{landing}/big.csv") > 12_000_000

    def endless():
        from ledgerlake.sources import csv_landing
        import pyarrow as pa
        taken = []

        def batches():
            for i in range(1000):
                taken.append(i)
                yield pa.RecordBatch.from_pydict({"file": ["f"] * 2, "start": [0, 0], "value": ['a,"b', 'c",d' if i else "x"]})
        heads = list(csv_landing._first_record(batches()))
        return heads, taken
    heads, taken = endless()
    assert heads[0].column("record")[0].as_py() == 'a,"b\nx\na,"b' and len(taken) == 2
