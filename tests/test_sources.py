import io
import json
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoremill.functions.expressions import parse_number
from scoremill.sources import loans as source
from scoremill.sources import staging
from scoremill.sources.sinks import write_csv, write_json
from scoremill.sources.staging import shared_folder, stage, workspace


def written(tmp_path, *texts):
    folder = tmp_path / "files"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.csv").write_text(text)
    return str(folder)


LOANS = ('loan_status,loan_amnt,dti,grade,desc,term,fico_low\n'
         'Current,1000,NA,A,"said ""yes"", twice", 36 months,700\n'
         'Default,n/a,3.5,,None,NaN,\n'
         'Default,{odd},1e3,B,ok,,690.5\n')


def test_csv_types_follow_the_data(spark, tmp_path):
    df = source.read_loans_csv(spark, written(tmp_path, LOANS.format(odd="12")))
    assert [t for _, t in df.dtypes] == ["string", "double", "double", "string", "string", "string", "double"]
    assert [tuple(r) for r in df.collect()] == [
        ("Current", 1000.0, None, "A", 'said "yes", twice', " 36 months", 700.0),
        ("Default", None, 3.5, None, None, None, None),
        ("Default", 12.0, 1000.0, "B", "ok", None, 690.5)]


def test_a_column_with_other_text_stays_text_unless_named(spark, tmp_path):
    path = written(tmp_path, LOANS.format(odd="12x"))
    assert dict(source.read_loans_csv(spark, path).dtypes)["loan_amnt"] == "string"
    named = source.read_loans_csv(spark, path, numeric=["loan_amnt"])
    assert [r["loan_amnt"] for r in named.collect()] == [1000.0, None, None]


@pytest.mark.parametrize("texts", [
    ("id,loan_amnt,dti\n1,2,3\n", "id,dti,loan_amnt\n1,3,2\n"),   # columns in another order
    ("id,desc\n1,\"two\nlines\"\n2,x\n",),                        # an open quote
    ("id,dti\n1,2\n3,4,5\n",),                                      # a field too many
    ("id,dti,x\n1,2,3\n4,5\n",),                                    # a field too few
])
def test_what_would_be_misread_is_refused(spark, tmp_path, texts):
    with pytest.raises(Exception, match="MALFORMED|header|FAILFAST|conform"):
        source.read_loans_csv(spark, written(tmp_path, *texts)).collect()


@pytest.mark.parametrize("value, number", [
    ("1", True), ("-1.5", True), ("+.5", True), ("1.", True), ("1e3", True), ("1E-3", True), (" 7 ", True), ("inf", True), ("-Infinity", True),
    ("1D", False), ("2F", False), ("2f", False), ("0x1p3", False), ("0x10", False), ("1_000", False), ("1,000", False), ("1e", False),
    (".", False), ("--1", False), ("1 2", False), ("NaN1", False), ("١", False)])
def test_numbers_are_those_that_pandas_reads(spark, tmp_path, value, number):
    df = source.read_loans_csv(spark, written(tmp_path, f'a,b\n"{value}",x\n3,y\n'))
    assert dict(df.dtypes)["a"] == ("double" if number else "string")
    assert (pd.read_csv(io.StringIO(f'a,b\n"{value}",x\n3,y\n'))["a"].dtype.kind in "if") == number
    assert spark.range(1).select(parse_number(F.lit(value)).isNotNull().alias("n")).first()["n"] == number


@pytest.mark.parametrize("header", ["x,x,y,x", "a,,b,", "x,x.1,x,x", "a,a,a.1,a", '"p,q",b,b,c'])
def test_names_of_the_header_are_those_of_pandas(spark, tmp_path, header):
    df = source.read_loans_csv(spark, written(tmp_path, f"\ufeff{header}\n1,2,3,u\n"))
    assert df.columns == list(pd.read_csv(io.StringIO(f"{header}\n1,2,3,u\n")).columns)
    assert [tuple(r) for r in df.collect()] == [(1.0, 2.0, 3.0, "u")]


def test_refused_rows_go_to_a_side_table_with_file_and_line(spark, tmp_path):
    """Files of many blocks: lines are counted through them. Blank lines count, but are no rows."""
    good = "".join(f"{i},text {i},{i * 2}\n" for i in range(3000))
    lines = ("id,desc,dti\n\n" + good).split("\n")
    bad = {5: "1,2", 900: "7,8,9,10", 2990: '8,"open,1', 2991: '9,x,"open', 2992: "   "}
    for at, text in bad.items():
        lines[at] = text
    path = written(tmp_path, "\n".join(lines), "id,desc,dti\n4,5\n1,5\" pipe,2\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = source.read_loans_csv(spark, path, refused_limit=5, quarantine=f"{tmp_path}/refused")
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        found = {(r["file"].rsplit("/", 1)[1], r["line"]): r["text"] for r in spark.read.parquet(f"{tmp_path}/refused").collect()}
        assert found == {**{("0.csv", at + 1): text for at, text in bad.items() if text.strip()}, ("1.csv", 2): "4,5"}
        assert df.dtypes == [("id", "bigint"), ("desc", "string"), ("dti", "double")]
        assert df.count() == 3000 - 5 + 1
        with pytest.raises(ValueError, match=r"5 MALFORMED rows, 4 allowed: .*0.csv line 6; "):
            source.read_loans_csv(spark, path, refused_limit=4)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_headers_are_compared_by_their_fields_and_are_no_rows(spark, tmp_path):
    df = source.read_loans_csv(spark, written(tmp_path, "id,dti\n1,2\n", '\n"id","dti"\n3,4\n', "id,dti\n", ""))
    assert sorted(map(tuple, df.collect())) == [(1, 2.0), (3, 4.0)]


def test_titles_that_come_again_are_a_row(spark, tmp_path):
    df = source.read_loans_csv(spark, written(tmp_path, "id,dti\n1,2\nid,dti\n", "id,dti\n3,4\n"))
    assert sorted(map(tuple, df.collect())) == [("1", "2"), ("3", "4"), ("id", "dti")]


def test_a_file_is_read_once(spark, tmp_path):
    path = written(tmp_path, "id,dti\n1,2\n")
    df = source.read_loans_csv(spark, path)
    assert not any(path in f for f in df.inputFiles()) and df.count() == 1


def test_line_breaks_in_quotes_with_the_setting(spark, tmp_path):
    path = written(tmp_path, 'id,desc\n1,"two\nlines"\n2,x\n')
    rows = source.read_loans_csv(spark, path, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, "x")]


def test_identifiers_are_whole_numbers(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text("id,member_id,dti\n1077501,,7\n")
    assert [tuple(r) for r in source.read_loans_csv(spark, str(path)).collect()] == [(1077501, None, 7.0)]


def test_probe_and_required_columns(spark):
    df = spark.createDataFrame([("Current", 1.0, 2.0, "A", 9)] * 8,
                               "loan_status string, loan_amnt double, dti double, grade string, x int")
    assert source.probe(df).count() == 5
    with pytest.raises(ValueError, match="dti"):
        source.probe(df.drop("dti"))


def test_source_resolution(spark, tmp_path):
    there, absent = tmp_path / "there.csv", str(tmp_path / "absent.csv")
    there.write_text("a\n1\n")
    assert source.resolve_source(spark, ("raw", absent), ("fallback", str(there))) == ("fallback", str(there))
    with pytest.raises(FileNotFoundError):
        source.resolve_source(spark, ("raw", absent))


def test_nan_and_tokens_become_null(spark):
    df = spark.createDataFrame([(float("nan"), "NULL", 1), (2.0, "fine", None)], "x double, s string, i int")
    assert [tuple(r) for r in source.normalise_missing(df).collect()] == [(None, None, 1), (2.0, "fine", None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1.5, " spaced", "A")], "v double, s string, grade string")
    write_csv(df, str(tmp_path / "csv"), first="grade", single_file=True)
    part = next((tmp_path / "csv").glob("part-*.csv"))
    assert part.read_text() == "grade,v,s\nA,1.5, spaced\n"
    write_json(df.selectExpr("v", "CAST(NULL AS string) AS missing"), str(tmp_path / "json"))
    assert json.loads(next((tmp_path / "json").glob("part-*.json")).read_text()) == {"v": 1.5, "missing": None}


def test_staged_tables_lie_in_the_configured_folder(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    staged = stage(df, "test")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark))
    assert sorted(staged.collect()) == sorted(df.collect()) and staged.dtypes == df.dtypes


def test_a_workspace_removes_what_was_staged_in_it(spark):
    before = stage(spark.range(3), "outside")
    with workspace(spark):
        inside = stage(spark.range(5), "inside")
        kept = stage(spark.range(7), "kept", kept=True)
        assert inside.count() == 5
    spark.catalog.clearCache()
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
        inside.count()
    assert before.count() == 3 and kept.count() == 7


def test_plain_names_are_free_of_points_and_unique(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, `a.1` int, a_1 int, `b.c.d` int")
    assert source.plain_names(df).columns == ["a", "a_1_", "a_1", "b_c_d"]
    assert source.plain_names(df).select("a_1_", "b_c_d").collect() == [(2, 4)]


def test_shuffle_files_of_what_is_staged_go_at_once(spark):
    """They do not wait for the driver's garbage, and the session's setting stays as it is."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    def files():
        return {p.name for f in folders for p in Path(f).rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get(staging.CLEANUP)
    staged = staging.stage(spark.range(1000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and staged.count() == 7
    assert spark.conf.get(staging.CLEANUP) == setting
