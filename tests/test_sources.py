"""Scans and sinks."""

import pytest
from pyspark.errors import PySparkException

from assaymill.errors import ExtractionError
from assaymill.operators.dedup import ROW_POSITION, drop_duplicates
from assaymill.sources import scan, scan_csv, spread, write_parquet, write_summary_csv


def rows(df):
    return [tuple(r) for r in df.drop(ROW_POSITION).collect()]


def test_everything_is_text_and_na_tokens_are_null(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('code, v ,note\n007,NA,"a, ""b"""\n008,1.0,\n\n009,n/a,back\\slash\n')
    df = scan_csv(spark, str(path))
    assert df.drop(ROW_POSITION).columns == ["code", " v ", "note"]
    assert rows(df) == [("007", None, 'a, "b"'), ("008", "1.0", None), ("009", None, "back\\slash")]


def test_latin1_fallback_is_for_the_whole_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("a,b\nplain,é\n".encode("latin-1"))
    assert rows(scan_csv(spark, str(path))) == [("plain", "é")]
    path.write_bytes("a,b\nplain,é\n".encode("utf-8"))
    assert rows(scan_csv(spark, str(path))) == [("plain", "é")]


def test_short_rows_are_padded_and_long_rows_fail(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b,c\n1,2\n"x,y",2,3\n')
    df = scan_csv(spark, str(path))
    assert rows(df) == [("1", "2", None), ("x,y", "2", "3")]
    path.write_text('a,b,c\n1,2,3,4\n')
    for action in (lambda d: d.count(), lambda d: d.select("a").collect()):
        with pytest.raises(PySparkException, match="more than 3 fields"):
            action(scan_csv(spark, str(path)))


def test_records_over_several_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b\n1,"two\nlines"\n2,x\n')
    assert rows(scan_csv(spark, str(path), multiline=True)) == [("1", "two\nlines"), ("2", "x")]


def test_missing_and_empty_files(spark, tmp_path):
    with pytest.raises(ExtractionError, match="not found"):
        scan_csv(spark, str(tmp_path / "absent.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ExtractionError):
        scan_csv(spark, str(tmp_path / "empty.csv"))


def test_first_means_file_order_whatever_the_partitioning(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("k,v\n" + "".join(f"{i % 50},{i}\n" for i in range(2000)))
    df = scan_csv(spark, str(path))
    expected = {(str(i), str(i)) for i in range(50)}
    for d in (df, df.repartition(7), df.repartition(3, "v")):
        assert set(rows(drop_duplicates(d, ["k"]))) == expected
    last = set(rows(drop_duplicates(df.repartition(5), ["k"], keep="last")))
    assert last == {(str(i), str(1950 + i)) for i in range(50)}


def test_spread_only_on_request(spark):
    small = spark.range(0, 100, 1, 1)
    assert spread(small) is small
    assert spread(small, 3).rdd.getNumPartitions() == 3


def test_encoding_is_told_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("a,b\nplain,é\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("a,b\nodd \"quote,é\n".encode("utf-8"))
    assert sorted(rows(scan_csv(spark, str(tmp_path)))) == [('odd "quote', "é"), ("plain", "é")]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "x", 0.5, True, None), (2, 'say "y", z', -1.0, False, "n")],
        "i long, s string, d double, b boolean, n string")
    write_parquet(df, str(tmp_path / "t.parquet"))
    back = scan(spark, str(tmp_path / "t.parquet"))
    assert back.drop(ROW_POSITION).schema == df.schema and sorted(rows(back)) == sorted(rows(df))
    write_summary_csv(df, str(tmp_path / "t.csv"), ["i"])
    assert rows(scan_csv(spark, str(tmp_path / "t.csv")))[1] == ("2", 'say "y", z', "-1.0", "false", "n")


# --- rows and rejects -------------------------------------------------------------------------------------

def split(spark, folder, **options):
    from assaymill.sources import scan_csv_split

    return scan_csv_split(spark, str(folder), **options)


def bad_files(folder):
    folder.mkdir()
    (folder / "a.csv").write_bytes(
        b'a,"b",c\r\n1,x,"say ""hi"", you"\n\n2,short\n3,x,y,long\n4,\xff\xfe,bytes\n5,"open,z\n 6 ,,NA\n')
    (folder / "b.csv").write_text("﻿a,b,c\n7,ü,z\n,,\n")
    return folder


def test_records_are_parted_into_rows_and_rejects(spark, tmp_path):
    folder = bad_files(tmp_path / "in")
    got = split(spark, folder)
    assert sorted(tuple(r)[:3] for r in got.rows.collect() if r["a"]) == [
        (" 6 ", None, None), ("1", "x", 'say "hi", you'), ("7", "ü", "z")]
    assert (got.accepted, got.rejected) == (4, 4) and got.rows.where("a IS NULL").count() == 1
    rejects = {r["reason"]: (r["file"].rsplit("/", 1)[1], bytes(r["record"])) for r in got.rejects.collect()}
    assert rejects == {
        "too few fields": ("a.csv", b"2,short"), "too many fields": ("a.csv", b"3,x,y,long"),
        "undecodable": ("a.csv", b"4,\xff\xfe,bytes"), "unclosed quote": ("a.csv", b'5,"open,z')}
    places = [r["position"]["row"] for r in got.rejects.orderBy("position").collect()]
    assert places == sorted(set(places))


def test_short_records_padded_and_bad_ones_failing(spark, tmp_path):
    folder = bad_files(tmp_path / "in")
    padded = split(spark, folder, pad_short=True)
    assert padded.rejected == 3 and [tuple(r)[:3] for r in padded.rows.where("a = 2").collect()] == [("2", "short", None)]
    with pytest.raises(ExtractionError, match="4 records cannot be read"):
        split(spark, folder, on_bad="fail")
    with pytest.raises(ExtractionError):
        split(spark, tmp_path / "absent")
    with pytest.raises(ValueError):
        split(spark, folder, on_bad="ignore")


def test_given_columns_and_nothing_to_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,2\n3,4\n")
    got = split(spark, tmp_path / "t.csv", columns=["x", "y y"], on_bad="fail")
    assert sorted(tuple(r)[:2] for r in got.rows.collect()) == [("1", "2"), ("3", "4")] and got.rows.columns[1] == "y y"
    (tmp_path / "h.csv").write_text("x,y\n")
    only = split(spark, tmp_path / "h.csv")
    assert (only.accepted, only.rejected, only.rows.count(), only.rejects.count()) == (0, 0, 0, 0)


def test_splitting_takes_one_write(spark, tmp_path):
    folder = bad_files(tmp_path / "in")
    spark.sparkContext.setJobGroup("split", "split")
    got = split(spark, folder, columns=["a", "b", "c"])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("split")) == 1
    plan = got.rejects._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan and "Exchange" not in plan


def test_rows_for_heavy_work_come_in_small_splits(spark):
    """A task's rows stay few, however large the table; a session's own setting stands."""
    key = "spark.sql.files.maxPartitionBytes"
    session = spark.newSession()
    session.conf.unset(key)
    assert spread(session.range(3)).count() == 3
    assert session.conf.get(key) == "16m"
    session.conf.set(key, "64m")
    spread(session.range(3))
    assert session.conf.get(key) == "64m"
