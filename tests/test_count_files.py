"""Raw count files: headers, layouts, cleaning, loads."""

import contextlib
import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from kerbside.operators import cleaning, quality
from kerbside.operators.columns import drop_nameless, preferred_name
from kerbside.plans import loads
from kerbside.sources import catalogue, csv_layouts

FILES = {
    "a.csv": "LocationName,Date,Hour,TotalCount,,\nBriggate,02-Mar-23,1,10,,\nBriggate,02-Mar-23,2,11,,\n",
    "b b.csv": "LocationName,Date,Hour,TotalCount,,\nBriggate,02-Mar-23,2,11,,\n,,,,,\n",
    "c (2) [x]+{y}.csv": "Location,Date,Hour,InCount,ReportCount\nAlbion,02/03/23,01:00,99,5\nAlbion,02/03/23,02:00,99,\n",
    "d.csv": "LocationName,Date,Hour,ReportCount\nBriggate,02/03/23,,700\n",
    "e.csv": "Date,Hour,LocationName,Count,Note\n2023-03-02,3.0,\"Head, row\",7.0,x\n2023-03-02,4.0,Head,8,\n",
    "empty.csv": "LocationName,Date,Hour,Count\n",
    "skip%20me.csv": "Anything,Else\n1,2\n",
}


@pytest.fixture
def raw_root(tmp_path):
    for name, content in FILES.items():
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / name).write_text(content)
    return str(tmp_path / "raw")


EXCLUDE = ["skip%20me.csv"]


def test_headers_and_layouts(spark, raw_root):
    headers = csv_layouts.file_headers(spark, raw_root, EXCLUDE)
    found = csv_layouts.layouts(headers, csv_layouts.file_headers(spark, raw_root, ()))
    assert sorted(len(lay.paths) for lay in found) == [1, 1, 1, 1, 2]
    two = next(lay for lay in found if len(lay.paths) == 2)
    assert two.header == ("LocationName", "Date", "Hour", "TotalCount", "Unnamed: 4", "Unnamed: 5")


def test_folders_of_one_layout_are_read_by_pattern(spark, tmp_path):
    for folder, header, n in [("one", "A,B", 3), ("two", "A,B", 2), ("mixed", "A,B", 1)]:
        (tmp_path / folder).mkdir()
        for i in range(n):
            (tmp_path / folder / f"{folder}{i}.csv").write_text(f"{header}\n1,2\n")
    (tmp_path / "mixed" / "x.csv").write_text("C\n1\n")
    every = csv_layouts.file_headers(spark, str(tmp_path), ())
    found = {lay.header: lay for lay in csv_layouts.layouts(every)}
    assert [p.removeprefix("file:").removeprefix(str(tmp_path)) for p in found[("A", "B")].paths] == ["/mixed/mixed0.csv", "/one/*.csv", "/two/*.csv"]
    assert csv_layouts.read_layout(spark, found[("A", "B")]).count() == 6
    some = csv_layouts.layouts(csv_layouts.file_headers(spark, str(tmp_path), ["one1.csv"]), every)
    assert sum(csv_layouts.read_layout(spark, lay).count() for lay in some) == 6


def _bytes_read():
    """Of this process and its children, the workers, by any client."""
    own, total = os.getpid(), 0
    parents = {}
    for pid in filter(str.isdigit, os.listdir("/proc")):
        with contextlib.suppress(OSError):
            with open(f"/proc/{pid}/stat") as file:
                parents[int(pid)] = int(file.read().rsplit(")", 1)[1].split()[1])
    for pid in parents:
        at = pid
        while at in parents and at != own:
            at = parents[at]
        if at == own:
            with contextlib.suppress(OSError), open(f"/proc/{pid}/io") as file:
                total += int(file.readline().split()[1])
    return total


def test_headers_of_long_files_are_read_from_their_heads(spark, tmp_path):
    """The bytes read for a header don't grow with the file, and each file gives its own."""
    read = []
    for megabytes in (1, 1, 64):
        root = tmp_path / str(len(read))
        root.mkdir()
        for i in range(3):
            with open(root / f"long {i}+.csv", "w") as file:
                file.write(f"A,B{i}\r\n")
                file.write("some place,12345\n" * (megabytes * 2**20 // 17))
        (root / "short.csv").write_text("\ufeffC,é")
        (root / "wide.csv").write_text(",".join(f"column {i}" for i in range(20_000)) + "\r1\r")
        (root / "empty.csv").write_text("")
        before = _bytes_read()
        headers = csv_layouts.file_headers(spark, str(root), ()).collect()
        read.append(_bytes_read() - before)
        found = {r.source_file: list(r.header) for r in headers}
        assert len(found.pop("wide.csv")) == 20_000
        assert found == {"long 0+.csv": ["A", "B0"], "long 1+.csv": ["A", "B1"], "long 2+.csv": ["A", "B2"], "short.csv": ["C", "é"]}
    assert read[2] < read[1] + 32 * 2**20, read
    before = _bytes_read()
    spark.read.text(str(root)).agg(F.max("value")).collect()
    assert _bytes_read() - before > 192 * 2**20  # a text scan is seen


def test_headers_where_only_spark_can_open_the_files(spark, tmp_path, monkeypatch):
    (tmp_path / "a b.csv").write_text("A,B\n" + "1,2\n" * 100_000)
    (tmp_path / "c.csv").write_text("C\n1\n")
    (tmp_path / "empty.csv").write_text("")
    heads = {tuple(r) for r in csv_layouts._first_lines(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(csv_layouts, "_heads", lambda batches: (b[["path"]].assign(line=None, opened=False) for b in batches))
    scanned = {tuple(r) for r in csv_layouts._first_lines(spark, str(tmp_path)).collect()}
    assert heads == scanned and len(heads) == 2
    assert csv_layouts._head("nosuch://host/a.csv", "nosuch://host/a.csv") == (None, False)


def test_workers_need_no_path_to_the_package(tmp_path):
    """Started from another folder, with the repository on the driver's path only."""
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("LocationName,Date,Hour,Count\nB,02/03/23,1,4\n")
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
from kerbside.sources import csv_layouts
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", [f.count() for f in csv_layouts.read_layouts(spark, {str(tmp_path / 'raw')!r})])
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS [1]" in done.stdout, done.stderr[-2000:]


def test_rows_with_other_cells_fail_or_go_apart(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    lines = ["LocationName,Date,Hour,Count", "B,02/03/23,1,4", "B,02/03/23,2,5,more", "B,02/03/23,3", "B,02/03/23,4,12.7", "B,soon,5,1", ",02/03/23,6,1"]
    (tmp_path / "raw" / "a.csv").write_text("\n".join(lines) + "\n")
    at = [str(tmp_path / n) for n in ("raw", "done", "table")]
    with pytest.raises(Exception):
        loads.load_leeds(spark, *at)
    table = loads.load_leeds(spark, *at, on_error="quarantine")
    assert [r.total_footfall for r in table.collect()] == [4]
    assert sorted(r.reason for r in loads.quarantined(spark, at[2]).collect()) == ["cells", "cells", "count", "date"]


def test_fractions_are_no_counts(spark):
    raw = spark.createDataFrame([("B", "02/03/23", "1", "12.7")], "LocationName string, Date string, Hour string, Count string")
    with pytest.raises(Exception, match="unreadable count"):
        cleaning.clean_leeds(raw).collect()
    york = spark.createDataFrame([("02/03/2023 14:00", "P", "1.5"), ("soon", "P", "1"), ("02/03/2023 15:00", "P", None)], "Date string, LocationName string, InCount string")
    with pytest.raises(Exception, match="unreadable"):
        cleaning.clean_york(york).collect()
    assert cleaning.clean_york(york, on_error="quarantine").count() == 1
    assert sorted(r.reason for r in cleaning.unreadable_york(york).collect()) == ["count", "date"]


def test_york_load_sets_bad_rows_apart(spark, tmp_path):
    (tmp_path / "y.csv").write_text("Date,LocationName,InCount\n02/03/2023 14:00,P,1\n02/03/2023 15:00,P,x\n02/03/2023 16:00,P,1,2\n")
    at = [str(tmp_path / n) for n in ("y.csv", "raw", "done", "table")]
    assert loads.load_york(spark, *at, on_error="quarantine").count() == 1
    assert sorted(r.reason for r in loads.quarantined(spark, at[3]).collect()) == ["cells", "count"]
    with pytest.raises(Exception):
        loads.load_york(spark, *at)


def test_load_of_what_the_catalogue_lists(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for name in ("My_file.csv", "Christmas_analysis.csv", "other.csv"):
        (tmp_path / "raw" / name).write_text(f"LocationName,Date,Hour,Count\n{name},02/03/23,1,4\n")
    url = "https://data.example/f"
    doc = {"resources": {str(i): {"format": kind, "url": f"{url}/{name}"} for i, (kind, name) in enumerate([
        ("csv", "My%20file.csv"), ("csv", "My%20file.csv"), ("csv", "Christmas%20analysis.csv"), ("xls", "other.csv")])}}
    docs = spark.createDataFrame([(1, json.dumps(doc))], "doc_id long, body string")
    at = [str(tmp_path / n) for n in ("raw", "done", "table")]
    assert [r.footfall_location for r in loads.load_leeds_catalogue(spark, docs, *at).collect()] == ["My_file.csv"]
    # without a catalogue the known stray file stays out by default
    assert loads.load_leeds(spark, *at).filter("footfall_location = 'Christmas_analysis.csv'").isEmpty()


def test_equal_names_in_two_folders(spark, tmp_path):
    for folder, text in [("x", "A,B\n1,2\n"), ("y", "C\n1\n2\n"), ("z", "A,B\n3,4\n5,6\n")]:
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text(text)
    headers = csv_layouts.file_headers(spark, str(tmp_path), ())
    found = csv_layouts.layouts(headers)
    counts = csv_layouts.rows_per_source(found, [csv_layouts.read_layout(spark, lay) for lay in found])
    summary = quality.file_summary(headers, counts)
    assert sorted((r.filename, r.columns_str, r.rows) for r in summary.collect()) == [("a.csv", "A, B", 3), ("a.csv", "C", 2)]


def test_repeated_names():
    assert csv_layouts.column_names(["Count", "", "count", "Count"]) == ["Count", "Unnamed: 1", "count.1", "Count.2"]


def clean_all(spark, raw_root):
    raw = csv_layouts.read_layouts(spark, raw_root, EXCLUDE)
    return raw, [cleaning.clean_leeds(f) for f in raw]


def test_cleaning(spark, raw_root):
    rows = cleaning.union_cleaned(clean_all(spark, raw_root)[1])
    at = lambda h: dt.datetime(2023, 3, 2, h)
    assert sorted(map(tuple, rows.collect())) == [
        ("Leeds", "Albion", at(1), 5),      # ReportCount before InCount
        ("Leeds", "Briggate", at(1), 10),
        ("Leeds", "Briggate", at(2), 11),   # in two files, once here
        ("Leeds", "Head, row", at(3), 7),   # the other row of that file has a null note
    ]
    assert dict(rows.dtypes)["total_footfall"] == "bigint"


def test_preferred_column_is_chosen_by_name_not_value(spark):
    raw = spark.createDataFrame(
        [("Briggate", "02/03/23", "1", None, "4")], "LocationName string, Date string, Hour string, ReportCount string, Count string"
    )
    assert cleaning.clean_leeds(raw).count() == 0
    with pytest.raises(ValueError):
        preferred_name(["a"], ["b"])


def test_nameless_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "_c1", "UNNAMED: 2"])
    assert drop_nameless(df).columns == ["a"]


def test_unreadable_rows(spark):
    raw = spark.createDataFrame(
        [("B", "02/03/23", "1", "4"), ("B", "02/03/23", "25", "4"), ("B", "soon", "1", "4"), ("B", "soon", None, "4")],
        "LocationName string, Date string, Hour string, Count string",
    )
    with pytest.raises(Exception, match="unreadable"):
        cleaning.clean_leeds(raw).collect()
    assert cleaning.clean_leeds(raw, on_error="quarantine").count() == 1
    assert sorted(r.reason for r in cleaning.unreadable_leeds(raw).collect()) == ["date", "hour"]


def test_york(spark):
    raw = spark.createDataFrame(
        [("02/03/2023 14:00", "Parliament", "12.0"), ("02/03/2023 15:00", "Parliament", None)],
        "Date string, LocationName string, InCount string",
    )
    rows = cleaning.clean_york(raw).orderBy("timestamp").collect()
    assert [tuple(r) for r in rows] == [
        ("York", "Parliament", dt.datetime(2023, 3, 2, 14), 12),
        ("York", "Parliament", dt.datetime(2023, 3, 2, 15), 0),
    ]


def test_load_keeps_blanks_and_quotes(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "q.csv").write_text('LocationName,Date,Hour,Count\n" The ""Shambles"" ",02/03/23,1,4\n')
    table = loads.load_leeds(spark, str(tmp_path / "raw"), str(tmp_path / "done"), str(tmp_path / "table"))
    assert [r.footfall_location for r in table.collect()] == [' The "Shambles" ']


def test_profile(spark, raw_root):
    headers = csv_layouts.file_headers(spark, raw_root, EXCLUDE)
    found = csv_layouts.layouts(headers, csv_layouts.file_headers(spark, raw_root, ()))
    frames = [csv_layouts.read_layout(spark, lay) for lay in found]
    counts = csv_layouts.rows_per_source(found, frames)
    summary = quality.file_summary(headers, counts, drop_unnamed=True)
    by_name = {r.filename: r for r in summary.collect()}
    assert by_name["empty.csv"].rows == 0
    assert by_name["a.csv"].columns_str == "Date, Hour, LocationName, TotalCount"
    assert quality.file_summary(headers, counts).filter("filename = 'a.csv'").first().columns_cnt == 6
    profile = {r.columns_str: r for r in quality.layout_profile(summary).collect()}
    assert [profile[k].column_group for k in sorted(profile)] == list(range(5))
    assert profile["Date, Hour, LocationName, TotalCount"].total_files == 2
    sample = {r.columns_str: r.filename for r in quality.layout_sample(summary).collect()}
    assert sample["Date, Hour, LocationName, TotalCount"] == "a.csv"
    noted = next(f for f in frames if "Note" in f.columns)
    first = quality.preview(noted, sample["Count, Date, Hour, LocationName, Note"], 1).collect()
    assert [(r.Hour, r.LocationName, r.Note) for r in first] == [("3.0", "Head, row", "x")]


def test_reconciliation(spark, raw_root):
    raw, _ = clean_all(spark, raw_root)
    told = quality.reconcile([cleaning.tagged_leeds(f) for f in raw])
    row = told.first()
    # each layout is read once
    assert told._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == len(raw)
    assert row.asDict() == {
        "raw_rows": 9, "daily_totals": 2, "null_rows": 2, "duplicates": 1, "cleaned_rows": 4, "unexplained": 0,
    }


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert quality.duplicate_rows(df).first()[0] == 2
    assert quality.missing_values(df).first().asDict() == {"a": 0, "b": 3, "total_missing": 3}


def test_broken_catalogue_fails(spark):
    docs = spark.createDataFrame([(1, "{'resources': oops"), (2, '{"resources": {}}')], "doc_id long, body string")
    with pytest.raises(Exception):
        catalogue.csv_files(docs).collect()


def test_catalogue(spark):
    base = "https://data.example/f"
    doc = {"resources": {
        "1": {"format": "csv", "url": f"{base}/My%20file.csv"},
        "2": {"format": "xls", "url": f"{base}/My%20file.csv"},
        "3": {"format": "csv", "url": f"{base}/Christmas%20analysis.csv"},
        "0": {"format": "csv", "url": f"{base}/v2/My%20file.csv"},
    }}
    docs = spark.createDataFrame([(1, json.dumps(doc))], "doc_id long, body string")
    assert [tuple(r) for r in catalogue.csv_files(docs).collect()] == [(1, "My_file.csv", "0", f"{base}/v2/My%20file.csv")]
    # a name is compared as it stands in the address
    assert catalogue.csv_files(docs, ["My file.csv", "My_file.csv"]).filter(F.col("file_name") == "My_file.csv").count() == 1


def test_repeated_header_names_are_read(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "r.csv").write_text("LocationName,Date,Hour,Count,Count,a.b\nB,02/03/23,1,4,5,x\nB,02/03/23,2,4,,x\n")
    rows = cleaning.clean_leeds(csv_layouts.read_layouts(spark, str(tmp_path / "raw"))[0]).collect()
    assert [r.total_footfall for r in rows] == [4]
