"""Malformed records are marked, kept with their file, and change no good row."""

import pytest
from pyspark.sql import functions as F

from arrivals.sources import read_delimited
from arrivals.sources.checked import FILE, LINE, PROBLEM, header_names, read_checked, reject_report, split

MIXED = '''\
a,b
1,2
3,4,5
6
"7,8
"x, y","he said \\"no\\""
"say ""a, b""",ok
,
"""quoted""",9

5" pipe,"10"
"11" x,12
13,"14
15,16
'''


@pytest.fixture
def rows(spark, write_text):
    return read_checked(spark, write_text("mixed.csv", MIXED), ["a", "b"])


def test_malformed_records_are_marked_with_their_text(rows):
    bad = {r[LINE]: r[PROBLEM] for r in rows.where(F.col(PROBLEM).isNotNull()).collect()}
    assert bad == {"3,4,5": "fields", "6": "fields", '"7,8': "fields", '"11" x,12': "quote", '13,"14': "quote",
                   '"say ""a, b""",ok': "fields"}  # doubled quotes are no escape unless the options say so


def test_good_rows_are_those_of_the_plain_reader(spark, rows, write_text):
    good = sorted(map(str, split(rows)[0].collect()))
    bad = ("3,4,5", "6", '"7,8', '"11" x,12', '13,"14', '"say ""a, b""",ok')
    clean = "\n".join(x for x in MIXED.split("\n") if x not in bad)
    plain = read_delimited(spark, write_text("clean.csv", clean), ["a", "b"])
    assert good == sorted(map(str, plain.collect())) and len(good) == 6


def test_doubled_quotes_as_escape(spark, write_text):
    lines = ['"say ""a, b""",ok', '"""q""",""', '"x""",1', '"x"",1', '1,"', '1,""""', 'a"b,c"']
    path = write_text("doubled.csv", "a,b\n" + "\n".join(lines) + "\n")
    rows = read_checked(spark, path, ["a", "b"], escape='"')
    assert sorted(r[LINE] for r in rows.where(F.col(PROBLEM).isNotNull()).collect()) == sorted(['"x"",1', '1,"'])
    assert {tuple(r) for r in split(rows)[0].collect()} == {
        ('say "a, b"', "ok"), ('"q"', None), ('x"', "1"), ("1", '"'), ('a"b', 'c"')}


def test_rejects_are_counted_per_file_and_found_by_each_header(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "one.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    (d / "two.csv").write_text("﻿B;x\n")
    (d / "two.csv").write_text("﻿B,A\r\nbee,ay\r\nonly\r\n")
    (d / "empty.csv").write_text("")
    rows = read_checked(spark, str(d), ["a", "b", "c"], allow_missing=["c"])
    assert sorted(map(tuple, split(rows)[0].collect()), key=str) == [("1", "2", "3"), ("ay", "bee", None)]
    assert sorted(map(tuple, reject_report(rows).collect())) == [("one.csv", 3, 2, 0, 0), ("two.csv", 2, 1, 0, 0)]
    rejects = {(r.file.rsplit("/", 1)[-1], r.line) for r in split(rows)[1].collect()}
    assert rejects == {("one.csv", "4,5"), ("one.csv", "6,7,8,9"), ("two.csv", "only")}
    with pytest.raises(ValueError, match="'c'.*two.csv"):
        read_checked(spark, str(d), ["a", "b", "c"])


def test_semicolons_blank_and_repeated_names(spark, write_text):
    assert header_names('x;"a;b";;X', ";") == ["x0", "a;b", None, "X3"]
    path = write_text("s.csv", "id;;name\n1;junk;n1\n2;n2\n3;;\n")
    rows = read_checked(spark, path, ["id", "name"], sep=";")
    assert sorted(map(tuple, split(rows)[0].collect())) == [("1", "n1"), ("3", None)]
    assert [r.line for r in split(rows)[1].collect()] == ["2;n2"]


def test_json_lines(spark, write_text):
    path = write_text("in.json", '{"a": 1, "b": "x"}\n{"a": 2\n\nnot json\n{"b": null, "z": 1}\n[1]\n')
    rows = read_checked(spark, path, ["a", "b"], fmt="json")
    assert sorted(map(tuple, split(rows)[0].collect()), key=str) == [("1", "x"), (None, None)]
    assert sorted(r.line for r in split(rows)[1].collect()) == ["[1]", "not json", '{"a": 2']
    with pytest.raises(ValueError, match="parquet"):
        read_checked(spark, path, ["a"], fmt="parquet")


def test_no_files_and_extra_columns(spark, write_text):
    empty = read_checked(spark, write_text("none.csv", ""), ["a"])
    assert empty.columns == ["a", FILE, PROBLEM, LINE] and empty.count() == 0
    only = read_checked(spark, write_text("h.csv", "a,b\n"), ["b"])
    assert only.count() == 0
