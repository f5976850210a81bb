import pytest

from arrivals.sources import read_delimited, read_inferred, read_lookup, read_parquet, read_table


def test_header_csv_read_by_name_not_position(spark, write_text):
    a = write_text("a.csv", "cicid,i94yr\n1.0,2016.0\n")
    b = write_text("b.csv", "i94yr,cicid\n2017.0,2.0\n")
    rows = sorted(tuple(r) for r in read_delimited(spark, [a], ["cicid", "i94yr"]).union(
        read_delimited(spark, [b], ["cicid", "i94yr"])).collect())
    assert rows == [("1.0", "2016.0"), ("2.0", "2017.0")]


def test_blank_header_cell_is_dropped(spark, write_text):
    p = write_text("blank.csv", ",cicid,i94yr\n0,1.0,2016.0\n")
    df = read_table(spark, p, "csv")
    assert df.columns == ["cicid", "i94yr"]


def test_missing_column_raises_or_fills(spark, write_text):
    p = write_text("m.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="'c'"):
        read_delimited(spark, p, ["a", "c"])
    df = read_delimited(spark, p, ["a", "c"], allow_missing=True)
    assert [tuple(r) for r in df.collect()] == [("1", None)]


def test_semicolon_file(spark, write_text):
    p = write_text("d.csv", "City;State;Foreign-born\nAlder Point;Maryland;30100.0\n")
    df = read_delimited(spark, p, ["City", "Foreign-born"], sep=";")
    assert [tuple(r) for r in df.collect()] == [("Alder Point", "30100.0")]


def test_lookup_quoted_label_and_string_codes(spark, write_text):
    p = write_text("port.csv", 'ID,Port\nALC,"ALCAN, AK"\n060,"PORT, X"\n.GA,"NO PORT CODE"\nABC ,"\u00a0SPACE\u00a0"\n')
    rows = [tuple(r) for r in read_lookup(spark, p).collect()]
    assert rows == [("ALC", "ALCAN, AK"), ("060", "PORT, X"), (".GA", "NO PORT CODE"), ("ABC", "SPACE")]


def test_inferred_types(spark, write_text):
    p = write_text("t.csv", "a,b,c\n1,2.5,x\n3,4.0,y\n")
    df = read_inferred(spark, p)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "double", "string"]


def test_format_parameter_json_and_parquet(spark, tmp_path):
    src = spark.createDataFrame([(1, "a")], "id long, v string")
    src.write.json(str(tmp_path / "j"))
    src.write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "j"), "json", columns=["v", "id"]).collect()[0].asDict() == {"v": "a", "id": 1}
    assert read_parquet(spark, str(tmp_path / "p"), ["v"]).columns == ["v"]


def _folder(tmp_path, files):
    d = tmp_path / "folder"
    d.mkdir()
    for name, text in files.items():
        (d / name).write_text(text, encoding="utf-8")
    return str(d)


def test_every_file_of_a_folder_is_read_by_its_own_header(spark, tmp_path):
    d = _folder(tmp_path, {
        "a.csv": "cicid,i94addr,gender\n1,WA,M\n",
        "b.csv": "gender,cicid,i94addr\nF,2,NY\nM,3,CA\n",
        "c.CSV": "I94ADDR,gender,CICID\nTX,F,4\n",
        "d[1].csv": "cicid,i94addr\n5,OR\n",
        "empty.csv": "",
    })
    df = read_delimited(spark, d, ["cicid", "i94addr", "gender"], allow_missing=["gender"])
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "WA", "M"), ("2", "NY", "F"), ("3", "CA", "M"), ("4", "TX", "F"), ("5", "OR", None)]
    with pytest.raises(ValueError, match=r"'gender' not found in .*d\[1\]\.csv"):
        read_delimited(spark, d, ["cicid", "gender"])


def test_many_rows_and_splits_keep_their_header(spark, tmp_path):
    d = _folder(tmp_path, {
        f"{k}.csv": ("a,b\n" if k % 2 else "b,a\n") + "".join(f"{'x' if k % 2 else 'y'}{i},{'y' if k % 2 else 'x'}{i}\n" for i in range(3000))
        for k in range(4)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_delimited(spark, d, ["a", "b"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 12000 and all(r.a[0] == "x" and r.b[0] == "y" and r.a[1:] == r.b[1:] for r in rows)


def test_only_blank_header_cells_are_dropped(spark, tmp_path, write_text):
    src = spark.createDataFrame([(1, 2, "x")], "id int, _count int, _city string")
    src.write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p"), "parquet").columns == ["id", "_count", "_city"]
    assert read_delimited(spark, write_text("n.csv", "_c0,,_city\n1,2,3\n")).columns == ["_c0", "_city"]


def test_mixed_headers_infer_in_one_scan(spark, tmp_path):
    """Types by column name over all files, narrowest first; the same on any partitioning."""
    d = _folder(tmp_path, {
        "a.csv": "a,b,c,d\n1,2,x,2020-01-02\n,3000000000,,2020-01-03\n",
        "b.csv": "b,a,e,f\n2,1.5,true,2020-01-02 03:04:05\n,2,FALSE,2020-01-02\n",
        "c.csv": "g,h,i\n12345678901234567890,,007\n5,,-8\n",
    })
    df = read_inferred(spark, d)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types == {"a": "double", "b": "bigint", "c": "string", "d": "date", "e": "boolean", "f": "timestamp",
                     "g": "decimal(38,0)", "h": "string", "i": "int"}
    assert sorted((r.a, r.b) for r in df.where("a is not null and b is not null").collect()) == [(1.0, 2), (1.5, 2)]
    assert [int(r.g) for r in df.where("g is not null").orderBy("g").collect()] == [5, 12345678901234567890]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        assert read_inferred(spark, d).schema == df.schema
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
