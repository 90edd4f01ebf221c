import json
import os

import pytest

from chanfold.plans import raw_files
from chanfold.sources import ingest as ing
from chanfold.sources import readers as rd
from chanfold.sources import xlsx


def _touch(path, text="a\n1\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_discovery_rules(spark, tmpdir_path):
    d = tmpdir_path
    _touch(f"{d}/sales.csv")
    _touch(f"{d}/X.CSV")                   # case-sensitive suffix: ignored
    _touch(f"{d}/notes.txt")               # unknown format: ignored
    _touch(f"{d}/archive/old.csv")         # sub-folder without suffix: ignored
    _touch(f"{d}/events.ndjson/part-0.json", '{"a": 1}\n')   # Spark-written folder
    cat = [(r["name"], r["format"], r["n_files"]) for r in rd.discover_sources(spark, d).collect()]
    assert cat == [("events", ".ndjson", 1), ("sales", ".csv", 1)]


def test_duplicate_stem_is_an_error(spark, tmpdir_path):
    _touch(f"{tmpdir_path}/sales.csv")
    _touch(f"{tmpdir_path}/sales.json", "[]")
    with pytest.raises(ValueError, match="share the name"):
        ing.catalog_rows(spark, tmpdir_path)


def test_empty_folder_and_unknown_format(spark, tmpdir_path):
    _touch(f"{tmpdir_path}/notes.txt")
    with pytest.raises(FileNotFoundError):
        ing.catalog_rows(spark, tmpdir_path)
    with pytest.raises(ValueError, match="unsupported"):
        rd.reader_for(".xml")
    with pytest.raises(FileNotFoundError):
        ing.catalog_rows(spark, f"{tmpdir_path}/missing")


def test_csv_inference_keeps_month_text(spark, tmpdir_path):
    _touch(f"{tmpdir_path}/r.csv", "country,year_month,rate\nAR,2025-01,1.5\n")
    df = rd.read_csv(spark, f"{tmpdir_path}/r.csv")
    assert dict(df.dtypes)["year_month"] == "string"


def test_json_array_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k bigint, v string")
    raw_files.write_json_array(df.repartition(2), f"{tmpdir_path}/app.json")
    for f in os.listdir(f"{tmpdir_path}/app.json"):
        if f.endswith(".txt"):
            json.load(open(f"{tmpdir_path}/app.json/{f}"))        # a valid JSON document
    back = rd.read_json_array(spark, f"{tmpdir_path}/app.json", "k bigint, v string")
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_workbook_round_trip(spark, tmpdir_path):
    schema = "id string, qty bigint, price double, name string, flag boolean"
    df = spark.createDataFrame([("0012", 3, 2.5, "a & <b>", True), ("7", None, 0.1, None, False)],
                               schema)
    n = xlsx.write_xlsx(df.repartition(2), f"{tmpdir_path}/f.xlsx")
    assert n >= 1
    back = rd.read_workbook(spark, f"{tmpdir_path}/f.xlsx", schema)
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_ingest_adds_provenance(spark, tmpdir_path):
    _touch(f"{tmpdir_path}/raw/sales.csv", "a,b\n1,x\n2,y\n")
    out = ing.ingest_all(spark, f"{tmpdir_path}/raw", f"{tmpdir_path}/bronze")
    df = out["sales"]
    assert df.columns[-2:] == ["_source", "_ingested_at"]
    vals = {(r["_source"], r["_ingested_at"]) for r in df.collect()}
    assert len(vals) == 1 and next(iter(vals))[0] == "sales.csv"
    assert ing.bronze_summary(out).first()["n_rows"] == 2
    assert set(ing.load_layer(spark, f"{tmpdir_path}/bronze")) == {"sales"}


def test_workbook_values_keep_their_meaning():
    import pytest as _pytest
    from pyspark.sql.types import BooleanType, DateType, DoubleType, LongType, StringType

    from chanfold.sources.xlsx import _converter
    assert _converter(LongType())(3.0) == 3 and _converter(LongType())("4") == 4
    with _pytest.raises(ValueError):
        _converter(LongType())(3.7)
    for text, want in (("FALSE", False), ("true", True), (0.0, False), (1.0, True), (True, True), (None, None)):
        assert _converter(BooleanType())(text) is want
    with _pytest.raises(ValueError):
        _converter(BooleanType())("No")
    with _pytest.raises(TypeError):
        _converter(DateType())
    assert _converter(DoubleType())("2.5") == 2.5 and _converter(StringType())(7.0) == "7"


def test_raw_writers_bound_files_without_a_shuffle(spark, tmp_path, monkeypatch):
    """One partition gives several documents and workbooks, each of bounded rows; all rows come back."""
    import glob

    from chanfold.plans import raw_files
    monkeypatch.setattr(raw_files, "ROWS_PER_FILE", 10)
    df = spark.range(25).selectExpr("id AS qty", "CAST(id AS STRING) AS uid").coalesce(1)
    raw_files.write_json_array(df, f"{tmp_path}/app.json")
    assert len(glob.glob(f"{tmp_path}/app.json/part-*")) == 3
    back = rd.read_json_array(spark, f"{tmp_path}/app.json", "qty bigint, uid string")
    assert sorted(map(tuple, back.collect())) == sorted((i, str(i)) for i in range(25))
    assert xlsx.write_xlsx(df, f"{tmp_path}/f.xlsx", 10) == 3
    back = rd.read_workbook(spark, f"{tmp_path}/f.xlsx", "qty bigint, uid string")
    assert sorted(map(tuple, back.collect())) == sorted((i, str(i)) for i in range(25))
    raw_files._bounded(df).option("header", True).csv(f"{tmp_path}/r.csv")
    assert len(glob.glob(f"{tmp_path}/r.csv/part-*")) == 3 and rd.read_csv(spark, f"{tmp_path}/r.csv").count() == 25


def test_plain_rows_read_as_other_rows_do(monkeypatch):
    """The one-pattern reading of a row agrees with the cell-by-cell one, or leaves the row to it."""
    bodies = [b'<c r="A1" t="inlineStr"><is><t>a &amp;amp; b</t></is></c><c r="C1"><v>1.50</v></c><c r="AB1" t="b"><v>1</v></c>',
              b'<c r="A1" t="s"><v>1</v></c><c r="B1" t="str"><v>x&lt;y</v></c><c r="D1" t="inlineStr"><is><t></t></is></c>',
              b'', b' <c r="A1" t="n"><v>7</v></c> ', 'é<c r="A1" t="inlineStr"><is><t>日本</t></is></c>'.encode()]
    odd = [b'<c r="A1" s="3"><v>1</v></c>', b'<c r="A1"/>', b'<c><v>2</v></c>', b'<x:c r="A1"><x:v>2</x:v></x:c>',
           b'<c r="A1" t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c>', b'<c r="A1" t="inlineStr"><v>1</v></c>',
           b'<c r="A1"><f>1+1</f><v>2</v></c>', b'<c r="A1"><v>1</v></c><c r="B1"/>', b'<c r="A1"><v></v></c>']
    assert all(xlsx._plain_row(b, {}, ["p", "q"]) is not None for b in bodies)
    assert all(xlsx._plain_row(b, {}, ["p", "q"]) is None for b in odd)
    sheet = b"<sheetData>" + b"".join(b"<row r=\"1\">" + b + b"</row>" for b in bodies + odd[:-1]) + b"</sheetData>"
    monkeypatch.setattr(xlsx.zipfile, "ZipFile", lambda f: __import__("contextlib").nullcontext(
        type("Z", (), {"read": lambda self, name: sheet})()))
    monkeypatch.setattr(xlsx, "_shared_strings", lambda z: ["p", "q"])
    monkeypatch.setattr(xlsx, "_first_sheet_part", lambda z: "x")
    fast = list(xlsx.iter_sheet_rows(b""))
    monkeypatch.setattr(xlsx, "_plain_row", lambda *a: None)
    assert fast == list(xlsx.iter_sheet_rows(b"")) and fast[0] == {0: "a &amp; b", 2: 1.5, 27: True}
