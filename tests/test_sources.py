"""Readers over small files, and streams that run to completion."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from larkspur.functions import scalars as C
from larkspur.sources import series_files as R
from larkspur.streaming import ingest


def test_observations_skip_missing_values(spark, tmp_path):
    (tmp_path / "GDP.json").write_text(json.dumps({"observations": [{"date": "2026-01-01", "value": "1.5"}, {"date": "2026-02-01", "value": "."}, {"date": "2026-03-01", "value": ""}]}))
    assert [(r.series_id, str(r.d), r.v) for r in R.observations_json(spark, str(tmp_path)).collect()] == [("GDP", "2026-01-01", 1.5)]


def test_quotes_drop_null_closes(spark, tmp_path):
    (tmp_path / "X.json").write_text(json.dumps({"timestamp": [1767225600, 1767312000], "close": [1.23456, None]}))
    assert [(str(r.d), r.v) for r in R.quotes_json(spark, str(tmp_path)).collect()] == [("2026-01-01", 1.2346)]


def test_daily_prefers_the_adjusted_close(spark, tmp_path):
    (tmp_path / "T.json").write_text(json.dumps([{"date": "2026-01-01T00:00:00Z", "close": 2.0, "adjClose": 1.0}, {"date": "2026-01-02", "close": 3.0}]))
    assert sorted(r.v for r in R.daily_json(spark, str(tmp_path)).collect()) == [1.0, 3.0]


def test_cached_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# GDP | fred | 2026-02-03\ndate,value\n2026-01-01,1\n2026-01-02,.\n2026-01-03,2\n")
    got = R.cached_csv(spark, str(tmp_path)).orderBy("d").collect()
    assert [(r.series_id, r.source, str(r.fetched), r.v) for r in got] == [("GDP", "fred", "2026-02-03", 1.0), ("GDP", "fred", "2026-02-03", 2.0)]
    R.write_cache(R.cached_csv(spark, str(tmp_path)), str(tmp_path / "cache"))
    assert R.read_cache(spark, str(tmp_path / "cache"), "2026-02-03").count() == 2


def test_month_tables_keep_the_first_of_repeated_dates(spark, tmp_path):
    (tmp_path / "2330_1.json").write_text(json.dumps({"fields": ["date col", "open", "close price"], "data": [["115/01/02", "1", "1,234.5"], ["115/01/02", "1", "9"], ["bad", "1", "2"], ["115/02/30", "1", "2"]]}))
    got = R.month_tables(spark, str(tmp_path), "date", "close").collect()
    assert [(r.series_id, str(r.d), r.v) for r in got] == [("2330", "2026-01-02", 1234.5)]


def workbook(rows):
    cells = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{c}</t></is></c>' for c in r) + "</row>" for r in rows)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="x"><sheetData>{cells}</sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", '<worksheet xmlns="x"><sheetData/></worksheet>')
    return data.getvalue()


def test_content_kinds_encodings_and_workbooks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿d,v\n1,é\n".encode())
    (tmp_path / "b.csv").write_bytes("d,v\n1,é\n".encode("cp1252"))
    (tmp_path / "c.bin").write_bytes(b"\x00\x01\x02abc")
    (tmp_path / "d.json").write_bytes("﻿[1]".encode())
    (tmp_path / "e.xlsx").write_bytes(workbook([["title"], ["a", "b", "c"], *[[str(i), "x", "y"] for i in range(130)]]))
    kinds = {r.path[-6:]: r.k for r in spark.read.format("binaryFile").load(str(tmp_path)).select("path", R.kind_of(F.col("content")).alias("k")).collect()}
    assert kinds == {"/a.csv": "csv", "/b.csv": "csv", "/c.bin": "binary", "d.json": "json", "e.xlsx": "xlsx"}
    cells = R.delimited_files(spark, str(tmp_path)).where("n = 1").collect()
    assert [r.cells for r in cells] == [["1", "é"], ["1", "é"]]
    rows = R.workbooks(spark, str(tmp_path)).orderBy("n").collect()
    assert rows[0].cells == ["a", "b", "c"] and len(rows) == 121 and rows[0].dropped == 10 and rows[-1].cells[0] == "129"


def test_find_column():
    names = ["Report Date", "Open Interest (All)", "Open Interest Old"]
    assert R.find_column(names, "open_interest_all", []) == names[1]
    assert R.find_column(names, "x", ["open", "interest"], ["all"]) == names[2]
    with pytest.raises(KeyError):
        R.find_column(names, "x", ["price"])
    dates = ["As_of_Report_Date_YYMMDD", "Report_Date_as_MM_DD_YYYY"]
    assert R.find_column(dates, "Report_Date_as_YYYY-MM-DD", ["reportdate"], ["asof"]) == dates[1]
    assert R.find_column(dates, "report date as mm dd yyyy", ["nothing"]) == dates[1]


def test_nested_documents_keep_what_is_malformed(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"date": "2026-01-01", "items": ["x"]}')
    (tmp_path / "b.json").write_text('{"date": ')
    got = R.nested_documents(spark, str(tmp_path), "date string, items array<string>").collect()
    assert sorted(r.malformed is None for r in got) == [False, True]


def test_routes(spark):
    ids = ["2330", "^GSPC", "GC=F", "DGS10", "x"]
    got = [r.r for r in spark.createDataFrame([(i,) for i in ids], "i string").select(R.route(F.col("i")).alias("r")).collect()]
    assert got == ["exchange", "quotes", "quotes", "observations", "ambiguous"]


def test_scalar_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(C.match_form(F.lit("“It’s ,  here” – yes no"))) == '"It\'s, here" - yes no'
    assert one(C.match_form(F.lit("a ( b ) foo . bar - x"))) == "a (b) foo. bar - x"
    assert one(C.visible_chars(F.lit("## A _b_ # c\n- d **e**"))) == 8
    assert one(C.is_article(F.lit("https://a.com/story-one"))) and not one(C.is_article(F.lit("https://a.com/x/Topics/?a=b"))) and not one(C.is_article(F.lit("https://a.com")))
    assert one(C.number(F.lit("1,234.5"))) == 1234.5 and one(C.number(F.lit("--"))) is None
    assert one(C.roc_date(F.lit("115/02/30"))) is None and str(one(C.roc_date(F.lit("115/8/1")))) == "2026-08-01"
    assert one(C.visible_width(F.lit("a中"))) == 3 and one(C.seconds(F.lit("1:02:03"))) == 3723
    assert one(C.clip(F.lit(None).cast("double"), 0.0, 100.0)) is None
    assert one(C.words(F.lit("[00:01] Ann Lee: Hello, World!"))) == ["ann", "lee", "hello", "world"]


def test_streams_remember_between_rounds(spark, tmp_path):
    rows = lambda data: spark.createDataFrame(data, "k long, ts timestamp, bad boolean")
    import datetime as dt

    at = lambda h: dt.datetime(2026, 1, 1, h)
    first, second = rows([(1, at(1), True), (1, at(2), True), (2, at(1), False)]), rows([(1, at(3), True), (1, at(4), True), (2, at(2), True)])
    inp, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part, seen in ((first, {1: 0, 2: 0}), (second, {1: 2, 2: 0})):
        part.coalesce(1).write.mode("append").parquet(inp)
        stream = spark.readStream.schema(first.schema).parquet(inp)
        ingest.run_once(ingest.breaker(stream, "k", ["ts"], "bad"), ingest.replacing(out), str(tmp_path / "state"), "update")
        schema = spark.createDataFrame([], "k long, skipped long, open boolean").schema
        last = ingest.result(spark, out, schema, "update", ["k"]).collect()
        assert {r.k: r.skipped for r in last} == seen and len(last) == 2
    found = str(tmp_path / "found")
    for _ in range(2):
        stream = spark.readStream.schema(first.schema).parquet(inp)
        ingest.run_once(ingest.discover(stream, ["k"], "ts"), ingest.replacing(found), str(tmp_path / "state2"), "append")
    assert spark.read.parquet(found).count() == 2


def test_windows_of_a_second_round_replace_those_of_the_first(spark, tmp_path):
    import datetime as dt

    inp, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in (1, 2):
        rows = spark.createDataFrame([("a", dt.datetime(2026, 1, 1, n))], "k string, ts timestamp")
        rows.coalesce(1).write.mode("append").parquet(inp)
        stream = ingest.windowed_counts(spark.readStream.schema(rows.schema).parquet(inp), "ts", "k", "1 day", "2 days")
        ingest.run_once(stream, ingest.replacing(out), str(tmp_path / "state"), "complete")
        assert [r.n for r in ingest.result(spark, out, stream.schema, "complete").collect()] == [n]


def test_quoted_cells(spark):
    rows = ['2024-01-01,"1,234"', '"a ""b""",,"c"', "x,y", '""']
    got = spark.createDataFrame([(r,) for r in rows], "l string").select(R.cells(F.col("l")).alias("c")).collect()
    assert [r.c for r in got] == [["2024-01-01", "1,234"], ['a "b"', "", "c"], ["x", "y"], [""]]


def test_nested_documents_may_have_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b"\xef\xbb\xbf" + b'{"k": "a",\n "n": 1}')
    (tmp_path / "b.json").write_bytes(b'{"k": "b", "n": 2}')
    (tmp_path / "c.json").write_bytes(b"\xef\xbb\xbf{")
    got = R.nested_documents(spark, str(tmp_path), "k string, n int").orderBy("n").collect()
    assert [(r.k, r.n, r.malformed) for r in got] == [(None, None, "{"), ("a", 1, None), ("b", 2, None)]


def test_a_table_has_a_delimiter_in_its_first_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("just words\n1,2\n")
    assert R.delimited_files(spark, str(tmp_path)).select("cells").collect() == [(["a", "b"],), (["1", "2"],)]
    (tmp_path / "t.csv").write_text("a\tb\n")
    assert [r.cells for r in R.delimited_files(spark, str(tmp_path), "\t").collect()] == [["a", "b"]]


def test_batches_say_how_each_item_went(spark, tmp_path):
    rows = [("a", bytearray(b"{}"), None, 2), ("b", None, "timed out\nmore", None), ("c", bytearray(b""), None, 0), ("d", bytearray(b"[]"), None, 0), ("e", bytearray(b"[]"), None, 0), ("f", bytearray(b"\x00\x01"), None, 1)]
    items = spark.createDataFrame(rows, "item string, content binary, error string, rows_ok int")
    judged = R.judged_items(items, required=["d"])
    assert {r["item"]: (r.status, r.reason) for r in judged.collect()} == {
        "a": ("ok", None), "b": ("failed", "upstream: timed out"), "c": ("failed", "no content"), "d": ("failed", "no rows"), "e": ("ok", None), "f": ("failed", "binary content"),
    }
    R.write_batch(judged, f"{tmp_path}/batch")
    assert spark.read.parquet(f"{tmp_path}/batch").count() == 6
    with pytest.raises(ValueError):
        R.write_batch(items, f"{tmp_path}/other")


def test_panels(spark, tmp_path):
    import json

    series = spark.sql("SELECT * FROM VALUES ('a b', DATE '2026-01-02', 1.5D), ('c', DATE '2026-01-02', 2D), ('c', DATE '2026-01-01', 3D) t(series_id, d, v)")
    for kind in ("csv", "records", "index"):
        R.write_panel(series, f"{tmp_path}/{kind}", kind)
    lines = [r.value for r in spark.read.text(f"{tmp_path}/csv").collect()]
    assert lines == ["d,a b,c", "2026-01-01,,3.0", "2026-01-02,1.5,2.0"] or sorted(set(lines)) == ["2026-01-01,,3.0", "2026-01-02,1.5,2.0", "d,a b,c"]
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/records").collect()) == ['{"d":"2026-01-01","c":3.0}', '{"d":"2026-01-02","a b":1.5,"c":2.0}']
    index = {k: v for r in spark.read.text(f"{tmp_path}/index").collect() for k, v in json.loads(r.value).items()}
    assert index == {"2026-01-01": {"c": 3.0}, "2026-01-02": {"a b": 1.5, "c": 2.0}}
    with pytest.raises(ValueError):
        R.write_panel(series, f"{tmp_path}/x", "yaml")
