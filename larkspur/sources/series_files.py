"""Readers of series files into ``series_id, d, v, source``, and writers."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions.scalars import number, roc_date

COLUMNS = ("series_id", "d", "v", "source")


def _file_stem() -> Column:
    return F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[A-Za-z]+)*$", 1)


def observations_json(spark: SparkSession, path: str, source: str = "observations") -> DataFrame:
    """``{"observations": [{"date", "value"}]}`` per file; ``.`` and empty values are missing, not zero."""
    schema = "observations array<struct<date:string,value:string>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(
        _file_stem().alias("series_id"), F.explode("observations").alias("o")
    )
    v = F.nullif(F.col("o.value"), F.lit(".")).try_cast("double")
    return rows.select("series_id", F.col("o.date").try_cast("date").alias("d"), v.alias("v"), F.lit(source).alias("source")).where(
        "v IS NOT NULL AND d IS NOT NULL"
    )


def quotes_json(spark: SparkSession, path: str, source: str = "quotes") -> DataFrame:
    """Parallel arrays ``timestamp`` (epoch seconds) and ``close``; null closes are dropped, values rounded to 4."""
    schema = "timestamp array<bigint>, close array<double>"
    pairs = spark.read.schema(schema).option("multiLine", True).json(path).select(
        _file_stem().alias("series_id"), F.explode(F.arrays_zip("timestamp", "close")).alias("q")
    )
    return pairs.where("q.close IS NOT NULL").select(
        "series_id", F.to_date(F.timestamp_seconds("q.timestamp")).alias("d"), F.round("q.close", 4).alias("v"), F.lit(source).alias("source")
    )


def daily_json(spark: SparkSession, path: str, source: str = "daily") -> DataFrame:
    """A list of ``{date, close, adjClose}``: the adjusted close where there is one."""
    rows = spark.read.schema("date string, close double, adjClose double").option("multiLine", True).json(path)
    return rows.select(
        _file_stem().alias("series_id"), F.left("date", F.lit(10)).try_cast("date").alias("d"), F.coalesce("adjClose", "close").alias("v"), F.lit(source).alias("source")
    ).where("v IS NOT NULL")


def cached_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cached series: a line ``# ident | source | fetched``, then ``date,value``; rows that don't parse are skipped."""
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    head = rows.where(F.col("value").startswith("#")).select(
        "file", *(F.trim(F.split(F.ltrim(F.col("value"), F.lit("# ")), r"\|")[i]).alias(n) for i, n in enumerate(("series_id", "source", "fetched")))
    )
    part = F.split("value", ",")
    points = rows.where(~F.col("value").startswith("#")).select("file", F.try_element_at(part, F.lit(1)).try_cast("date").alias("d"), F.try_element_at(part, F.lit(2)).try_cast("double").alias("v"))
    return points.where("d IS NOT NULL AND v IS NOT NULL").join(head, "file").select(*COLUMNS, F.col("fetched").try_cast("date").alias("fetched"))


def find_column(names: list[str], exact: str, need: list[str], avoid: list[str] = ()) -> str:
    """The column that equals ``exact`` when only letters and digits count, else the first with all of ``need`` and none of ``avoid``."""
    bare = lambda s: re.sub(r"[\W_]", "", s.lower())
    forms, words, others = [(bare(n), n) for n in names], list(map(bare, need)), list(map(bare, avoid))
    same = [n for form, n in forms if form == bare(exact)]
    fitting = [n for form, n in forms if all(w in form for w in words) and not any(w in form for w in others)]
    if not same + fitting:
        raise KeyError(f"no column like {exact!r}")
    return (same + fitting)[0]


def month_tables(spark: SparkSession, path: str, date_header: str, value_header: str, source: str = "months") -> DataFrame:
    """``{"fields": [...], "data": [[...]]}`` per month; columns are found by keyword, dates count from 1911, the first of repeated dates stays."""
    rows = spark.read.schema("fields array<string>, data array<array<string>>").option("multiLine", True).json(path)
    place = lambda word: F.array_position(F.transform("fields", lambda f: F.contains(f, F.lit(word))), True)
    cell = lambda word: F.try_element_at(F.col("row"), F.col(word).cast("int"))
    cells = rows.select(
        F.input_file_name().alias("file"), place(date_header).alias("a"), place(value_header).alias("b"), F.posexplode("data").alias("n", "row")
    )
    points = cells.select(
        F.regexp_extract("file", r"([^/_]+)[^/]*$", 1).alias("series_id"), "file", "n", roc_date(F.trim(cell("a"))).alias("d"), number(cell("b")).alias("v")
    ).where("d IS NOT NULL AND v IS NOT NULL")
    first = Window.partitionBy("series_id", "d").orderBy("file", "n")
    return points.withColumn("k", F.row_number().over(first)).where("k = 1").select("series_id", "d", "v", F.lit(source).alias("source"))


def kind_of(content: Column) -> Column:
    """``xlsx, json, csv`` or ``binary`` by content: ZIP mark, first character, control characters in the first 2000 bytes."""
    head = F.substring(content, 1, 2000)
    text = F.decode(head, "ISO-8859-1")
    controls = F.regexp_count(text, F.lit(r"[\x00-\x08\x0E-\x1F]"))
    start = F.left(F.ltrim(F.regexp_replace(text, "^ï»¿", "")), F.lit(1))
    return (
        F.when(F.substring(content, 1, 4) == F.unhex(F.lit("504B0304")), "xlsx").when(start.isin("{", "["), "json")
        .when((F.instr(text, "\u0000") > 0) | (controls > 0.01 * F.length(text)), "binary").otherwise("csv")
    )


def decoded(content: Column) -> Column:
    """UTF-8 (a byte order mark is dropped) if valid, else Windows-1252."""
    utf8 = F.try_validate_utf8(content.cast("string"))
    # Latin-1, with the control characters that Windows-1252 uses for others
    high = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    western = F.translate(F.decode(content, "ISO-8859-1"), high.decode("latin-1"), high.decode("cp1252"))
    return F.regexp_replace(F.coalesce(utf8, western), "^\ufeff", "")


def delimited_files(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """``file, n, cells`` of every row of files in either encoding; binary contents and files without the delimiter in their first line are left out, no rows are no error."""
    files = spark.read.format("binaryFile").load(path).where(kind_of(F.col("content")) == "csv")
    # what has no delimiter in its first line decodes as text but is no table
    files = files.where(F.contains(F.split(decoded(F.col("content")), "\r?\n")[0], F.lit(delimiter)))
    lines = files.select(F.col("path").alias("file"), F.posexplode(F.split(decoded(F.col("content")), "\r?\n")).alias("n", "line"))
    return lines.where("line <> ''").select("file", "n", cells(F.col("line"), delimiter).alias("cells"))


def cells(line: Column, delimiter: str = ",") -> Column:
    """The cells of one row; a quoted cell may hold the delimiter, and a doubled quote stands for one."""
    mark = "\\Q" + delimiter + "\\E"
    plain = F.split(line, mark)
    # a delimiter counts where an even number of quotes follows it
    quoted = F.transform(
        F.split(line, mark + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'),
        lambda x: F.when(x.rlike('^".*"$'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)


def _sheet_rows(data: bytes) -> list[list[str]]:
    """The rows of the workbook's sheet with most non-empty cells."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        text = lambda e: "".join(t.text or "" for t in e.iter() if t.tag.endswith("}t"))
        shared = [text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        best: list[list[str]] = []
        for name in sorted(n for n in names if n.startswith("xl/worksheets/sheet")):
            rows = []
            for row in ElementTree.fromstring(z.read(name)).iter():
                if row.tag.endswith("}row"):
                    cells = []
                    for c in row:
                        value = next((v.text or "" for v in c if v.tag.endswith("}v")), text(c))
                        cells.append(shared[int(value)] if c.get("t") == "s" else value)
                    rows.append(cells)
            if sum(bool(c) for r in rows for c in r) > sum(bool(c) for r in best for c in r):
                best = rows
    return best


def workbooks(spark: SparkSession, path: str, last: int = 120) -> DataFrame:
    """``file, n, cells, dropped``: rows below the header (the first with three non-empty cells) of each workbook, the last ones only."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, content in zip(part["path"], part["content"]):
                rows = _sheet_rows(content)
                top = next((i for i, r in enumerate(rows) if sum(bool(c) for c in r) >= 3), len(rows))
                body = rows[top:]
                yield pd.DataFrame({"file": file, "n": range(len(body)), "cells": body})

    files = spark.read.format("binaryFile").load(path).where(kind_of(F.col("content")) == "xlsx").select("path", "content")
    rows = files.mapInPandas(read, "file string, n int, cells array<string>")
    total = F.max("n").over(Window.partitionBy("file"))
    body = rows.withColumn("dropped", F.greatest(total - last, F.lit(0)))
    return body.where((F.col("n") == 0) | (F.col("n") > F.col("dropped")))


def route(ident: Column) -> Column:
    """Which reader an identifier belongs to."""
    return (
        F.when(ident.rlike(r"^\d{4,6}(\.TWO?)?$"), "exchange").when(ident.rlike(r"^[\^]|=|\.[A-Z]{1,3}$"), "quotes")
        .when(ident.rlike(r"^[A-Z][A-Z0-9]{2,}$"), "observations").otherwise("ambiguous")
    )


def write_cache(series: DataFrame, path: str) -> None:
    """Parquet partitioned by fetch date, so that a day's reuse reads that day only."""
    series.write.mode("append").partitionBy("fetched").parquet(path)


def read_cache(spark: SparkSession, path: str, fetched: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("fetched") == F.lit(fetched).cast("date"))


def nested_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents under a declared schema, one a file, with or without a byte order mark; what does not parse is kept in ``malformed``."""
    files = spark.read.format("binaryFile").load(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    return files.select(F.from_json(decoded(F.col("content")), f"{schema}, malformed string", options).alias("doc")).select("doc.*")


def judged_items(items: DataFrame, required: list[str] = ()) -> DataFrame:
    """Adds ``status`` and ``reason`` to fetched items (``item, content, error, rows_ok``): what answered with an error, nothing, no rows where some
    are ``required``, or binary content has failed, and says why; an item with rows, or one that may be empty, is ok."""
    empty = F.col("content").isNull() | (F.octet_length("content") == 0)
    reason = (
        F.when(F.col("error").isNotNull(), F.concat(F.lit("upstream: "), F.substring_index("error", "\n", 1)))
        .when(empty, "no content").when(kind_of(F.col("content")) == "binary", "binary content")
        .when((F.coalesce("rows_ok", F.lit(0)) == 0) & F.col("item").isin(list(required)), "no rows")
    )
    return items.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "ok").otherwise("failed"))


def write_batch(items: DataFrame, path: str) -> None:
    """A raw batch: one row per item with its ``status`` and ``reason``, committed as a whole."""
    missing = {"item", "status", "reason"} - set(items.columns)
    if missing:
        raise ValueError(f"a batch says of every item how it went; there is no {sorted(missing)}")
    items.write.mode("overwrite").parquet(path)


def write_panel(series: DataFrame, path: str, kind: str = "csv") -> None:
    """A panel of series, one row a day and one column a series: ``csv`` with a header, ``records`` as JSON lines, or ``index`` as one JSON
    object a day, keyed by the day. Days without a value of a series have an empty cell or no key."""
    wide = series.groupBy("d").pivot("series_id").agg(F.first("v"))
    names = [c for c in wide.columns if c != "d"]
    if kind == "csv":
        wide.orderBy("d").write.mode("overwrite").option("header", True).csv(path)
    elif kind == "records":
        wide.orderBy("d").write.mode("overwrite").json(path)
    elif kind == "index":
        wide.select(F.to_json(F.create_map(F.col("d").cast("string"), F.struct(*(F.col(f"`{n}`").alias(n) for n in names)))).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"no panel of kind {kind!r}")
