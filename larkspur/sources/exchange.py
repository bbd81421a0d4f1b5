"""Readers of an exchange's daily tables and of yearly archives of positions; the first source that has a series."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions.scalars import number
from larkspur.sources.series_files import find_column

#: Which rows of the institutions' table make up a party, the row of the total, and the rows of the margin table.
PARTIES = {
    "dealers": ("自營商(自行買賣)", "自營商(避險)"),
    "trusts": ("投信",),
    "foreign": ("外資及陸資(不含外資自營商)", "外資自營商"),
}
TOTAL = "合計"
MARGIN = {"margin_amount": "融資金額(仟元)", "margin_lots": "融資(交易單位)", "short_lots": "融券(交易單位)"}
#: By which words a column of the yearly archives is found, and which words exclude it.
POSITIONS = {
    "market": ("Market_and_Exchange_Names", ["market", "exchange"], []),
    "date": ("Report_Date_as_YYYY-MM-DD", ["report", "date"], ["asof"]),
    "oi": ("Open_Interest_All", ["open", "interest", "all"], ["change", "pct", "of"]),
    "am_long": ("Asset_Mgr_Positions_Long_All", ["asset", "long", "all"], ["change", "pct", "spread", "other"]),
    "am_short": ("Asset_Mgr_Positions_Short_All", ["asset", "short", "all"], ["change", "pct", "spread", "other"]),
    "lm_long": ("Lev_Money_Positions_Long_All", ["lev", "long", "all"], ["change", "pct", "spread", "other"]),
    "lm_short": ("Lev_Money_Positions_Short_All", ["lev", "short", "all"], ["change", "pct", "spread", "other"]),
}
CONTRACTS = {"ES": ("E-MINI S&P 500", "CHICAGO MERCANTILE"), "NQ": ("NASDAQ-100", "MINI"), "RTY": ("RUSSELL", "MINI"), "VX": ("VIX FUTURES", "")}


def check_day(day: str) -> str:
    """A day as the exchange takes it; other forms are answered with the latest day's table, so they are an error here."""
    if len(day) != 8 or not day.isascii() or not day.isdigit():
        raise ValueError(f"not YYYYMMDD: {day!r}")
    return day


def daily_tables(spark: SparkSession, path: str) -> DataFrame:
    """``file, ok, stat, shape, title, data`` of one JSON answer a file, whose rows stand at its top (``flat``) or in the first
    table with rows (``tables``). A closed day is not ok; neither is an answer without rows."""
    schema = "stat string, title string, data array<array<string>>, tables array<struct<title: string, data: array<array<string>>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    filled = F.get(F.filter("tables", lambda t: F.coalesce(F.size(t["data"]), F.lit(0)) > 0), F.lit(0))
    flat = F.coalesce(F.size("data"), F.lit(0)) > 0
    answered = F.coalesce(F.col("stat") == "OK", F.lit(False))
    ok = answered & (flat | filled.isNotNull())
    return raw.select(
        F.input_file_name().alias("file"), ok.alias("ok"), F.when(answered & ~ok, "no rows in any shape").otherwise(F.col("stat")).alias("stat"),
        F.when(ok, F.when(flat, "flat").otherwise("tables")).alias("shape"), F.coalesce(F.nullif("title", F.lit("")), filled["title"]).alias("title"),
        F.when(ok, F.when(flat, F.col("data")).otherwise(filled["data"])).alias("data"),
    )


def _row(name: str) -> Column:
    """The last row of that name."""
    return F.try_element_at(F.filter("data", lambda r: F.trim(F.get(r, F.lit(0))) == name), F.lit(-1))


def institutions(tables: DataFrame) -> DataFrame:
    """``file, ok, stat, dealers, trusts, foreign, total`` in 1e8 units: net amounts (last cell) summed by party. Not ok if the table's
    own total differs by more than 0.5, which means that rows were renamed."""
    net = lambda name: F.round(number(F.try_element_at(_row(name), F.lit(-1))) / 1e8, 2)
    sums = {p: F.round(sum((F.coalesce(net(n), F.lit(0.0)) for n in names), F.lit(0.0)), 2) for p, names in PARTIES.items()}
    out = tables.select("file", "ok", "stat", net(TOTAL).alias("stated"), *(F.when(F.col("ok"), c).alias(p) for p, c in sums.items()))
    out = out.withColumn("total", F.round(sum((F.col(p) for p in PARTIES), F.lit(0.0)), 2))
    off = F.coalesce(F.abs(F.col("stated") - F.col("total")) > 0.5, F.lit(False))
    return out.select("file", (F.col("ok") & ~off).alias("ok"), F.when(off, "total does not match").otherwise(F.col("stat")).alias("stat"), *PARTIES, "total")


def margins(tables: DataFrame) -> DataFrame:
    """``file, ok, stat`` and of each row of the margin table today's balance and its change; amounts come in thousands and go out in
    1e8 units, lots stay. Not ok if a row lacks today's balance."""
    cell = lambda name, i: number(F.get(_row(name), F.lit(i)))
    cells = [c for key, name in MARGIN.items() for c in (cell(name, 5).alias(f"{key}_now"), cell(name, 4).alias(f"{key}_before"))]
    out = tables.select("file", "ok", "stat", *cells)
    missing = F.concat_ws(", ", *(F.when(F.col(f"{key}_now").isNull(), F.lit(key)) for key in MARGIN))
    scaled = lambda key, c: F.round(c / 1e5, 2) if key == "margin_amount" else c.cast("long")
    values = [x for key in MARGIN for x in (scaled(key, F.col(f"{key}_now")).alias(key), scaled(key, F.col(f"{key}_now") - F.col(f"{key}_before")).alias(f"{key}_change"))]
    lacks = F.col("ok") & (missing != "")
    return out.select("file", (F.col("ok") & (missing == "")).alias("ok"), F.when(lacks, F.concat(F.lit("missing: "), missing)).otherwise(F.col("stat")).alias("stat"), *values)


def yearly_positions(spark: SparkSession, path: str) -> DataFrame:
    """``file, contract, d, oi, am, lm`` of zipped yearly tables: net positions of two groups by open interest, for known contracts with
    open interest. Columns are found by name, since their names change; a file without one of them gives no rows.

    A file is one year and is read as a whole by its task; years spread over tasks.
    """

    def table(content: bytes) -> tuple[dict[str, int], csv.reader] | None:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                name = next(n for n in z.namelist() if n.lower().endswith(".txt"))
                rows = csv.reader(io.StringIO(z.read(name).decode("utf-8", "replace")))
            head = next(rows)
            return {k: head.index(find_column(head, *v)) for k, v in POSITIONS.items()}, rows
        except (zipfile.BadZipFile, StopIteration, KeyError):
            return None

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, content in zip(part["path"], part["content"]):
                found = table(content)
                if found:
                    at, rows = found
                    yield pd.DataFrame([(file, *(r[i] for i in at.values())) for r in rows if len(r) > max(at.values())], columns=["file", *at])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    raw = files.mapInPandas(read, "file string, " + ", ".join(f"{k} string" for k in POSITIONS))
    market = F.upper("market")
    contract = F.coalesce(*(F.when(F.contains(market, F.lit(a)) & F.contains(market, F.lit(b)), tag) for tag, (a, b) in CONTRACTS.items()))
    num = {k: number(F.col(k)) for k in POSITIONS if k not in ("market", "date")}
    day = F.coalesce(F.col("date").try_cast("date"), F.try_to_timestamp("date", F.lit("M/d/yyyy")).cast("date"))
    net = lambda g: (num[f"{g}_long"] - num[f"{g}_short"]) / num["oi"]
    return raw.where(num["oi"] > 0).select("file", contract.alias("contract"), day.alias("d"), num["oi"].alias("oi"), net("am").alias("am"), net("lm").alias("lm")).where(
        "contract IS NOT NULL AND d IS NOT NULL AND am IS NOT NULL AND lm IS NOT NULL"
    )


def ladder(tiers: list[tuple[str, DataFrame]], key: str = "series_id", value: str = "v") -> DataFrame:
    """The rows of the first tier that has values of a series, with the ``tier`` that they come from."""
    parts = (df.where(F.col(value).isNotNull()).withColumn("tier", F.lit(name)).withColumn("rung", F.lit(n)) for n, (name, df) in enumerate(tiers))
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("best", F.min("rung").over(Window.partitionBy(key))).where("rung = best").drop("rung", "best")
