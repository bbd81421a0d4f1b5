"""Daily tables of an exchange, yearly archives and the ladder of sources."""

import json
import zipfile

import pytest

from larkspur.sources import exchange as X

ROWS = [["自營商(自行買賣)", "1", "1", "100,000,000"], ["自營商(避險)", "1", "1", "-50,000,000"], ["投信", "1", "1", "200,000,000"], ["外資及陸資(不含外資自營商)", "1", "1", "300,000,000"], ["外資自營商", "1", "1", "--"]]
MARGIN = [["融資(交易單位)", "1", "1", "1", "9,120", "9,032"], ["融券(交易單位)", "1", "1", "1", "5", "7"], ["融資金額(仟元)", "1", "1", "1", "514,755,000", "521,135,000"]]


def put(path, name, doc):
    path.mkdir(exist_ok=True)
    (path / f"{name}.json").write_text(json.dumps(doc))


def test_institutions(spark, tmp_path):
    put(tmp_path / "i", "flat", {"stat": "OK", "title": "t", "data": [*ROWS, ["合計", "1", "1", "550,000,000"]]})
    put(tmp_path / "i", "off", {"stat": "OK", "data": [*ROWS, ["合計", "1", "1", "900,000,000"]]})
    put(tmp_path / "i", "closed", {"stat": "no data for the day"})
    put(tmp_path / "i", "empty", {"stat": "OK", "tables": [{"title": "x", "data": []}]})
    tables = X.daily_tables(spark, str(tmp_path / "i"))
    got = {r.file.split("/")[-1][:-5]: r for r in X.institutions(tables).collect()}
    flat = got["flat"]
    assert flat.ok and (flat.dealers, flat.trusts, flat.foreign, flat.total) == (0.5, 2.0, 3.0, 5.5)
    assert not got["off"].ok and got["off"].stat == "total does not match"
    assert not got["closed"].ok and got["closed"].stat == "no data for the day" and got["closed"].total is None
    assert not got["empty"].ok and got["empty"].stat == "no rows in any shape"


def test_margins(spark, tmp_path):
    put(tmp_path / "m", "nested", {"stat": "OK", "tables": [{"title": "none"}, {"title": "two", "data": MARGIN}]})
    put(tmp_path / "m", "short", {"stat": "OK", "data": MARGIN[:2]})
    tables = X.daily_tables(spark, str(tmp_path / "m"))
    got = {r.file.split("/")[-1][:-5]: r for r in X.margins(tables).collect()}
    r = got["nested"]
    assert r.ok and (r.margin_amount, r.margin_amount_change, r.margin_lots, r.margin_lots_change, r.short_lots_change) == (5211.35, 63.8, 9032, -88, 2)
    assert not got["short"].ok and got["short"].stat == "missing: margin_amount"
    assert {r.title for r in tables.where("shape = 'tables'").collect()} == {"two"}


def test_days_are_checked():
    assert X.check_day("20260804") == "20260804"
    for bad in ("#", "2026-08-04", "2026084", ""):
        with pytest.raises(ValueError):
            X.check_day(bad)


def test_yearly_positions(spark, tmp_path):
    names = ["Asset_Mgr_Positions_Long_All", "Asset_Mgr_Positions_Short_All", "Lev_Money_Positions_Long_All", "Lev_Money_Positions_Short_All"]
    def write(year, date_name, rows, drop=0):
        head = ["Market_and_Exchange_Names", date_name, "Change_in_Open_Interest_All", "Open_Interest_All", *names[: 4 - drop]]
        text = "\n".join(",".join(f'"{c}"' for c in r) for r in [head, *rows])
        with zipfile.ZipFile(tmp_path / f"{year}.zip", "w") as z:
            z.writestr("FinFut.txt", text)

    es, nq = "E-MINI S&P 500, NEW - CHICAGO MERCANTILE EXCHANGE", "NASDAQ-100 E-MINI"
    write(2012, "Report_Date_as_MM_DD_YYYY", [[es, "12/31/2012", "9", "100", "60", "10", "5", "30"], [nq, "12/31/2012", "9", "0", "1", "1", "1", "1"], ["WHEAT", "12/31/2012", "9", "5", "1", "1", "1", "1"]])
    write(2013, "Report_Date_as_YYYY-MM-DD", [[nq, "2013-01-08", "9", "1,000", "x", "1", "1", "1"], [nq, "2013-01-15", "9", "10", "1", "2", "3", "1"], [nq, "2013"]])
    write(2014, "Report_Date_as_YYYY-MM-DD", [[es, "2014-01-07", "9", "10", "1", "2", "3"]], drop=1)
    (tmp_path / "2015.zip").write_bytes(b"no archive")
    got = sorted((r.contract, str(r.d), r.oi, r.am, r.lm) for r in X.yearly_positions(spark, str(tmp_path)).collect())
    assert got == [("ES", "2012-12-31", 100.0, 0.5, -0.25), ("NQ", "2013-01-15", 10.0, -0.1, 0.2)]


def test_ladder_takes_the_first_tier_with_values(spark):
    rows = lambda data: spark.createDataFrame(data, "series_id string, d int, v double")
    got = X.ladder([("first", rows([("a", 1, None), ("b", 1, 1.0)])), ("second", rows([("a", 1, 2.0), ("a", 2, 3.0), ("b", 9, 9.0)])), ("third", rows([]))])
    assert sorted((r.series_id, r.d, r.v, r.tier) for r in got.collect()) == [("a", 1, 2.0, "second"), ("a", 2, 3.0, "second"), ("b", 1, 1.0, "first")]
