"""Recorded answers: five routes, pushed filters, and each error under its own name."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from larkspur.sources import connector as N


@pytest.fixture()
def answers(spark, tmp_path):
    def put(route, ident, month, body):
        folder = tmp_path / f"route={route}" / f"ident={ident}" / f"month={month}"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text(body if isinstance(body, str) else json.dumps(body, ensure_ascii=False), encoding="utf-8-sig")
        (folder / ".part-0.txt.crc").write_text("x")

    N.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    put.path = str(tmp_path)
    put.read = lambda **options: spark.read.format("recorded_series").options(path=str(tmp_path), **({"pushdown": "true"} | options)).load()
    yield put
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def rows(df):
    return sorted((r.series_id, str(r.d), r.v, r.unit, r.route) for r in df.collect())


def test_routes(answers):
    answers("observations", "GDP", "2026-01", {"observations": [{"date": "2026-01-01", "value": "1.5"}, {"date": "2026-01-02", "value": "."}]})
    answers("quotes", "^IX", "2026-01", {"chart": {"result": [{"timestamp": [1767312000, 1767398400], "indicators": {"quote": [{"close": [10, None]}]}}]}})
    answers("exchange", "2330", "2026-01", {"fields": ["日期", "收盤價"], "data": [["115/01/05", "1,234.5"], ["x", "1"], ["115/01/06", "--"]]})
    answers("messages", "MSG:all", "2026-01", {"rows": []})
    answers("holdings", "FUND:gold", "2026-01", {"rows": [{"date": "2026-01-07", "value": "9"}]})
    answers("adjusted", "XLE", "2026-01", [{"date": "2026-01-08T00:00:00Z", "adjClose": 4.5, "close": 5}])
    got = rows(answers.read(headers=json.dumps({"XLE": "adjusted", "^IX": "adjusted", "GDP": "unheard of"})))
    assert got == [
        ("2330", "2026-01-05", 1234.5, "points", "exchange"), ("FUND:gold", "2026-01-07", 9.0, "tonnes", "holdings"), ("GDP", "2026-01-01", 1.5, "as published", "observations"),
        ("XLE", "2026-01-08", 4.5, "dollars", "adjusted"), ("^IX", "2026-01-02", 10.0, "points", "quotes"),
    ]


def test_a_failure_falls_back_but_an_unknown_identifier_does_not(answers):
    answers("observations", "GDP", "2026-01", {"status": 503})
    answers("graph", "GDP", "2026-01", "observation_date,GDP\n2026-01-01,2\n2026-01-02,.\n")
    assert rows(answers.read()) == [("GDP", "2026-01-01", 2.0, "as published", "graph")]
    answers("observations", "SOXQ", "2026-01", {"status": 400})
    answers("graph", "SOXQ", "2026-01", "observation_date,SOXQ\n2026-01-01,2\n")
    with pytest.raises(Exception, match="UnknownIdentifier"):
        answers.read(idents="SOXQ").collect()
    with pytest.raises(Exception, match="UnknownIdentifier.*no route"):
        answers.read(idents="what is this").collect()
    with pytest.raises(Exception, match="UpstreamFailure"):
        answers.read(idents="NONE").collect()


def test_an_empty_table_is_an_error(answers):
    answers("quotes", "^IX", "2026-01", {"chart": {"result": [{"timestamp": [], "indicators": {"quote": [{"close": []}]}}]}})
    with pytest.raises(Exception, match="EmptyAnswer"):
        answers.read(idents="^IX").collect()
    answers("quotes", "^BAD", "2026-01", {"status": 429})
    with pytest.raises(Exception, match="UpstreamFailure.*429"):
        answers.read(idents="^BAD").collect()


def test_filters_leave_partitions_out(answers):
    for m in ("2025-12", "2026-01", "2026-02"):
        answers("observations", "GDP", m, {"observations": [{"date": f"{m}-15", "value": "1"}]})
        # opened, these would fail
        answers("observations", "CPI", m, {"status": 400})
    answers("observations", "OLD", "2020-01", {"status": 400})
    answers("observations", "OLD", "2026-01", {"observations": [{"date": "2026-01-20", "value": "3"}]})
    df = answers.read()
    assert [str(r.d) for r in df.where("series_id = 'GDP' AND d >= DATE '2026-01-10'").orderBy("d").collect()] == ["2026-01-15", "2026-02-15"]
    assert df.where(F.col("series_id").isin("GDP", "OLD") & (F.col("d") > date(2026, 1, 15))).count() == 2
    assert df.where("series_id = 'GDP' AND d >= DATE '2027-01-01'").count() == 0


def test_lookup(spark, tmp_path):
    N.register(spark)
    episode = {"wrapperType": "podcastEpisode", "trackId": 1, "trackName": "a", "releaseDate": "2026-01-02T03:04:05Z", "trackTimeMillis": 5, "episodeUrl": "u"}
    shows = {"one": {"results": [{"wrapperType": "track"}, episode, episode | {"trackId": 2, "episodeUrl": None}, episode | {"releaseDate": "soon"}, episode | {"releaseDate": None}]}, "two": {"status": 500}, "three": {}}
    for k, body in shows.items():
        (tmp_path / f"show={k}").mkdir()
        (tmp_path / f"show={k}" / "x.json").write_text(json.dumps(body))
    got = spark.read.format("recorded_lookup").load(str(tmp_path)).orderBy("track_id").collect()
    assert [(r.show, r.track_id, r.title, r.duration_ms, r.has_sound) for r in got] == [("one", "1", "a", 5, True), ("one", "2", "a", 5, False)]
    assert got[0].release_ts.isoformat().startswith("2026-01-02T03:04:05")
