"""Nested documents become frames: what the fixtures of the checks hold, null and missing fields, malformed texts, versions of a day."""

import json

from pyspark.sql import functions as F

from larkspur.operators import checks, frames, rules


def read(spark, kind, *docs):
    rows = [(f"k{i}", x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(docs)]
    return frames.parsed(spark.createDataFrame(rows, "key string, json string"), kind)


def levels(frame, name, **config):
    got = rules.evaluate(frame, checks.REGISTRY.of(name), checks.CONFIG | config).collect()
    return {(r.key, r.check_id): r.level for r in got}


def test_malformed_documents_are_kept(spark):
    got = read(spark, "draft", {"date": "2026-08-20", "items": []}, "{broken", {"date": 3, "items": None}).collect()
    assert [r.malformed is None for r in got] == [True, False, True] and got[0].doc.items == [] and got[1].malformed == "{broken"


def test_every_frame_has_its_columns(spark):
    nothing = {k: read(spark, k, {}) for k in frames.SCHEMAS}
    pairs = spark.createDataFrame([], "show string, file string, tokens long, first long, id string, text string, name string, bytes long")
    made = {
        "chart_days": frames.chart_days(nothing["chart"]), "charts": frames.charts(nothing["chart"]), "chart_series": frames.chart_series(nothing["chart"]), "cards": frames.cards(nothing["advisory"]),
        "groups": frames.groups(nothing["advisory"], nothing["plan"]), "dispatch": frames.dispatch(nothing["plan"]), "advisory_days": frames.advisory_days(nothing["advisory"]), "drafts": frames.drafts(nothing["draft"]),
        "manifests": frames.manifests(nothing["manifest"]), "fetched": frames.fetched(nothing["manifest"], pairs, pairs), "episodes": frames.episodes(nothing["podcast"]),
        "podcast_days": frames.podcast_days(nothing["podcast"], nothing["ledger"], pairs), "ledger": frames.ledger(nothing["ledger"]), "files": frames.files(nothing["files"]), "briefs": frames.briefs(nothing["brief"]),
        "reports": frames.reports(nothing["report"], nothing["digest"], pairs), "stances": frames.stances(nothing["report"], nothing["digest"], ["a"]), "report_charts": frames.report_charts(nothing["report"], nothing["digest"]),
        "research_days": frames.research_days(nothing["report"], nothing["digest"]), "indexes": frames.indexes(nothing["index"]), "heartbeats": frames.heartbeats(nothing["heartbeat"]),
    }
    assert set(made) == set(checks.FRAMES)
    for name, frame in made.items():
        assert [f"{c} {k}" for c, k in frame.dtypes] == [c.strip().replace(" long", " bigint") for c in checks.FRAMES[name].split(",")], name
        frame.collect()


def test_charts(spark):
    bars = {"xAxis": {"data": ["a", "b", "c", "all"]}, "series": [{"type": "bar", "stackStrategy": "all", "data": [0, 2, 2, 0]}]}
    fall = {"slug": "w", "kind": "waterfall", "cats": ["a", "b", "c"], "vals": [3, -1, 2.5], "zero_line": True}
    zero = [{"type": "bar", "stackStrategy": "all", "data": [0, 2, 2, 0], "markLine": {"data": [{"yAxis": 0}]}}]
    docs = [{"charts": [fall | {"option": bars | {"series": zero}}]}, {"charts": [fall | {"option": bars}]}, {"charts": [fall | {"vals": [3, 1, 2.5], "option": bars | {"series": zero}}]}, {"charts": [fall]}]
    docs += [{"charts": [{"slug": "m", "footer_lines": 4}, {"slug": "e", "source": "中" * 25, "note": "中" * 25}, {"slug": "n", "source": "中" * 10}]}]
    frame = {r.key: r for r in frames.charts(read(spark, "chart", *docs)).collect()}
    assert [frame[f"k{i}:w"].n_option_mismatches for i in range(4)] == [0, 1, 1, 1]
    got = levels(frames.charts(read(spark, "chart", *docs)), "charts", footer_line=10.0, footer_max=3)
    assert [got[f"k4:{s}", "chart.footer_lines"] for s in "men"] == ["FAIL", "FAIL", "PASS"]


def test_series_that_are_published_by_the_week(spark):
    series = lambda name, last, ident: {"slug": name, "series_spec": [{"id": ident, "name": name}], "series": [{"name": name, "dates": ["2026-05-01", last], "values": [1, 2]}]}
    doc = {"date": "2026-08-20", "now": "2026-08-20T12:00:00+08:00", "charts": [series("x", "2026-08-10", "A"), series("w", "2026-08-14", "H10"), series("v", "2026-07-08", "H10"), series("m", "2026-06-01", "A"), series("n", "2026-08-19", "A")]}
    got = levels(frames.chart_series(read(spark, "chart", doc)), "chart_series")
    assert [got[f"k0:{s}:0", "chart.series_freshness"] for s in "xwvmn"] == ["FAIL", "PASS", "FAIL", "WARN", "PASS"]


def test_tracks_of_a_weekend(spark):
    day = lambda date, track: {"date": date, "charts": [{"slot": "track｜" + track}]}
    days = [day("2026-08-20", "energy"), day("2026-08-21", "rates"), day("2026-08-22", "rates（weekly）"), day("2026-08-23", "rates（weekly）"), day("2026-08-29", "chips（weekly）"), day("2026-08-30", "flows（weekly）"), day("2026-09-05", "chips")]
    got = levels(frames.chart_days(read(spark, "chart", *days)), "chart_days")
    assert [got[f"k{i}", "chart.track_of_the_day"] for i in range(7)] == ["PASS", "FAIL", "PASS", "FAIL", "PASS", "PASS", "FAIL"]


def test_streaks_of_the_last_data_path(spark):
    paths = ["manual", "backup", "manual", "manual", "manual", None, "manual"]
    docs = [{"date": f"2026-08-{10 + i}", "about": {"data_path": p}} for i, p in enumerate(paths)]
    got = frames.chart_days(read(spark, "chart", *docs)).orderBy("key").collect()
    assert [r.path_streak for r in got] == [1, 0, 1, 2, 3, 0, 1]


def test_bodies_that_are_no_text(spark):
    card = {"title": "t", "url": "https://a/1", "tone": "up", "tagcls": "news", "src": "s"}
    doc = lambda date, *bodies: {"date": date, "sections": [{"groups": [{"label": "g", "cards": [card | {"title": str(i), "body": b} for i, b in enumerate(bodies)]}]}]}
    got = levels(frames.cards(read(spark, "advisory", doc("2026-08-20", "text", ["a", "b"]), doc("2026-08-21", "next", None))), "cards")
    assert [got[f"k0:g:{i}", "advisory.card_vocab"] for i in range(2)] == ["PASS", "FAIL"] and got["k1:g:1", "advisory.card_vocab"] == "FAIL"
    assert got["k0:g:0", "advisory.cross_version_dedup"] == "SKIPPED" and got["k1:g:0", "advisory.cross_version_dedup"] == "FAIL"


def test_quotes_in_other_typography(spark):
    report = {"slug": "a", "page_one": "Rates  remain on hold .", "body": ["“We see”", "upside"], "tables": [{"rows": [["CPI", "3.1"]]}]}
    chart = {"kind": "gauge", "vals": [1], "cats": []}
    digest = {"reports": [
        {"slug": "a", "stances": [{"quote": "remain on hold.", "theme": "x"}, {"quote": '"We see" upside', "theme": "x"}, {"quote": "downside", "theme": "y"}, {"quote": " "}], "charts": [chart | {"grounding": ["CPI 3.1"]}, chart | {"grounding": ["CPI 3.2"]}, chart]},
        {"slug": "b", "stances": [{"quote": "remain", "theme": "x"}]},
    ]}
    docs, told = read(spark, "report", report), read(spark, "digest", digest)
    got = levels(frames.stances(docs, told, ["x"]), "stances")
    assert [got[k, "research.stance_grounded"] for k in ("a:0", "a:1", "a:2", "a:3", "b:0")] == ["PASS", "PASS", "FAIL", "FAIL", "FAIL"]
    assert [got[k, "research.theme_in_domain"] for k in ("a:0", "a:2", "a:3")] == ["PASS", "FAIL", "FAIL"]
    drawn = levels(frames.report_charts(docs, told), "report_charts")
    assert [drawn[f"a:{i}", "research.chart_grounded"] for i in range(3)] == ["PASS", "FAIL", "FAIL"]


def test_a_manifest_without_a_list(spark):
    docs = read(spark, "manifest", {"episodes": {"a": 1}}, {"generatedAt": "2026-08-20T00:00:00Z", "windowStartUtc": "x", "windowEndUtc": "2026-08-20T00:00:00Z", "episodes": []})
    rows = frames.manifests(docs).orderBy("key").collect()
    assert [(r.n_missing_keys, r.episodes_is_array, r.start_ts) for r in rows] == [(3, False, None), (0, True, None)]
    assert frames.fetched(docs, spark.sql("SELECT 'a' AS show"), spark.sql("SELECT 'f' AS file, 1 AS tokens, 1 AS first")).count() == 0


def test_indexes_and_heartbeats(spark):
    frame = frames.indexes(read(spark, "index", {"now": "2026-08-19T12:00:00+08:00", "updated": "2026-08-19T00:00:00Z", "days": [{"date": "2026-08-17"}]}, {"now": "2026-08-19T12:00:00+08:00", "updated": "x", "days": [{"date": "2026-08-18"}]}, {"now": "2026-08-19T12:00:00+08:00", "days": []}))
    got = levels(frame, "indexes")
    assert [got[f"k{i}", "sentinel.data_fresh"] for i in range(3)] == ["FAIL", "PASS", "FAIL"] and got["k2", "sentinel.no_future_date"] == "SKIPPED"
    beat = frames.heartbeats(read(spark, "heartbeat", {"now": "2026-08-19T12:00:00Z", "heartbeat": {"at": "2026-08-19T00:00:00Z", "exit": 0}, "drift": [], "binaries": {"a": False}}, {})).orderBy("key").collect()
    assert (beat[0].n_drift, beat[0].n_missing_binaries, beat[1].n_drift, beat[1].binaries_known) == (0, 1, None, False)
    assert frame.where(F.col("updated").isNull()).count() == 2
