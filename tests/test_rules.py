"""Every check fails on a bad row, passes one step away, and can't be registered carelessly."""

import json

import pytest
from pyspark.sql import functions as F

from larkspur.operators import checks, rules

T0, T1 = "2026-08-20T07:00:00", "2026-08-21T07:00:00"
#: check: (row that must not pass, row one step away that must pass)
CASES = {
    "advisory.group_names": ({"in_plan": True, "in_doc": False}, {"in_plan": True, "in_doc": True}),
    "advisory.group_floors": ({"in_plan": True, "n_cards": 9, "floor": 10}, {"in_plan": True, "n_cards": 10, "floor": 10}),
    "advisory.base_cards": ({"needs_base": True, "n_base": 0}, {"needs_base": True, "n_base": 1}),
    "advisory.site_total": ({"n_cards": 39}, {"n_cards": 40}),
    "advisory.ts_wellformed": ({"ts": "2026-08-20T10:00:00"}, {"ts": "2026-08-20T10:00:00+08:00"}),
    "advisory.ts_in_window": ({"ts": "2026-08-20T06:59:00Z", "window_from": T0, "window_to": T1, "now": T1}, {"ts": "2026-08-20T07:00:00Z", "window_from": T0, "window_to": T1, "now": T1}),
    "advisory.date_ts_consistent": ({"ts": "2026-08-20T20:00:00Z", "date": "2026-08-20"}, {"ts": "2026-08-20T20:00:00Z", "date": "2026-08-21"}),
    "advisory.cross_version_dedup": ({"has_previous": True, "in_previous": True, "exempt": False}, {"has_previous": True, "in_previous": True, "exempt": True}),
    "advisory.url_is_article": ({"url": "https://a.com/news/"}, {"url": "https://a.com/news/one"}),
    "advisory.card_vocab": ({"tone": "loud", "tag": "news", "body_is_text": True, "src": "x"}, {"tone": "up", "tag": "news", "body_is_text": True, "src": "x"}),
    "advisory.watch_review": ({"n_bad_verdicts": 0, "n_verdicts": 2, "n_undecided": 2}, {"n_bad_verdicts": 0, "n_verdicts": 2, "n_undecided": 1}),
    "advisory.fixed_structure": ({"n_snap": 5, "n_takeaways": 5, "n_pulse": 6, "sections_in_order": True, "level": "50"}, {"n_snap": 6, "n_takeaways": 5, "n_pulse": 6, "sections_in_order": True, "level": "100"}),
    "advisory.card_lengths": ({"deep_median": 299.0, "regular_median": 60.0, "n_deep": 3}, {"deep_median": 300.0, "regular_median": 60.0, "n_deep": 3}),
    "advisory.index_entry_source": ({"n_empty_index_fields": 1, "n_threaded": 1}, {"n_empty_index_fields": 0, "n_threaded": 1}),
    "advisory.overview_prose": ({"n_notes_missing": 0, "note_chars_low": 19, "note_chars_high": 200, "bold_share": 0.5}, {"n_notes_missing": 0, "note_chars_low": 20, "note_chars_high": 200, "bold_share": 0.5}),
    "advisory.window_wellformed": (
        {"from_ts": "2026-08-20T07:00:00+08:00", "window_start": "2026-08-19T23:00:01", "window_end": "2026-08-20T23:00:01", "to_date": "2026-08-21", "date": "2026-08-21", "prev_to_ts": "2026-08-20T00:00:00"},
        {"from_ts": "2026-08-20T07:00:00+08:00", "window_start": "2026-08-19T23:00:00", "window_end": "2026-08-20T23:00:00", "to_date": "2026-08-21", "date": "2026-08-21", "prev_to_ts": "2026-08-20T00:00:00"},
    ),
    "advisory.dispatch_wellformed": ({"quota": 3, "owner_quota": 2, "n_batches": 1, "n_owners": 1}, {"quota": 3, "owner_quota": 3, "n_batches": 1, "n_owners": 1}),
    "chart.structure": ({"n_charts": 4, "slots_in_order": True}, {"n_charts": 5, "slots_in_order": True}),
    "chart.theme_unique": ({"n_duplicate_themes": 1}, {"n_duplicate_themes": 0}),
    "chart.kind_data_present": ({"kind": "scatter", "n_empty_fields": 1}, {"kind": "scatter", "n_empty_fields": 0}),
    "chart.lengths": ({"exempt": False, "title_chars": 7, "reading_chars": 40, "takeaway_chars": 10}, {"exempt": False, "title_chars": 8, "reading_chars": 40, "takeaway_chars": 10}),
    "chart.series_cap": ({"n_series": 9}, {"n_series": 7}),
    "chart.diversity": ({"started": True, "n_not_line": 1}, {"started": True, "n_not_line": 2}),
    "chart.footer_lines": ({"source_width": 61, "note_width": 60}, {"source_width": 60, "note_width": 0}),
    "chart.option_matches_spec": ({"n_option_mismatches": 1}, {"n_option_mismatches": 0}),
    "chart.provenance": ({"inspired_url": "u", "inspired_published": "2026-08-12", "date": "2026-08-20"}, {"inspired_url": "u", "inspired_published": "2026-08-13", "date": "2026-08-20"}),
    "chart.png_present": ({"png_bytes": 19999}, {"png_bytes": 20000}),
    "chart.series_freshness": ({"cadence": "daily", "age_days": 2}, {"cadence": "daily", "age_days": 1}),
    "chart.series_wellformed": ({"n_dates": 19, "n_values": 19}, {"n_dates": 20, "n_values": 20}),
    "chart.track_of_the_day": ({"track": "x", "planned_track": "y", "weekend_tagged": False, "is_weekend": False}, {"track": "y", "planned_track": "y", "weekend_tagged": False, "is_weekend": False}),
    "chart.size": ({"size_kb": 251.0}, {"size_kb": 250.0}),
    "chart.data_path_named": ({"data_path": "manual"}, {"data_path": "primary"}),
    "chart.prefetch_fresh": ({"has_prefetch": True, "prefetch_age_h": 30.1, "n_used_failed": 0}, {"has_prefetch": True, "prefetch_age_h": 30.0, "n_used_failed": 0}),
    "chart.data_path_streak": ({"path_streak": 3}, {"path_streak": 0}),
    "chart.release_day": ({"has_release": True, "release_fresh": True, "release_kind": "CPI", "main_slug": "x", "main_theme": "rates"}, {"has_release": True, "release_fresh": True, "release_kind": "CPI", "main_slug": "cpi-release", "main_theme": "rates"}),
    "demo.date_present": ({"date": "20260820"}, {"date": "2026-08-20"}),
    "demo.items_nonempty": ({"n_items": 0}, {"n_items": 1}),
    "demo.note_length": ({"note": "x" * 101}, {"note": "x" * 100}),
    "demo.upstream_fresh": ({"upstream_date": None}, {"upstream_date": "2026-08-20", "env_broken": False}),
    "podcast.manifest_wellformed": ({"n_missing_keys": 0, "episodes_is_array": True, "start_ts": None, "end_ts": T1, "generated_ts": T1}, {"n_missing_keys": 0, "episodes_is_array": True, "start_ts": T0, "end_ts": T1, "generated_ts": T1}),
    "podcast.window_sane": ({"start_ts": T0, "end_ts": "2026-08-21T07:06:00", "generated_ts": T1}, {"start_ts": T0, "end_ts": "2026-08-21T07:05:00", "generated_ts": T1}),
    "podcast.episode_admission": ({"title": "Official Trailer", "duration_ms": 700000}, {"title": "Official", "duration_ms": 600000}),
    "podcast.show_keys_known": ({"show_known": False}, {"show_known": True}),
    "podcast.status_vocabulary": ({"status": "ok"}, {"status": "OK"}),
    "podcast.no_failed_episodes": ({"status": "FAILED"}, {"status": "PARTIAL"}),
    "podcast.completeness_band": ({"completeness": 0.40}, {"completeness": 0.56}),
    "podfetch.no_block_repetition": ({"repeat_tokens": 970, "repeat_first": 400}, {"repeat_tokens": 300, "repeat_first": 17}),
    "podcast.release_in_window": ({"release_ts": "2026-08-21T07:00:01", "start_ts": T0, "end_ts": T1}, {"release_ts": T1, "start_ts": T0, "end_ts": T1}),
    "podcast.no_duplicate_episodes": ({"n_same": 2}, {"n_same": 1}),
    "podcast.file_id_matches_url": ({"file_id": "1", "url_id": "2"}, {"file_id": "1", "url_id": "1"}),
    "podcast.chars_in_tier": ({"exempt": False, "has_minutes": True, "chars": 6521, "low_chars": 100, "high_chars": 6520, "paragraphs": 3, "low_paragraphs": 1, "high_paragraphs": 9}, {"exempt": False, "chars": 6520, "low_chars": 100, "high_chars": 6520, "paragraphs": 3, "low_paragraphs": 1, "high_paragraphs": 9}),
    "podcast.topics_controlled": ({"n_topics": 4, "n_bad_topics": 0}, {"n_topics": 3, "n_bad_topics": 0}),
    "podcast.per_episode_counts": ({"placeholder": False, "n_takeaways": 2, "n_quotes": 2}, {"placeholder": False, "n_takeaways": 3, "n_quotes": 2}),
    "podcast.crosscut_present": ({"n_episodes": 3, "n_points": 0}, {"n_episodes": 2, "n_points": 0}),
    "podcast.quotes_grounded": ({"has_transcripts": True, "n_quotes_missed": 1}, {"has_transcripts": True, "n_quotes_missed": 0}),
    "podcast.ledger_advanced": ({"n_new_ledger": 1}, {"n_new_ledger": 2}),
    "podcast.ledger_no_overdue": ({"status": "watching", "due": "2026-08-14", "today": "2026-08-22", "grace_days": 7}, {"status": "watching", "due": "2026-08-22", "today": "2026-08-22", "grace_days": 7}),
    "repo.no_pull_request_target": ({"n_token_lines": 1}, {"n_token_lines": 0}),
    "repo.brief_budget": ({"est_tokens": 1001, "budget": 1000, "budget_source": "x"}, {"est_tokens": 1000, "budget": 1000, "budget_source": "x"}),
    "research.no_pii": ({"n_private": 1}, {"n_private": 0}),
    "research.identified": ({"broker": "b", "date": "2026-08-20", "top_hits": 2, "second_hits": 0}, {"broker": "b", "date": "2026-08-20", "top_hits": 6, "second_hits": 1}),
    "research.strip_bounded": ({"removed_pct": 22.0}, {"removed_pct": 2.1}),
    "research.page_count": ({"claimed_pages": 3, "pages": 2}, {"claimed_pages": 2, "pages": 2}),
    "research.page_one_substantial": ({"page_one_chars": 199}, {"page_one_chars": 200}),
    "research.no_duplicates": ({"n_same_slug": 1, "n_same_sha": 2}, {"n_same_slug": 1, "n_same_sha": 1}),
    "research.stance_grounded": ({"has_report": True, "found": False}, {"has_report": True, "found": True}),
    "research.theme_in_domain": ({"theme_known": False}, {"theme_known": True}),
    "research.summary_length": ({"summary_chars": 99, "low_chars": 100, "high_chars": 200}, {"summary_chars": 100, "low_chars": 100, "high_chars": 200}),
    "research.chart_grounded": ({"n_ungrounded": 1}, {"n_ungrounded": 0}),
    "research.tags_wellformed": ({"n_tags": 2, "longest_tag": 12, "n_bad_tags": 0, "n_unknown_tags": 0}, {"n_tags": 3, "longest_tag": 12, "n_bad_tags": 0, "n_unknown_tags": 0}),
    "research.chart_files_present": ({"n_missing_files": 0, "n_render_errors": 0, "n_charts": 0}, {"n_missing_files": 0, "n_render_errors": 0, "n_charts": 1}),
    "research.ledger_no_overdue": ({"status": "watching", "due": "2026-08-01", "today": "2026-08-16"}, {"status": "watching", "due": "2026-08-02", "today": "2026-08-16"}),
    "research.chart_spec_wellformed": ({"n_empty_fields": 0, "n_values": 3, "n_cats": 4}, {"n_empty_fields": 0, "n_values": 4, "n_cats": 4}),
    "research.one_engine": ({"n_engines": 2}, {"n_engines": 1}),
    "sentinel.data_fresh": ({"now": "2026-08-21T19:01:00", "latest": "2026-08-20T07:00:00", "cadence_h": 24.0}, {"now": "2026-08-21T19:00:00", "latest": "2026-08-20T07:00:00", "cadence_h": 24.0}),
    "sentinel.no_future_date": ({"now": T0, "latest": T1}, {"now": T1, "latest": T1}),
    "sentinel.updated_fresh": ({"now": "2026-08-21T13:01:00", "updated": T0, "cadence_h": 24.0}, {"now": "2026-08-21T13:00:00", "updated": T0, "cadence_h": 24.0}),
    "sentinel.no_data_loss": ({"day_count": 9, "prev_day_count": 10}, {"day_count": 10, "prev_day_count": 10}),
    "sentinel.ledger_overdue": ({"judge_type": "manual", "judged": False, "due": "2026-08-19", "today": "2026-08-20"}, {"judge_type": "manual", "judged": False, "due": "2026-08-20", "today": "2026-08-20"}),
    "watch.sentinel_alive": ({"now": "2026-08-21T13:01:00", "at": T0}, {"now": "2026-08-21T13:00:00", "at": T0}),
    "watch.sentinel_verdict": ({"exit_code": 10}, {"exit_code": 0}),
    "watch.no_code_drift": ({"n_drift": 1}, {"n_drift": 0}),
    "watch.external_binaries": ({"binaries_known": True, "n_missing_binaries": 1}, {"binaries_known": True, "n_missing_binaries": 0}),
}


def test_the_catalogue_is_complete():
    assert len(checks.REGISTRY.rules) == 83 and set(CASES) == set(checks.REGISTRY.rules)
    assert {r.frame for r in checks.REGISTRY.rules.values()} == set(checks.FRAMES)


@pytest.mark.parametrize("name", sorted(checks.FRAMES))
def test_bad_rows_and_near_misses(spark, name):
    ids = [r.id for r in checks.REGISTRY.of(name)]
    lines = [json.dumps({**CASES[i][bad], "key": f"{i} {bad}"}) for i in ids for bad in (0, 1)]
    frame = spark.createDataFrame([(x,) for x in lines], "j string").select(F.from_json("j", checks.FRAMES[name]).alias("r")).select("r.*")
    got = {(r.key, r.check_id): r.level for r in rules.evaluate(frame, checks.REGISTRY.of(name), checks.CONFIG).collect()}
    for i in ids:
        assert got[f"{i} 0", i] != "PASS", i
        assert got[f"{i} 1", i] == "PASS", i


def test_careless_rules_are_rejected(spark):
    registry = rules.Registry()
    registry.add(rules.Rule("a.b", "x", "all"))
    for bad in (rules.Rule("a.b", "x", "all"), rules.Rule("a.c", "x", "")):
        with pytest.raises(ValueError):
            registry.add(bad)
    with pytest.raises(KeyError):
        rules.filled("x > {missing}", {})
    with pytest.raises(ValueError):
        rules.evaluate(spark.range(1), [], {})


def test_gate_counts_skipped_checks(spark):
    rows = [(str(i), f"c{i}", "SKIPPED") for i in range(4)] + [("x", "d", "PASS")]
    results = spark.createDataFrame(rows, "key string, check_id string, level string")
    assert rules.gate(rules.tally(results)).first().exit_code == 10
    assert rules.gate(rules.tally(results.where("check_id <> 'c0'"))).first().exit_code == 0
