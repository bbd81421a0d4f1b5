"""The check catalogue: 83 rules in nine suites over flat frames.

``FRAMES`` gives each frame's columns. Columns that come from other rows are made before rules
run: counts per group, ``in_...`` flags from joins against vocabularies, ``prev_...`` values from the
version before, ``found`` from grounding quotes in their texts.
"""

from __future__ import annotations

from larkspur.operators.rules import Registry, Rule

FRAMES = {
    # advisory
    "groups": "key string, label string, in_plan boolean, in_doc boolean, n_cards long, floor long, needs_base boolean, n_base long",
    "cards": "key string, ts string, date date, window_from timestamp, window_to timestamp, now timestamp, url string, in_previous boolean, exempt boolean, has_previous boolean, tone string, tag string, body string, body_is_text boolean, src string",
    "advisory_days": "key string, n_cards long, n_verdicts long, n_undecided long, n_bad_verdicts long, n_snap long, n_takeaways long, n_pulse long, level string, sections_in_order boolean, n_bad_dirs long, has_previous boolean, deep_median double, regular_median double, n_deep long, n_empty_index_fields long, n_threaded long, n_notes long, n_notes_missing long, note_chars_low long, note_chars_high long, bold_share double, from_ts string, to_date date, date date, prev_to_ts timestamp, window_start timestamp, window_end timestamp",
    "dispatch": "key string, quota long, owner_quota long, n_batches long, n_owners long",
    # chart
    "chart_days": "key string, date date, n_charts long, slots_in_order boolean, n_duplicate_themes long, n_unknown_themes long, n_not_line long, started boolean, track string, planned_track string, weekend_tagged boolean, is_weekend boolean, track_known boolean, previous_track string, size_kb double, data_path string, path_streak long, release_kind string, release_fresh boolean, main_slug string, main_theme string, has_release boolean, prefetch_age_h double, n_used_failed long, has_prefetch boolean",
    "charts": "key string, theme string, kind string, n_empty_fields long, title_chars long, reading_chars long, takeaway_chars long, so_what_chars long, paragraphs long, n_watch long, n_tags long, headline_chars long, standfirst_chars long, exempt boolean, n_series long, footer_lines long, source_width long, note_width long, needs_source boolean, inspired_url string, inspired_published date, date date, png_bytes long, n_option_mismatches long",
    "chart_series": "key string, cadence string, age_days long, n_dates long, n_values long, has_markers boolean, date_axis boolean",
    # draft
    "drafts": "key string, date string, n_items long, note string, upstream_date string, env_broken boolean",
    # podcast batches
    "manifests": "key string, n_missing_keys long, episodes_is_array boolean, start_ts timestamp, end_ts timestamp, generated_ts timestamp",
    "fetched": "key string, title string, duration_ms long, show_known boolean, status string, completeness double, repeat_tokens long, repeat_first long, release_ts timestamp, start_ts timestamp, end_ts timestamp, n_same long, file_id string, url_id string",
    # podcast documents
    "episodes": "key string, chars long, paragraphs long, low_chars long, high_chars long, low_paragraphs long, high_paragraphs long, exempt boolean, has_minutes boolean, n_topics long, n_bad_topics long, n_takeaways long, n_quotes long, placeholder boolean",
    "podcast_days": "key string, n_episodes long, n_points long, n_new_ledger long, has_transcripts boolean, n_quotes_missed long",
    "ledger": "key string, status string, due date, today date, grace_days long, judge_type string, judged boolean",
    # repository
    "files": "key string, n_token_lines long",
    "briefs": "key string, est_tokens long, budget long, budget_source string",
    # research
    "reports": "key string, n_private long, broker string, date date, top_hits long, second_hits long, removed_pct double, claimed_pages long, pages long, page_one_chars long, n_same_slug long, n_same_sha long, summary_chars long, low_chars long, high_chars long, n_tags long, longest_tag long, n_bad_tags long, n_unknown_tags long, n_charts long, n_missing_files long, n_render_errors long",
    "stances": "key string, found boolean, has_report boolean, theme_known boolean",
    "report_charts": "key string, n_ungrounded long, n_empty_fields long, n_values long, n_cats long",
    "research_days": "key string, n_engines long, n_tags long, n_repeated_tags long",
    # sentinels
    "indexes": "key string, now timestamp, latest timestamp, updated timestamp, cadence_h double, day_count long, prev_day_count long",
    "heartbeats": "key string, now timestamp, at timestamp, exit_code long, n_drift long, n_missing_binaries long, binaries_known boolean",
}

#: Thresholds; users replace them, and a rule whose key is missing fails to build.
CONFIG = {
    "site_low": 40, "site_high": 120, "snap": 6, "takeaways": 5, "pulse": 6, "deep_chars_low": 300, "regular_chars_low": 60, "deep_low": 3, "deep_high": 12,
    "threads_low": 1, "threads_high": 12, "note_low": 20, "note_high": 200, "bold_min": 0.5, "window_hour": "07", "window_offset": -1, "seam_h": 6, "window_low_h": 24, "window_h": 80,
    "tones": ["up", "down", "flat"], "tags": ["news", "data", "view"],
    "charts_per_day": 5, "themes": ["rates", "equities", "credit", "fx"], "kinds": ["timeseries", "range_area", "scatter", "heatmap", "gauge", "waterfall", "grouped_bar", "stacked_bar", "pct_stacked_bar"],
    "slots": ["main", "moves", "remake", "deep", "track"], "tracks": ["rates", "flows", "chips", "energy", "credit"], "weekend_tag": "weekly", "line_kinds": ["timeseries"], "diverse_from": "1993-01-01",
    "palette": ["lead", "contrast", "overflow", "background"], "weekly_series": ["H10"], "weekly_from": "1993-01-01", "run_at": "11:30", "so_what_low": 10, "so_what_high": 120, "paragraphs_low": 2, "watch_low": 1, "watch_high": 3,
    "chart_tags_low": 1, "chart_tags_high": 5, "headline_low": 5, "headline_high": 30, "standfirst_low": 10, "standfirst_high": 100,
    "undecided": "open", "verdicts": ["hit", "miss", "partly", "open"], "pulse_keys": ["us", "eu", "jp", "cn", "tw", "fx"],
    "tiers": [(30, 100, 900, 1, 4), (60, 200, 1600, 2, 6), (None, 300, 2600, 3, 9)], "topics": ["macro", "tech", "policy"], "placeholder": "[not collected]", "title_low": 8, "title_high": 40,
    "reading_low": 40, "reading_high": 400, "takeaway_low": 10, "takeaway_high": 120, "series_cap": 8, "series_warn": 8, "diverse_kinds": 2, "footer_max": 2, "footer_line": 60.0,
    "size_warn": 250, "size_fail": 600, "data_paths": ["primary", "backup", "manual"], "last_path": "manual", "path_streak": 3, "inspired_days": 7, "min_points": 20, "min_png": 20000,
    "prefetch_h": 30, "release_theme": "rates", "note_max": 100,
    "window_max_h": 72, "late_min": 5, "min_ms": 600000, "bad_titles": "(?i)trailer|preview", "statuses": ["OK", "PARTIAL", "FAILED"], "complete_low": 0.55, "complete_high": 1.35,
    "repeat_tokens": 150, "repeat_first": 200, "crosscut_from": 3, "ledger_low": 2, "ledger_high": 3, "topics_high": 3, "takeaways_low": 3, "takeaways_high": 5, "quotes_low": 2, "quotes_high": 5,
    "ledger_status": ["watching", "hit", "miss", "void"], "min_hits": 3, "margin": 3, "removed_warn": 8, "removed_fail": 15, "page_one": 200,
    "report_tags_low": 3, "report_tags_high": 6, "tag_chars": 12, "report_charts_low": 1, "report_charts_high": 4, "data_slack": 1.5, "updated_slack": 1.25, "heartbeat_h": 30, "research_grace": 14,
}

REGISTRY = Registry()


def rule(id: str, frame: str, blind_to: str, **conditions: str) -> None:
    REGISTRY.add(Rule(id, frame, blind_to, **conditions))


def hours(later: str, earlier: str) -> str:
    return f"((unix_micros({later}) - unix_micros({earlier})) / 3.6e9D)"


OFFSET = r"ts RLIKE '(Z|[+-]\\\\d\\\\d:?\\\\d\\\\d)$'".replace("\\\\\\\\", "\\\\")
TS = "try_to_timestamp(ts)"

rule("advisory.group_names", "groups", "what cards say", fail="NOT in_plan OR NOT in_doc")
rule("advisory.group_floors", "groups", "cards of low value", fail="in_plan AND coalesce(n_cards, 0) < floor")
rule("advisory.base_cards", "groups", "whether the base card is current", fail="needs_base AND coalesce(n_base, 0) = 0")
rule("advisory.site_total", "advisory_days", "how cards spread over groups", fail="n_cards < {site_low}", warn="n_cards > {site_high}")
rule("advisory.ts_wellformed", "cards", "times that are wrong but parse", fail=f"ts IS NULL OR {TS} IS NULL OR NOT ({OFFSET})")
rule("advisory.ts_in_window", "cards", "cards published elsewhere earlier", skip=f"{TS} IS NULL", fail=f"{TS} > now OR {TS} NOT BETWEEN window_from AND window_to")
rule("advisory.date_ts_consistent", "cards", "a wrong time with the same date", skip=f"{TS} IS NULL", fail=f"date IS NULL OR date <> to_date({TS} + INTERVAL 8 HOURS)")
rule("advisory.cross_version_dedup", "cards", "the same story under another address", skip="NOT has_previous", fail="in_previous AND NOT exempt")
rule("advisory.url_is_article", "cards", "articles without content", fail="url IS NULL OR NOT regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) RLIKE '^/[^/]+/.+' OR regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) RLIKE '(?i)/(tag|category|topic|author|page)/'")
rule("advisory.card_vocab", "cards", "a fitting word at the wrong place", fail="tone IS NULL OR tone NOT IN ({tones}) OR tag IS NULL OR tag NOT IN ({tags}) OR NOT body_is_text OR trim(coalesce(src, '')) = ''")
rule("advisory.watch_review", "advisory_days", "whether a verdict is right", skip="NOT has_previous", fail="n_verdicts = 0 OR n_bad_verdicts > 0 OR n_undecided = n_verdicts")
rule("advisory.fixed_structure", "advisory_days", "what fills the structure", fail="n_snap <> {snap} OR n_takeaways <> {takeaways} OR n_pulse <> {pulse} OR NOT sections_in_order OR n_bad_dirs > 0 OR NOT level RLIKE '^(100|[0-9]{{1,2}})$'")
rule("advisory.card_lengths", "advisory_days", "padding", warn="deep_median < {deep_chars_low} OR regular_median < {regular_chars_low} OR n_deep NOT BETWEEN {deep_low} AND {deep_high}")
rule("advisory.index_entry_source", "advisory_days", "fields that are there but wrong", fail="n_empty_index_fields > 0", warn="n_threaded NOT BETWEEN {threads_low} AND {threads_high}")
rule("advisory.overview_prose", "advisory_days", "what the prose claims", fail="n_notes_missing > 0 OR note_chars_low < {note_low} OR note_chars_high > {note_high}", warn="bold_share < {bold_min}")
rule("advisory.window_wellformed", "advisory_days", "events missed inside the window", fail="window_start IS NULL OR window_end IS NULL OR date_format(window_start + INTERVAL 8 HOURS, 'HH:mm:ss') <> '{window_hour}:00:00' OR to_date(window_start + INTERVAL 8 HOURS) <> date_add(date, {window_offset}) OR window_end <= window_start OR to_date <> date OR window_start > prev_to_ts", warn=f"{hours('prev_to_ts', 'window_start')} > {{seam_h}} OR {hours('window_end', 'window_start')} NOT BETWEEN {{window_low_h}} AND {{window_h}}")
rule("advisory.dispatch_wellformed", "dispatch", "collectors that do nothing", fail="quota <> owner_quota OR n_batches <> 1 OR n_owners <> 1")

rule("chart.structure", "chart_days", "the charts' content", fail="n_charts <> {charts_per_day} OR NOT slots_in_order")
rule("chart.theme_unique", "chart_days", "two charts of one idea", fail="n_duplicate_themes > 0 OR n_unknown_themes > 0")
rule("chart.kind_data_present", "charts", "wrong values", fail="kind IS NULL OR kind NOT IN ({kinds}) OR n_empty_fields > 0")
rule("chart.lengths", "charts", "what is said", skip="exempt", fail="title_chars NOT BETWEEN {title_low} AND {title_high} OR reading_chars NOT BETWEEN {reading_low} AND {reading_high} OR takeaway_chars NOT BETWEEN {takeaway_low} AND {takeaway_high} OR so_what_chars NOT BETWEEN {so_what_low} AND {so_what_high} OR paragraphs < {paragraphs_low} OR n_watch NOT BETWEEN {watch_low} AND {watch_high} OR n_tags NOT BETWEEN {chart_tags_low} AND {chart_tags_high} OR headline_chars NOT BETWEEN {headline_low} AND {headline_high} OR standfirst_chars NOT BETWEEN {standfirst_low} AND {standfirst_high}")
rule("chart.series_cap", "charts", "overlapping lines", fail="n_series > {series_cap}", warn="n_series = {series_warn}")
rule("chart.diversity", "chart_days", "kinds that do not fit", skip="NOT started", fail="n_not_line < {diverse_kinds}")
rule("chart.footer_lines", "charts", "other fonts", fail="coalesce(footer_lines, ceil(source_width / {footer_line}) + ceil(note_width / {footer_line})) > {footer_max}", warn="coalesce(footer_lines, ceil(source_width / {footer_line}) + ceil(note_width / {footer_line})) = {footer_max}")
rule("chart.series_freshness", "chart_series", "revisions", fail="(cadence = 'daily' AND age_days >= 5) OR (cadence = 'monthly' AND age_days DIV 30 >= 3) OR (cadence = 'weekly' AND age_days DIV 7 >= 3)", warn="(cadence = 'daily' AND age_days >= 2) OR (cadence = 'monthly' AND age_days DIV 30 >= 2) OR (cadence = 'weekly' AND age_days DIV 7 >= 2)")
rule("chart.option_matches_spec", "charts", "both tracks wrong alike", fail="n_option_mismatches > 0")
rule("chart.track_of_the_day", "chart_days", "content of the track", skip="n_charts = 0", fail="track IS NULL OR NOT track_known OR track <> planned_track OR coalesce(weekend_tagged, false) <> is_weekend OR (is_weekend AND dayofweek(date) = 1 AND track = previous_track)")
rule("chart.size", "chart_days", "what takes the space", fail="size_kb > {size_fail}", warn="size_kb > {size_warn}")
rule("chart.data_path_named", "chart_days", "whether the path was used", fail="data_path IS NULL OR data_path NOT IN ({data_paths})", warn="data_path = '{last_path}'")
rule("chart.provenance", "charts", "the linked page", skip="NOT needs_source", fail="inspired_url IS NULL OR inspired_published IS NULL OR datediff(date, inspired_published) NOT BETWEEN 0 AND {inspired_days}")
rule("chart.series_wellformed", "chart_series", "wrong values", fail="n_dates <> n_values OR n_dates < {min_points} OR (has_markers AND NOT date_axis)")
rule("chart.png_present", "charts", "the picture", fail="png_bytes IS NULL OR png_bytes < {min_png}")
rule("chart.prefetch_fresh", "chart_days", "stale sources", skip="NOT has_prefetch", fail="prefetch_age_h IS NULL OR prefetch_age_h > {prefetch_h} OR n_used_failed > 0")
rule("chart.data_path_streak", "chart_days", "why the first path fails", fail="path_streak >= {path_streak}", warn="path_streak > 0")
rule("chart.release_day", "chart_days", "releases nobody recorded", skip="NOT has_release", fail="release_fresh AND (main_slug <> concat(lower(release_kind), '-release') OR main_theme <> '{release_theme}')")

rule("demo.date_present", "drafts", "a wrong date", fail="date IS NULL OR NOT date RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'")
rule("demo.items_nonempty", "drafts", "useless items", skip="n_items IS NULL", fail="n_items = 0")
rule("demo.note_length", "drafts", "what the note says", warn="length(note) > {note_max}")
rule("demo.upstream_fresh", "drafts", "an upstream that lies", skip="upstream_date IS NULL", warn="env_broken")

rule("podcast.manifest_wellformed", "manifests", "values of the keys", fail="n_missing_keys > 0 OR NOT episodes_is_array OR start_ts IS NULL OR end_ts IS NULL OR generated_ts IS NULL")
rule("podcast.window_sane", "manifests", "a window of the wrong day", fail=f"start_ts >= end_ts OR {hours('end_ts', 'generated_ts')} * 60 > {{late_min}} OR {hours('end_ts', 'start_ts')} > {{window_max_h}}")
rule("podcast.episode_admission", "fetched", "unmarked trailers", fail="title RLIKE '{bad_titles}' OR duration_ms < {min_ms}")
rule("podcast.show_keys_known", "fetched", "a wrong but known show", fail="NOT show_known")
rule("podcast.status_vocabulary", "fetched", "a wrong status", fail="status IS NULL OR status NOT IN ({statuses})")
rule("podcast.no_failed_episodes", "fetched", "bad texts with a good status", fail="status = 'FAILED'")
rule("podcast.completeness_band", "fetched", "the right length with the wrong words", fail="completeness < {complete_low}", warn="completeness > {complete_high}")
rule("podfetch.no_block_repetition", "fetched", "short loops", fail="repeat_tokens >= {repeat_tokens} AND repeat_first >= {repeat_first}")
rule("podcast.release_in_window", "fetched", "a feed with wrong dates", fail="release_ts NOT BETWEEN start_ts AND end_ts")
rule("podcast.no_duplicate_episodes", "fetched", "the same show cut anew", fail="n_same > 1")
rule("podcast.file_id_matches_url", "fetched", "an id of another show", fail="file_id IS NULL OR url_id IS NULL OR file_id <> url_id")

rule("podcast.chars_in_tier", "episodes", "padding", fail="NOT has_minutes OR chars > high_chars OR (chars < low_chars AND NOT coalesce(exempt, false)) OR paragraphs NOT BETWEEN low_paragraphs AND high_paragraphs")
rule("podcast.topics_controlled", "episodes", "a topic that does not fit", fail="n_bad_topics > 0 OR n_topics NOT BETWEEN 1 AND {topics_high}")
rule("podcast.per_episode_counts", "episodes", "what points say", fail="n_takeaways NOT BETWEEN {takeaways_low} AND {takeaways_high} OR (placeholder AND n_quotes > 0) OR (NOT placeholder AND n_quotes NOT BETWEEN {quotes_low} AND {quotes_high})")
rule("podcast.crosscut_present", "podcast_days", "weak links", fail="n_episodes >= {crosscut_from} AND coalesce(n_points, 0) = 0")
rule("podcast.quotes_grounded", "podcast_days", "quotes out of context", skip="NOT has_transcripts", fail="n_quotes_missed > 0")
rule("podcast.ledger_advanced", "podcast_days", "claims nobody can judge", fail="n_new_ledger NOT BETWEEN {ledger_low} AND {ledger_high}")
rule("podcast.ledger_no_overdue", "ledger", "verdicts that are wrong", fail="status = 'watching' AND datediff(today, due) > grace_days", warn="status = 'watching' AND due < today")

rule("repo.no_pull_request_target", "files", "other risky triggers", fail="n_token_lines > 0")
rule("repo.brief_budget", "briefs", "quality of the brief", fail="est_tokens > budget OR trim(coalesce(budget_source, '')) = ''")

rule("research.no_pii", "reports", "data in pictures", fail="n_private > 0")
rule("research.identified", "reports", "a wrong name that is often cited", fail="broker IS NULL OR date IS NULL OR top_hits < {min_hits}", warn="top_hits < {margin} * 2 * second_hits")
rule("research.strip_bounded", "reports", "what was cut", fail="removed_pct >= {removed_fail}", warn="removed_pct >= {removed_warn}")
rule("research.page_count", "reports", "pages out of order", skip="claimed_pages IS NULL", fail="claimed_pages <> pages")
rule("research.page_one_substantial", "reports", "a page of disclaimers", fail="page_one_chars < {page_one}")
rule("research.no_duplicates", "reports", "the same report exported anew", fail="n_same_slug > 1 OR n_same_sha > 1")
rule("research.stance_grounded", "stances", "quotes out of context", fail="NOT has_report OR NOT coalesce(found, false)")
rule("research.theme_in_domain", "stances", "a theme that does not fit", fail="NOT theme_known")
rule("research.summary_length", "reports", "padding", fail="summary_chars < low_chars", warn="summary_chars > high_chars")
rule("research.chart_grounded", "report_charts", "numbers that stand there by chance", fail="n_ungrounded > 0")
rule("research.tags_wellformed", "reports", "tags that do not fit", fail="n_tags NOT BETWEEN {report_tags_low} AND {report_tags_high} OR longest_tag > {tag_chars} OR n_bad_tags > 0 OR n_unknown_tags > 0")
rule("research.chart_files_present", "reports", "broken pictures", fail="n_missing_files > 0 OR n_render_errors > 0 OR n_charts NOT BETWEEN {report_charts_low} AND {report_charts_high}")
rule("research.ledger_no_overdue", "ledger", "verdicts that are wrong", fail="status NOT IN ({ledger_status}) OR (status = 'watching' AND datediff(today, due) > {research_grace})")
rule("research.chart_spec_wellformed", "report_charts", "wrong values", fail="n_empty_fields > 0 OR n_values <> n_cats")
rule("research.one_engine", "research_days", "an engine that changed its version", fail="n_engines = 0", warn="n_engines > 1")

rule("sentinel.data_fresh", "indexes", "days with wrong content", fail=f"latest IS NULL OR {hours('now', 'latest')} > cadence_h * {{data_slack}}")
rule("sentinel.no_future_date", "indexes", "a clock that is wrong here too", skip="latest IS NULL", fail="latest > now")
rule("sentinel.updated_fresh", "indexes", "updates without change", fail=f"{hours('now', 'updated')} > cadence_h * {{updated_slack}}", warn="updated > now")
rule("sentinel.no_data_loss", "indexes", "days replaced by others", skip="prev_day_count IS NULL", fail="day_count < prev_day_count")
rule("sentinel.ledger_overdue", "ledger", "entries never written", warn="judge_type = 'manual' AND NOT judged AND due < today")

rule("watch.sentinel_alive", "heartbeats", "a sentinel that checks nothing", fail=f"at IS NULL OR {hours('now', 'at')} > {{heartbeat_h}}")
rule("watch.sentinel_verdict", "heartbeats", "what the sentinel cannot see", fail="exit_code <> 0")
rule("watch.no_code_drift", "heartbeats", "code that is wrong at both places", skip="n_drift IS NULL", fail="n_drift > 0")
rule("watch.external_binaries", "heartbeats", "binaries that do not work", skip="NOT binaries_known", fail="n_missing_binaries > 0")
