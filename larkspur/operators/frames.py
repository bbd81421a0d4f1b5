"""From nested JSON documents to the flat frames of the check catalogue.

``parsed`` reads documents by a declared schema (what does not parse is kept, never dropped), and one function per frame counts,
compares and looks up everything its rules need: fields inside the document, the version of the day before, vocabularies, files and
transcripts. Arrays are folded inside their row; other rows are met by equality joins or windows over a batch, a slug or a digest.
A large advisory comes in parts, rows of one key: every part repeats the head and holds some of the cards, and no row ever holds them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.scalars import PRIVATE, match_form
from larkspur.operators.checks import CONFIG, FRAMES

#: Which fields hold the data of each kind of chart, which kinds have a category axis, and which take date marks.
KIND_FIELDS = {
    "timeseries": ["series"], "range_area": ["series"], "scatter": ["pts"], "heatmap": ["matrix"], "gauge": ["vals"], "waterfall": ["cats", "vals"],
    "grouped_bar": ["cats", "groups"], "stacked_bar": ["cats", "groups"], "pct_stacked_bar": ["cats", "groups"],
}
CATEGORY_KINDS, BAR_KINDS, MARKED_KINDS = ["grouped_bar", "stacked_bar", "pct_stacked_bar", "waterfall"], ["grouped_bar", "stacked_bar", "pct_stacked_bar"], ["timeseries", "range_area"]
#: Fixed value: what parts the kind of a slot from its name.
SLOT_MARK = "｜"

#: Fixed value: stands for the length of a text that is null.
_LONGEST = 2147483647

_VALUES = "cats array<string>, vals array<double>, groups array<struct<name string, `values` array<double>>>, pts array<array<double>>, matrix array<array<double>>"
_CARD = "title string, url string, src string, ts string, date string, tone string, tagcls string, body variant, bullets array<string>, base boolean, deep boolean, thread string"
SCHEMAS = {
    "chart": f"""date string, headline string, standfirst string, now string, about struct<data_path string, macro_release array<struct<kind string, fresh boolean>>>,
        charts array<struct<slug string, slot string, theme string, kind string, title string, takeaway string, reading string, so_what string, watch array<string>, tags array<string>,
        source string, note string, footer_lines int, zero_line boolean, markers array<struct<date string>>, series array<struct<name string, dates array<string>, `values` array<double>>>,
        series_spec array<struct<id string, name string>>, {_VALUES}, provenance struct<inspired_by struct<url string, published string>>,
        option struct<color array<string>, xAxis struct<data array<string>>, series array<struct<type string, stackStrategy string, barWidth string, data array<double>, markLine struct<data array<struct<yAxis double>>>>>>>>,
        png map<string, bigint>, prefetch struct<finished string, failed map<string, string>, skipped map<string, string>>""",
    "advisory": f"""date string, weekday string, stamp string, headline string, cards int, now string, window struct<`from` string, `to` string>,
        sections array<struct<name string, groups array<struct<label string, cards array<struct<{_CARD}>>>>>>,
        overview struct<snap array<struct<k string>>, takeaways array<string>, pulse array<struct<k string, dir string, note string>>, thermo struct<level string, note string>,
        watch array<struct<w string>>, watchReview array<struct<d string, w string, t string, note string, verdict string>>>""",
    "plan": """groups array<struct<name string, floor struct<weekday bigint, weekend bigint>, quota struct<weekday bigint, weekend bigint>, base boolean,
        owners struct<weekday map<string, bigint>, weekend map<string, bigint>>>>, roster map<string, struct<sources array<string>>>, batches array<array<string>>""",
    "draft": "date string, items array<string>, note string, upstream_date string",
    "manifest": """generatedAt string, windowStartUtc string, windowEndUtc string, episodes variant""",
    "podcast": """date string, episodes array<struct<id string, minutes double, chars bigint, topics array<string>, takeaways array<string>, quotes array<struct<original string, `by` string>>,
        source string, lowerBoundException string, sections array<struct<paragraphs array<string>>>>>, crossCut struct<points array<string>>""",
    "ledger": "today string, grace_days bigint, items array<struct<id string, date string, due string, status string, judge struct<type string, at string>>>",
    "files": "path string, text string",
    "brief": "path string, budget bigint, budget_source string, text string",
    "report": """batch string, slug string, sha256 string, source_file string, broker string, broker_tally map<string, bigint>, date string, pages bigint, claimed_pages bigint, engine string,
        page_one string, body array<string>, tables array<struct<`rows` array<array<string>>>>, strip_report struct<removed_pct double>""",
    "digest": f"""reports array<struct<slug string, summary_chars bigint, tier_band array<bigint>, tags array<string>, stances array<struct<quote string, theme string>>,
        charts array<struct<kind string, title string, grounding array<string>, {_VALUES}, png string, svg string, render_error string>>>>""",
    "index": "now string, updated string, cadence_hours double, days array<struct<date string>>, prev struct<day_count bigint>",
    "heartbeat": "now string, heartbeat struct<at string, `exit` bigint>, drift array<string>, binaries map<string, boolean>",
}


def parsed(raw: DataFrame, kind: str) -> DataFrame:
    """``raw`` (``key, json``) with ``doc`` and, where the text is no such document, the text again as ``malformed``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    doc = F.from_json("json", f"{SCHEMAS[kind]}, malformed string", options)
    return raw.withColumn("doc", doc).withColumn("malformed", F.col("doc.malformed"))


def framed(df: DataFrame, name: str) -> DataFrame:
    """The columns of a frame, in its types; those that ``df`` lacks are null."""
    wanted = [c.strip().split(" ", 1) for c in FRAMES[name].split(",")]
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in wanted))


def _n(array: str) -> Column:
    """Length of an array, 0 for null."""
    return F.coalesce(F.expr(f"size({array})").cast("long"), F.lit(0)) if array.isidentifier() else F.greatest(F.coalesce(F.expr(f"cardinality({array})"), F.lit(0)), F.lit(0)).cast("long")


def _any(array: str, lambda_: str) -> Column:
    return F.expr(f"coalesce(size(filter({array}, {lambda_})), 0)").cast("long")


def _quoted(words: list[str]) -> str:
    return "array(" + ", ".join("'" + w.replace("'", "\\'") + "'" for w in words) + ")"


def _time(text: str) -> str:
    return f"try_to_timestamp({text})"


def exploded(docs: DataFrame, array: str, name: str) -> DataFrame:
    """A row for each element, as ``name``, with its place ``i``."""
    return docs.select("*", F.posexplode(array).alias("i", name))


# charts


def chart_days(docs: DataFrame, config: dict = CONFIG) -> DataFrame:
    """One row a day. The day before is that of the calendar; a streak of the last data path ends with a day on another."""
    d = docs.select("key", F.octet_length("json").alias("bytes"), "doc.*").withColumn("day", F.try_to_timestamp("date").cast("date"))
    slots, tracks = config["slots"], config["tracks"]
    heads = f"transform(charts, c -> split(c.slot, '{SLOT_MARK}')[0])"
    in_order = f"forall(sequence(1, least(size(charts), {len(slots)})), i -> element_at({heads}, i) = element_at({_quoted(slots)}, i))"
    themes = f"filter(transform(charts, c -> c.theme), t -> array_contains({_quoted(config['themes'])}, t))"
    last = "element_at(charts, -1).slot"
    name = F.expr(f"get(split({last}, '{SLOT_MARK}'), 1)")
    base = F.split(name, "（")[0]
    weekday = F.weekday("day")
    planned = F.get(F.array(*map(F.lit, tracks)), weekday)
    main = F.expr(f"get(filter(charts, c -> split(c.slot, '{SLOT_MARK}')[0] = '{slots[0]}'), 0)")
    due = F.try_to_timestamp(F.concat("date", F.lit(f"T{config['run_at']}:00+08:00")))
    fresh = "filter(about.macro_release, r -> r.fresh)"
    d = d.select(
        "key", "day", "bytes", _n("charts").alias("n_charts"), F.expr(in_order).alias("slots_in_order"),
        F.expr(f"size({themes}) - size(array_distinct({themes}))").alias("n_duplicate_themes"),
        _any("charts", f"c -> NOT coalesce(array_contains({_quoted(config['themes'])}, c.theme), false)").alias("n_unknown_themes"),
        _any("charts", f"c -> NOT coalesce(array_contains({_quoted(config['line_kinds'])}, c.kind), false)").alias("n_not_line"),
        (F.col("day") >= F.lit(config["diverse_from"]).cast("date")).alias("started"), base.alias("track"), planned.alias("planned_track"),
        F.contains(name, F.lit(config["weekend_tag"])).alias("weekend_tagged"), (weekday >= 5).alias("is_weekend"), base.isin(tracks).alias("track_known"),
        F.col("about.data_path").alias("data_path"), (F.size(F.expr(fresh)) > 0).alias("release_fresh"), F.expr(f"get({fresh}, 0).kind").alias("release_kind"),
        F.col("about.macro_release").isNotNull().alias("has_release"), main["slug"].alias("main_slug"), main["theme"].alias("main_theme"),
        ((F.unix_micros(due) - F.unix_micros(F.expr(_time("prefetch.finished")))) / 3.6e9).alias("prefetch_age_h"),
        F.expr("""coalesce(size(filter(array_distinct(flatten(filter(transform(charts, c -> transform(c.series, s -> coalesce(get(filter(c.series_spec, p -> p.name = s.name), 0).id, s.name))), x -> x IS NOT NULL))),
            x -> coalesce(map_contains_key(prefetch.failed, x), false) OR coalesce(map_contains_key(prefetch.skipped, x), false))), 0)""").alias("n_used_failed"),
    )
    d = d.withColumn("has_prefetch", (F.col("data_path") == config["data_paths"][0]) & F.coalesce(F.col("prefetch_age_h") >= 0, F.lit(True)))
    before = d.select(F.date_add("day", 1).alias("day"), F.col("track").alias("previous_track"))
    d = d.join(before, "day", "left")
    # how many documents in a row, up to this one, took the last path; one narrow row a day of the calendar is put in order
    days = Window.orderBy("day", "key")
    backed = F.coalesce(F.col("data_path") == config["last_path"], F.lit(False))
    placed = d.select("key", "day", backed.alias("backed")).withColumn("place", F.row_number().over(days))
    placed = placed.withColumn("other", F.max(F.when(~F.col("backed"), F.col("place"))).over(days))
    streaks = placed.select("key", F.when(F.col("backed"), F.col("place") - F.coalesce("other", F.lit(0))).otherwise(0).alias("path_streak"))
    return framed(d.join(streaks, "key").withColumn("size_kb", F.col("bytes") / 1024).withColumn("date", F.col("day")), "chart_days")


def _option_mismatches() -> Column:
    """How often the drawn option departs from the chart it is made from."""
    o, bars = "c.option", "filter(c.option.series, s -> s.type = 'bar')"
    cats, bar = _quoted(CATEGORY_KINDS), _quoted(BAR_KINDS)
    want = "(coalesce(size(c.cats), 0) + IF(c.kind = 'waterfall', 1, 0))"
    bases = """concat(aggregate(c.vals, struct(CAST(0 AS DOUBLE) AS run, CAST(array() AS array<double>) AS low),
        (a, v) -> struct(a.run + v AS run, concat(a.low, array(least(a.run, a.run + v))) AS low), a -> a.low), array(CAST(0 AS DOUBLE)))"""
    parts = [
        f"{o}.color IS NOT NULL AND {o}.color <> {_quoted(CONFIG['palette'])}",
        f"array_contains({cats}, c.kind) AND {o}.xAxis.data IS NOT NULL AND size({o}.xAxis.data) <> {want}",
        f"c.kind = 'waterfall' AND exists({bars}, s -> NOT s.stackStrategy <=> 'all')",
        f"""c.kind = 'waterfall' AND size(c.vals) > 0 AND size(get({bars}, 0).data) = size(c.vals) + 1
            AND exists(zip_with(get({bars}, 0).data, {bases}, (g, w) -> coalesce(abs(g - w) > 0.01, true)), x -> x)""",
        f"array_contains({bar}, c.kind) AND size({o}.series) > 1 AND exists({o}.series, s -> s.barWidth IS NOT NULL)",
        f"coalesce(c.zero_line, false) AND c.kind NOT IN ('gauge', 'heatmap') AND NOT coalesce(exists({o}.series, s -> coalesce(exists(s.markLine.data, m -> coalesce(m.yAxis = 0, false)), false)), false)",
    ]
    sizes = f"IF(array_contains({cats}, c.kind), coalesce(size(filter({bars}, s -> s.data IS NOT NULL AND size(s.data) <> {want})), 0), 0)"
    total = " + ".join([*(f"IF(coalesce({p}, false), 1, 0)" for p in parts), sizes])
    return F.when(F.expr(f"{o} IS NULL"), 1).otherwise(F.expr(total)).cast("long")


def charts(docs: DataFrame, config: dict = CONFIG, exempt: DataFrame | None = None) -> DataFrame:
    """One row a chart; ``exempt`` (``date, slug``) names charts of old days that lengths do not judge."""
    c = exploded(docs.select("key", "doc.*"), "charts", "c")
    empty = "CASE c.kind " + " ".join(
        f"WHEN '{k}' THEN " + " + ".join(f"IF(coalesce(size(c.{f}), 0) = 0, 1, 0)" for f in fields) for k, fields in KIND_FIELDS.items()
    ) + " ELSE 0 END"
    width = lambda x: F.coalesce(F.length(x) + F.length(F.regexp_replace(x, "[^\\x{2E81}-\\x{10FFFF}]", "")), F.lit(0))
    chars = lambda x: F.length(F.coalesce(F.col(x), F.lit("")))
    rows = c.select(
        F.concat_ws(":", "key", "c.slug").alias("key"), F.try_to_timestamp("date").cast("date").alias("date"), F.col("c.slug").alias("slug"), "c.theme", "c.kind", F.expr(empty).alias("n_empty_fields"),
        chars("c.title").alias("title_chars"), chars("c.reading").alias("reading_chars"), chars("c.takeaway").alias("takeaway_chars"), chars("c.so_what").alias("so_what_chars"),
        F.size(F.split(F.coalesce("c.reading", F.lit("")), "\n\n")).alias("paragraphs"), _n("c.watch").alias("n_watch"), _n("c.tags").alias("n_tags"),
        chars("headline").alias("headline_chars"), chars("standfirst").alias("standfirst_chars"), _n("c.series").alias("n_series"), "c.footer_lines",
        width(F.col("c.source")).alias("source_width"), width(F.col("c.note")).alias("note_width"),
        (F.split("c.slot", SLOT_MARK)[0] == config["slots"][2]).alias("needs_source"), F.nullif("c.provenance.inspired_by.url", F.lit("")).alias("inspired_url"),
        F.try_to_timestamp("c.provenance.inspired_by.published").cast("date").alias("inspired_published"), F.try_element_at("png", F.col("c.slug")).alias("png_bytes"),
        _option_mismatches().alias("n_option_mismatches"),
    )
    if exempt is not None:
        named = exempt.select(F.col("date").cast("date").alias("date"), "slug").distinct().withColumn("exempt", F.lit(True))
        rows = rows.join(named, ["date", "slug"], "left").withColumn("exempt", F.coalesce("exempt", F.lit(False)))
    return framed(rows, "charts")


def chart_series(docs: DataFrame, config: dict = CONFIG) -> DataFrame:
    """One row a series. What ends on the first of a month counts months; listed identifiers count weeks."""
    c = exploded(docs.select("key", "doc.*"), "charts", "c").withColumnRenamed("i", "chart")
    s = exploded(c, "c.series", "s")
    last = F.expr("array_max(transform(filter(s.dates, x -> length(x) >= 10), x -> left(x, 10)))")
    ident = F.expr("get(filter(c.series_spec, p -> p.name = s.name), 0).id")
    weekly = ident.isin(config["weekly_series"]) & (F.try_to_timestamp("date") >= F.lit(config["weekly_from"]).cast("date"))
    cadence = F.when(last.endswith("-01"), "monthly").when(weekly, "weekly").otherwise("daily")
    today = F.expr("CAST(try_to_timestamp(now) + INTERVAL 8 HOURS AS DATE)")
    rows = s.select(
        F.concat_ws(":", "key", "c.slug", F.col("i").cast("string")).alias("key"), cadence.alias("cadence"), F.datediff(today, last.try_cast("date")).alias("age_days"), _n("s.dates").alias("n_dates"),
        _n("s.`values`").alias("n_values"), (_n("c.markers") > 0).alias("has_markers"), F.coalesce(F.col("c.kind"), F.lit("timeseries")).isin(MARKED_KINDS).alias("date_axis"),
    )
    return framed(rows, "chart_series")


# advisory


def cards(docs: DataFrame, exempt: list[str] = ()) -> DataFrame:
    """One row a card, with whether its address stood in the document of the day before."""
    d = docs.select("key", F.try_to_timestamp("doc.date").cast("date").alias("day"), "doc.*")
    flat = d.select("*", F.explode(F.expr("flatten(filter(transform(sections, s -> flatten(filter(transform(s.groups, g -> transform(g.cards, c -> struct(g.label AS label, c AS c))), x -> x IS NOT NULL))), x -> x IS NOT NULL))")).alias("x"))
    old = flat.select(F.date_add("day", 1).alias("day"), F.col("x.c.url").alias("url"), F.lit(True).alias("in_previous")).where("url IS NOT NULL").distinct()
    days = d.select(F.date_add("day", 1).alias("day"), F.lit(True).alias("has_previous")).distinct()
    time = lambda x: F.expr(_time(x))
    rows = flat.select(
        F.concat_ws(":", "key", "x.label", "x.c.title").alias("key"), "day", "x.c.ts", F.to_date(F.expr("try_to_timestamp(replace(x.c.date, '/', '-'))")).alias("date"), time("window.`from`").alias("window_from"),
        time("window.`to`").alias("window_to"), time("now").alias("now"), "x.c.url", "x.c.tone", F.col("x.c.tagcls").alias("tag"), F.expr("CAST(x.c.body AS STRING)").alias("body"),
        F.coalesce(F.expr("schema_of_variant(x.c.body) = 'STRING'"), F.lit(False)).alias("body_is_text"), "x.c.src", F.col("x.c.url").isin(list(exempt)).alias("exempt"),
    )
    rows = rows.join(old, ["day", "url"], "left").join(days, "day", "left")
    return framed(rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_previous", "has_previous")}), "cards")


def _grouped(docs: DataFrame) -> DataFrame:
    """``key, mode, label, n_cards, n_base`` of the groups that have cards; a window that starts on a weekend has the weekend's floors."""
    mode = F.when(F.weekday(F.expr("CAST(try_to_timestamp(doc.window.`from`) + INTERVAL 8 HOURS AS DATE)")) >= 5, "weekend").otherwise("weekday")
    g = docs.select("key", mode.alias("mode"), F.explode(F.expr("flatten(filter(transform(doc.sections, s -> s.groups), x -> x IS NOT NULL))")).alias("g")).where("size(g.cards) > 0")
    return g.groupBy("key", "mode", F.col("g.label").alias("label")).agg(F.sum(F.size("g.cards")).alias("n_cards"), F.sum(F.expr("size(filter(g.cards, c -> coalesce(c.base, false)))")).alias("n_base"))


def groups(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Planned against present groups, for each day."""
    p = plan.select(F.explode("doc.groups").alias("p")).select(F.col("p.name").alias("label"), "p.floor", F.coalesce("p.base", F.lit(False)).alias("needs_base"))
    have = _grouped(docs)
    mode = F.when(F.weekday(F.expr("CAST(try_to_timestamp(doc.window.`from`) + INTERVAL 8 HOURS AS DATE)")) >= 5, "weekend").otherwise("weekday")
    wanted = docs.select("key", mode.alias("mode")).distinct().join(F.broadcast(p.agg(F.collect_list(F.struct("label", "floor", "needs_base")).alias("ps")))).select("key", "mode", F.inline("ps")).withColumn("in_plan", F.lit(True))
    both = wanted.join(have.drop("mode").withColumn("in_doc", F.lit(True)), ["key", "label"], "full_outer")
    floor = F.when(F.col("mode") == "weekend", F.col("floor.weekend")).otherwise(F.col("floor.weekday"))
    rows = both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_plan", "in_doc", "needs_base")}).withColumn("floor", floor)
    return framed(rows.withColumn("key", F.concat_ws(":", "key", "label")), "groups")


def dispatch(plan: DataFrame) -> DataFrame:
    """Quotas against what owners are given, by group and mode; in how many batches each collector is; of how many collectors each source is."""
    g = plan.select("key", F.explode("doc.groups").alias("g"))
    mode = lambda m: F.struct(
        F.concat_ws(":", F.col("key"), F.col("g.name"), F.lit(m)).alias("key"), F.col(f"g.quota.{m}").alias("quota"),
        F.expr(f"coalesce(aggregate(map_values(g.owners.{m}), CAST(0 AS BIGINT), (a, x) -> a + x), 0)").alias("owner_quota"),
    )
    quotas = g.select(F.inline(F.array(mode("weekday"), mode("weekend")))).withColumn("n_batches", F.lit(1)).withColumn("n_owners", F.lit(1))
    roster = plan.select("key", F.explode("doc.roster").alias("name", "who"), "doc.batches")
    count = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    collectors = roster.select(F.concat_ws(":", "key", "name").alias("key"), count(F.expr("size(filter(flatten(filter(batches, x -> x IS NOT NULL)), b -> b = name))")).alias("n_batches"), F.least(count(F.size("who.sources")), F.lit(1)).alias("n_owners"))
    sources = roster.select("key", F.explode("who.sources").alias("source")).groupBy(F.concat_ws(":", "key", "source").alias("key")).agg(F.count("*").alias("n_owners"))
    one, none = F.lit(1), F.lit(0)
    rows = quotas.unionByName(collectors.withColumn("quota", none).withColumn("owner_quota", none)).unionByName(
        sources.withColumn("quota", none).withColumn("owner_quota", none).withColumn("n_batches", one), allowMissingColumns=True
    )
    return framed(rows, "dispatch")


def _with_card_counts(docs: DataFrame) -> DataFrame:
    """One row a document: its head, how many cards its parts hold, how many of them are deep or threaded, and the upper medians of their lengths.

    Medians are exact: what is kept of a document is how often each length comes. Lengths that are null count as the longest.
    """
    d = docs.select("key", F.try_to_timestamp("doc.date").cast("date").alias("day"), "doc.*")
    every = "flatten(filter(transform(sections, s -> flatten(filter(transform(s.groups, g -> g.cards), x -> x IS NOT NULL))), x -> x IS NOT NULL))"
    chars = "length(coalesce(IF(schema_of_variant(c.body) = 'STRING', CAST(c.body AS STRING), ''), '')) + aggregate(coalesce(c.bullets, array()), 0, (a, b) -> a + length(b))"
    sized = f"transform({every}, c -> named_struct('deep', coalesce(c.deep, false), 'n', coalesce({chars}, {_LONGEST}), 'threaded', coalesce(c.thread <> '', false)))"
    parts = d.select("key", F.struct(*(c for c in d.columns if c not in ("key", "sections"))).alias("head"), F.expr(sized).alias("sized")).withColumn("listed", F.col("sized").isNotNull())
    rows = parts.select("key", "head", "listed", F.posexplode_outer("sized").alias("i", "c"))
    middle = lambda which: F.expr(f"nullif(percentile_disc(0.5) WITHIN GROUP (ORDER BY IF({which}, c.n, NULL) DESC), {_LONGEST})")
    found = rows.groupBy("key").agg(
        F.any_value(F.when(F.coalesce("i", F.lit(0)) == 0, F.col("head")), True).alias("head"), F.max("listed").alias("listed"), F.count("i").alias("n_cards"), F.count_if("c.deep").alias("n_deep"),
        F.count_if("c.threaded").alias("n_threaded"), middle("c.deep").alias("deep_median"), middle("NOT c.deep").alias("regular_median"),
    )
    return found.select("key", "head.*", *(F.when(F.col("listed"), F.col(c)).alias(c) for c in ("n_cards", "n_deep")), "n_threaded", "deep_median", "regular_median")


def advisory_days(docs: DataFrame, config: dict = CONFIG) -> DataFrame:
    """One row a day: counts, medians and the window against that of the day before."""
    said = lambda x: f"trim(coalesce({x}, ''))"
    d = _with_card_counts(docs)
    d = d.withColumn("notes", F.expr(f"transform(overview.pulse, p -> length({said('p.note')}))"))
    before = docs.select("key", F.date_add(F.try_to_timestamp("doc.date").cast("date"), 1).alias("day"), F.expr(_time("doc.window.`to`")).alias("prev_to_ts")).distinct()
    old = before.drop("key").withColumn("has_previous", F.lit(True))
    start, end = F.expr(_time("window.`from`")), F.expr(_time("window.`to`"))
    thin = f"""filter(overview.watchReview, w -> {said("coalesce(w.w, IF(w.note IS NOT NULL, w.t, NULL))")} = '' OR {said("IF(w.w IS NOT NULL, w.t, w.note)")} = '')"""
    empty = [f"IF({said(c)} = '', 1, 0)" for c in ("weekday", "stamp", "headline")] + ["IF(coalesce(cards, 0) <= 0, 1, 0)"] + [f"IF(coalesce(size(overview.{c}), 0) <= 0, 1, 0)" for c in ("watch", "pulse", "snap")]
    rows = d.join(old, "day", "left").select(
        "key", "n_cards", _n("overview.watchReview").alias("n_verdicts"), _any("overview.watchReview", f"w -> w.verdict = '{config['undecided']}'").alias("n_undecided"),
        _any("overview.watchReview", f"w -> NOT coalesce(array_contains({_quoted(config['verdicts'])}, w.verdict), false)").alias("n_bad_verdicts"), F.coalesce("has_previous", F.lit(False)).alias("has_previous"),
        _n("overview.snap").alias("n_snap"), _n("overview.takeaways").alias("n_takeaways"), _n("overview.pulse").alias("n_pulse"), F.col("overview.thermo.level").alias("level"),
        F.expr(f"coalesce(transform(overview.pulse, p -> p.k) = {_quoted(config['pulse_keys'])}, true)").alias("sections_in_order"),
        _any("overview.pulse", f"p -> NOT coalesce(array_contains({_quoted(config['tones'])}, p.dir), false)").alias("n_bad_dirs"),
        "deep_median", "regular_median", "n_deep",
        F.expr(" + ".join(empty)).alias("n_empty_index_fields"), "n_threaded", _n("overview.pulse").alias("n_notes"),
        F.expr(f"coalesce(size(filter(notes, n -> n = 0)), 0) + coalesce(size({thin}), 0)").alias("n_notes_missing"), F.array_min("notes").alias("note_chars_low"), F.array_max("notes").alias("note_chars_high"),
        F.expr("size(filter(overview.takeaways, t -> t RLIKE '<b>|<strong>')) / nullif(size(overview.takeaways), 0)").alias("bold_share"), F.col("window.`from`").alias("from_ts"),
        F.expr("CAST(try_to_timestamp(window.`to`) + INTERVAL 8 HOURS AS DATE)").alias("to_date"), F.col("day").alias("date"), "prev_to_ts", start.alias("window_start"), end.alias("window_end"),
    )
    return framed(rows, "advisory_days")


# drafts, batches of episodes, episodes of a day


def drafts(docs: DataFrame, env_broken: bool = False) -> DataFrame:
    rows = docs.select("key", "doc.date", F.expr("IF(doc.items IS NULL, NULL, size(doc.items))").alias("n_items"), "doc.note", "doc.upstream_date", F.lit(env_broken).alias("env_broken"))
    return framed(rows, "drafts")


def manifests(docs: DataFrame) -> DataFrame:
    d = docs.select("key", "doc.*")
    missing = " + ".join(f"IF({c} IS NULL, 1, 0)" for c in ("generatedAt", "windowStartUtc", "windowEndUtc", "episodes"))
    rows = d.select(
        "key", F.expr(missing).alias("n_missing_keys"), F.coalesce(F.expr("schema_of_variant(episodes) LIKE 'ARRAY%'"), F.lit(False)).alias("episodes_is_array"),
        *(F.expr(_time(a)).alias(b) for a, b in (("windowStartUtc", "start_ts"), ("windowEndUtc", "end_ts"), ("generatedAt", "generated_ts"))),
    )
    return framed(rows, "manifests")


def fetched(docs: DataFrame, shows: DataFrame, repeats: DataFrame) -> DataFrame:
    """One row an episode of a manifest; ``shows`` has ``show``, ``repeats`` has ``file, tokens, first`` of repeated blocks of transcripts."""
    d = docs.where("schema_of_variant(doc.episodes) LIKE 'ARRAY%'").select(
        "key", F.expr(_time("doc.windowStartUtc")).alias("start_ts"), F.expr(_time("doc.windowEndUtc")).alias("end_ts"),
        F.explode(F.expr("CAST(doc.episodes AS array<struct<showKey string, title string, releaseDate string, durationMs bigint, status string, completeness double, file string, appleUrl string>>)")).alias("e"),
    )
    same = Window.partitionBy("key", "e.showKey", "e.releaseDate")
    rows = d.select(
        "key", "start_ts", "end_ts", F.expr(_time("e.releaseDate")).alias("release_ts"), F.coalesce("e.title", F.lit("")).alias("title"), F.coalesce("e.durationMs", F.lit(0)).alias("duration_ms"),
        F.col("e.showKey").alias("show"), "e.status", "e.completeness", F.count("*").over(same).alias("n_same"), F.col("e.file").alias("file"),
        F.nullif(F.regexp_extract("e.file", r"-(\d+)\.md$", 1), F.lit("")).alias("file_id"), F.nullif(F.regexp_extract("e.appleUrl", r"[?&]i=(\d+)", 1), F.lit("")).alias("url_id"),
    )
    worst = repeats.groupBy("file").agg(F.max_by("tokens", F.struct((F.col("first") >= CONFIG["repeat_first"]), "tokens")).alias("repeat_tokens"), F.max_by("first", F.struct((F.col("first") >= CONFIG["repeat_first"]), "tokens")).alias("repeat_first"))
    known = shows.select("show").distinct().withColumn("show_known", F.lit(True))
    rows = rows.join(known, "show", "left").join(worst, "file", "left").withColumn("show_known", F.coalesce("show_known", F.lit(False)))
    return framed(rows.withColumn("key", F.concat_ws(":", "key", "file")), "fetched")


def episodes(docs: DataFrame, config: dict = CONFIG) -> DataFrame:
    """One row an episode of a day; its minutes choose the tier of length and of paragraphs."""
    e = exploded(docs.select("key", "doc.*"), "episodes", "e")

    def bound(i: int) -> Column:
        out = None
        for under, *bounds in config["tiers"]:
            hit = F.lit(True) if under is None else F.col("e.minutes") < under
            out = F.when(hit, bounds[i]) if out is None else out.when(hit, bounds[i])
        return F.when(F.col("e.minutes").isNotNull(), out)

    rows = e.select(
        F.concat_ws(":", "key", "e.id").alias("key"), F.coalesce("e.chars", F.lit(0)).alias("chars"), F.expr("coalesce(aggregate(e.sections, 0, (a, s) -> a + coalesce(size(s.paragraphs), 0)), 0)").alias("paragraphs"),
        *(bound(i).alias(c) for i, c in enumerate(("low_chars", "high_chars", "low_paragraphs", "high_paragraphs"))), F.col("e.lowerBoundException").isNotNull().alias("exempt"), F.col("e.minutes").isNotNull().alias("has_minutes"),
        _n("e.topics").alias("n_topics"), _any("e.topics", f"t -> NOT array_contains({_quoted(config['topics'])}, t)").alias("n_bad_topics"), _n("e.takeaways").alias("n_takeaways"), _n("e.quotes").alias("n_quotes"),
        F.coalesce(F.ltrim(F.col("e.source")).startswith(config["placeholder"]), F.lit(False)).alias("placeholder"),
    )
    return framed(rows, "episodes")


def podcast_days(docs: DataFrame, ledger: DataFrame, transcripts: DataFrame) -> DataFrame:
    """One row a day; quotes are sought in the transcripts (``id, text``) of their own episodes, both in match form."""
    d = docs.select("key", "doc.*")
    quotes = exploded(d, "episodes", "e").select("key", "e.id", F.explode("e.quotes").alias("q"))
    spoken = transcripts.select("id", match_form(F.col("text")).alias("said"))
    looked = quotes.join(spoken, "id", "left").groupBy("key").agg(
        F.count("said").alias("n_compared"), F.count_if(F.col("said").isNotNull() & ~F.coalesce(F.contains("said", match_form(F.col("q.original"))), F.lit(False))).alias("n_quotes_missed")
    )
    new = ledger.select(F.explode("doc.items").alias("x")).groupBy(F.col("x.date").alias("date")).agg(F.count("*").alias("n_new_ledger"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = d.join(looked, "key", "left").join(new, "date", "left").select(
        "key", _n("episodes").alias("n_episodes"), _n("crossCut.points").alias("n_points"), zero("n_new_ledger"), (F.coalesce("n_compared", F.lit(0)) > 0).alias("has_transcripts"), zero("n_quotes_missed")
    )
    return framed(rows, "podcast_days")


def ledger(docs: DataFrame) -> DataFrame:
    x = exploded(docs.select("key", "doc.*"), "items", "x")
    rows = x.select(
        F.concat_ws(":", "key", "x.id").alias("key"), "x.status", F.col("x.due").try_cast("date").alias("due"), F.col("today").try_cast("date").alias("today"), "grace_days",
        F.col("x.judge.type").alias("judge_type"), F.col("x.judge.at").isNotNull().alias("judged"),
    )
    return framed(rows, "ledger")


# repository


def files(docs: DataFrame, word: str = "pull_request_target") -> DataFrame:
    """Lines of a workflow that name the trigger outside of comments."""
    hits = F.expr(f"size(filter(split(coalesce(doc.text, ''), '\\n'), x -> contains(split(x, '#')[0], '{word}')))")
    return framed(docs.select(F.concat_ws(":", "key", "doc.path").alias("key"), hits.alias("n_token_lines")), "files")


def briefs(docs: DataFrame) -> DataFrame:
    """Estimated tokens of a brief: a character beyond U+2E80 is one, of the others four make one."""
    wide = F.length(F.regexp_replace(F.coalesce("doc.text", F.lit("")), "[^\\x{2E81}-\\x{10FFFF}]", ""))
    tokens = wide + F.ceil((F.length(F.coalesce("doc.text", F.lit(""))) - wide) / 4)
    return framed(docs.select(F.concat_ws(":", "key", "doc.path").alias("key"), tokens.alias("est_tokens"), "doc.budget", "doc.budget_source"), "briefs")


# research


def _blob(tables: bool) -> Column:
    cells = "flatten(filter(transform(doc.tables, t -> transform(t.`rows`, r -> array_join(r, ' '))), x -> x IS NOT NULL))"
    parts = [F.coalesce("doc.page_one", F.lit("")), F.array_join(F.coalesce(F.col("doc.body"), F.array().cast("array<string>")), "\n")]
    return F.concat_ws("\n", *parts, *([F.coalesce(F.array_join(F.expr(cells), "\n"), F.lit(""))] if tables else []))


def _digested(digest: DataFrame) -> DataFrame:
    return digest.select(F.explode("doc.reports").alias("r")).select("r.*")


def reports(docs: DataFrame, digest: DataFrame, files: DataFrame, vocabulary: list[str] = ()) -> DataFrame:
    """One row an extracted report, with what the digest says of it; ``files`` has ``name, bytes`` of the pictures that are there."""
    text = _blob(False)
    first = F.trim(F.regexp_replace(F.coalesce("doc.page_one", F.lit("")), r"\s+", " "))
    tally = F.expr("array_sort(map_values(doc.broker_tally), (a, b) -> CAST(b - a AS INT))")
    d = docs.select(
        "key", "doc.slug", sum(F.regexp_count(text, F.lit(p)) for k, p in PRIVATE.items() if k not in ("phone", "ipv4")).alias("n_private"), "doc.broker", F.col("doc.date").try_cast("date").alias("date"),
        F.coalesce(F.get(tally, F.lit(0)), F.lit(0)).alias("top_hits"), F.coalesce(F.get(tally, F.lit(1)), F.lit(0)).alias("second_hits"), F.col("doc.strip_report.removed_pct").alias("removed_pct"),
        F.nullif("doc.claimed_pages", F.lit(0)).alias("claimed_pages"), "doc.pages", F.length(first).alias("page_one_chars"), "doc.sha256",
    )
    for c, by in (("n_same_slug", "slug"), ("n_same_sha", "sha256")):
        d = d.withColumn(c, F.when(F.col(by).isNotNull(), F.count("*").over(Window.partitionBy(by))).otherwise(1))
    r = _digested(digest)
    marks = r"[\\s，。、；：,.;:!?！？]"  # one backslash is the parser's
    known = f"NOT array_contains({_quoted(list(vocabulary))}, trim(t))" if vocabulary else "false"
    pictures = r.select("slug", F.explode(F.expr("filter(flatten(filter(transform(charts, c -> array(c.png, c.svg)), x -> x IS NOT NULL)), x -> x IS NOT NULL AND x <> '')")).alias("name"))
    lost = pictures.join(files.select("name", "bytes"), "name", "left").groupBy("slug").agg(F.count_if(F.coalesce("bytes", F.lit(0)) == 0).alias("n_missing_files"))
    told = r.select(
        "slug", "summary_chars", F.get("tier_band", F.lit(0)).alias("low_chars"), F.get("tier_band", F.lit(1)).alias("high_chars"), _n("tags").alias("n_tags"), F.expr("array_max(transform(tags, t -> length(trim(t))))").alias("longest_tag"),
        _any("tags", f"t -> coalesce(trim(t), '') = '' OR trim(t) RLIKE '{marks}'").alias("n_bad_tags"), _any("tags", f"t -> {known}").alias("n_unknown_tags"), _n("charts").alias("n_charts"), _any("charts", "c -> c.render_error IS NOT NULL").alias("n_render_errors"),
    )
    rows = d.join(told.join(lost, "slug", "left").withColumn("n_missing_files", F.coalesce("n_missing_files", F.lit(0))), "slug", "left")
    return framed(rows, "reports")


def stances(docs: DataFrame, digest: DataFrame, themes: list[str]) -> DataFrame:
    """One row a stance: whether its quote stands in its report, both in match form."""
    s = _digested(digest).select("slug", F.posexplode("stances").alias("i", "s"))
    text = docs.groupBy("doc.slug").agg(F.min(match_form(_blob(False))).alias("text"))
    quote = match_form(F.coalesce("s.quote", F.lit("")))
    rows = s.join(text, "slug", "left").select(
        F.concat_ws(":", "slug", F.col("i").cast("string")).alias("key"), F.col("text").isNotNull().alias("has_report"), ((quote != "") & F.contains("text", quote)).alias("found"),
        F.coalesce(F.col("s.theme").isin(themes), F.lit(False)).alias("theme_known"),
    )
    return framed(rows, "stances")


def report_charts(docs: DataFrame, digest: DataFrame) -> DataFrame:
    """One row a chart of a report; a chart without grounding is not grounded, tables count as text."""
    c = _digested(digest).select("slug", F.posexplode("charts").alias("i", "c"))
    text = docs.groupBy("doc.slug").agg(F.min(match_form(_blob(True))).alias("text"))
    empty = "CASE c.kind " + " ".join(f"WHEN '{k}' THEN " + " + ".join(f"IF(coalesce(size(c.{f}), 0) <= 0, 1, 0)" for f in fields if f != "series") for k, fields in KIND_FIELDS.items() if fields != ["series"]) + " ELSE 1 END"
    joined = c.join(text, "slug", "left").withColumn("said", F.coalesce("text", F.lit("")))
    found = F.aggregate(F.coalesce("c.grounding", F.array().cast("array<string>")), F.lit(0), lambda a, g: a + F.when(F.contains(F.col("said"), match_form(g)), 0).otherwise(1))
    uneven = "filter(c.groups, g -> coalesce(size(g.`values`), 0) <> coalesce(size(c.cats), 0))"
    rows = joined.select(
        F.concat_ws(":", "slug", F.col("i").cast("string")).alias("key"), F.when(F.coalesce(F.size("c.grounding"), F.lit(0)) <= 0, 1).otherwise(found).alias("n_ungrounded"), F.expr(empty).alias("n_empty_fields"),
        F.expr(f"IF(size({uneven}) > 0, size(get({uneven}, 0).`values`), coalesce(size(c.cats), 0))").alias("n_values"), F.expr("coalesce(size(c.cats), 0)").alias("n_cats"),
    )
    return framed(rows, "report_charts")


def research_days(docs: DataFrame, digest: DataFrame) -> DataFrame:
    """One row a batch: how many engines extracted it, and whether any tag connects two of its reports."""
    engines = docs.groupBy(F.col("doc.batch").alias("key")).agg(F.count_distinct("doc.engine").alias("n_engines"))
    of = docs.select(F.col("doc.batch").alias("key"), "doc.slug").distinct()
    tags = _digested(digest).select("slug", F.explode("tags").alias("tag")).join(of, "slug").groupBy("key", "tag").agg(F.count("*").alias("n"))
    tags = tags.groupBy("key").agg(F.count("*").alias("n_tags"), F.count_if(F.col("n") > 1).alias("n_repeated_tags"))
    return framed(engines.join(tags, "key", "left"), "research_days")


# sentinels


def indexes(docs: DataFrame) -> DataFrame:
    """The newest day counts from its midnight in Taipei, eight hours before that of UTC."""
    latest = F.expr("array_max(transform(doc.days, d -> d.date))").try_cast("date").cast("timestamp") - F.expr("INTERVAL 8 HOURS")
    rows = docs.select(
        "key", F.expr(_time("doc.now")).alias("now"), latest.alias("latest"), F.expr(_time("doc.updated")).alias("updated"), F.coalesce("doc.cadence_hours", F.lit(24.0)).alias("cadence_h"),
        _n("doc.days").alias("day_count"), F.col("doc.prev.day_count").alias("prev_day_count"),
    )
    return framed(rows, "indexes")


def heartbeats(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        "key", F.expr(_time("doc.now")).alias("now"), F.expr(_time("doc.heartbeat.at")).alias("at"), F.col("doc.heartbeat.`exit`").alias("exit_code"), F.expr("IF(doc.drift IS NULL, NULL, size(doc.drift))").alias("n_drift"),
        F.expr("size(map_filter(doc.binaries, (k, v) -> NOT v))").alias("n_missing_binaries"), F.col("doc.binaries").isNotNull().alias("binaries_known"),
    )
    return framed(rows, "heartbeats")
