"""Queries of the whole check catalogue over nested documents.

The stand-in documents are JSON texts made from the tables; ``larkspur.operators.frames`` reads them back by their schemas and makes
the frames. The SQL never sees the documents: it computes each level from the tables, so a field that is read wrongly shows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.scalars import LISTING, PRIVATE
from larkspur.operators import checks, frames, rules
from larkspur.plans.inputs import table
from larkspur.plans.text import _form_sql

QUERIES, ORACLES = {}, {}
C = checks.CONFIG


def query(name: str, frame: str, sql: str, levels: dict[str, str]):
    """Registers all rules of ``frame``; ``sql`` ends with a table ``x`` that has ``key``, ``levels`` gives each check's level over it."""
    ids = sorted(r.id for r in checks.REGISTRY.of(frame))
    assert ids == sorted(levels), (ids, sorted(levels))

    def add(f: Callable[..., DataFrame]):
        QUERIES[name] = lambda spark, d: rules.evaluate(f(spark, d), checks.REGISTRY.of(frame), C)
        ORACLES[name] = f"WITH {sql}\n" + "\nUNION ALL ".join(f"SELECT key, '{k}' AS check_id, CASE {v} ELSE 'PASS' END AS level FROM x" for k, v in levels.items())
        return f

    return add


def fails(condition: str, warn: str = "", skip: str = "") -> str:
    return (f"WHEN {skip} THEN 'SKIPPED' " if skip else "") + f"WHEN {condition} THEN 'FAIL'" + (f" WHEN {warn} THEN 'WARN'" if warn else "")


def documents(rows: DataFrame, key: str, fields: str, kind: str) -> DataFrame:
    """``rows`` as JSON texts with a key, read back by the schema of their kind."""
    return frames.parsed(rows.select(F.expr(key).alias("key"), F.expr(f"to_json(named_struct({fields}))").alias("json")), kind)


def words(values: list[str], at: str) -> str:
    return "element_at(array(" + ", ".join(f"'{v}'" for v in values) + f"), CAST({at} AS INT) + 1)"


def listed(values: list[str], at: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[CAST({at} AS INT) + 1]"


# charts: a document for each order date, a chart for each priority of the day

SLOTS, TRACKS, THEMES, PATHS = C["slots"], C["tracks"], C["themes"], C["data_paths"]
KINDS = ["timeseries", "scatter", "heatmap", "waterfall", "grouped_bar"]


def chart_documents(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    g = o.groupBy(F.to_date("o_orderdate").alias("day"), (F.left("o_orderpriority", F.lit(1)).cast("int") - 1).alias("p")).agg(F.min("o_orderkey").alias("k"))
    g = g.withColumn("q", F.expr("k DIV 5")).withColumn("kind", F.expr(words(KINDS, "k % 5"))).withColumn("wd", F.weekday("day")).withColumn("bare", F.expr("q % 6 = 0")).withColumn("dom", F.dayofmonth("day"))
    track = f"IF(wd >= 5, {words(TRACKS, 'k % 5')} || IF(k % 6 = 0, '', '（weekly）'), IF(k % 7 = 0, {words(TRACKS, '(wd + 1) % 5')}, {words(TRACKS, 'least(wd, 4)')}))"
    last = "IF(k % 8 = 0, trunc(day - INTERVAL 40 DAYS, 'month'), date_sub(day, CAST(k % 7 AS INT)))"
    dates = f"transform(sequence(0, CAST(14 + k % 12 AS INT)), j -> CAST(date_sub({last}, CAST(14 + k % 12 - j AS INT)) AS STRING))"
    axis = "concat(array('a', 'b', 'c'), IF(kind = 'waterfall', array('total'), CAST(array() AS array<string>)))"
    line = "IF(k % 9 = 0 AND q % 2 = 0, named_struct('data', array(named_struct('yAxis', 0))), NULL)"
    none = lambda kind: f"CAST(array() AS array<{kind}>)"
    chart = f"""named_struct('slug', IF(p = 0 AND k % 2 = 0, 'cpi-release', 'c' || p), 'slot', IF(p < 4, {words(SLOTS, 'p')}, '{SLOTS[4]}｜' || {track}), 'theme', IF(k % 11 = 0, 'odd', {words(THEMES, '(p + IF(k % 3 = 0, 1, 0)) % 4')}),
        'kind', kind, 'title', repeat('t', CAST(6 + k % 40 AS INT)), 'reading', repeat('r', CAST(30 + k % 400 AS INT)) || IF(k % 9 = 0, '', '\\n\\nx'), 'takeaway', repeat('a', CAST(5 + k % 130 AS INT)),
        'so_what', repeat('s', CAST(8 + k % 110 AS INT)), 'watch', array_repeat('w', CAST(k % 5 AS INT)), 'tags', array_repeat('g', CAST(1 + k % 6 AS INT)), 'source', repeat('中', CAST(k % 40 AS INT)), 'note', repeat('n', CAST(k % 150 AS INT)),
        'footer_lines', IF(k % 10 = 0, 3, NULL), 'zero_line', k % 9 = 0, 'markers', IF(k % 4 = 0, array(named_struct('date', CAST(day AS STRING))), NULL),
        'series', IF(kind = 'timeseries' AND NOT bare, transform(sequence(0, CAST(k % 9 AS INT)), i -> named_struct('name', 's' || i, 'dates', {dates}, 'values', transform(sequence(1, CAST(15 + k % 12 - IF(k % 13 = 0, 1, 0) AS INT)), v -> v * 1.5D))), NULL),
        'series_spec', array(named_struct('id', 'H10', 'name', 's0')), 'cats', IF(kind IN ('waterfall', 'grouped_bar') AND NOT bare, array('a', 'b', 'c'), {none('string')}), 'vals', IF(kind = 'waterfall' AND NOT bare, array(3D, -1D, 2.5D), {none('double')}),
        'groups', IF(kind = 'grouped_bar' AND NOT bare, array(named_struct('name', 'x', 'values', array(1D, 2D, 3D))), NULL), 'pts', IF(kind = 'scatter' AND NOT bare, array(array(1D, 2D)), NULL), 'matrix', IF(kind = 'heatmap' AND NOT bare, array(array(1D)), NULL),
        'provenance', IF(p = 2, named_struct('inspired_by', named_struct('url', IF(q % 7 = 0, '', 'u'), 'published', CAST(date_sub(day, CAST(q % 12 - 2 AS INT)) AS STRING))), NULL),
        'option', IF(q % 9 = 0, NULL, named_struct('color', IF(q % 4 = 1, array('x'), array('lead', 'contrast', 'overflow', 'background')), 'xAxis', named_struct('data', IF(q % 10 = 3, array('z'), {axis})),
            'series', CASE kind WHEN 'waterfall' THEN array(named_struct('type', 'bar', 'stackStrategy', IF(q % 3 = 0, NULL, 'all'), 'barWidth', CAST(NULL AS STRING), 'data', IF(q % 5 = 2, array(9D, 2D, 2D, 0D), array(0D, 2D, 2D, 0D)), 'markLine', {line}))
                WHEN 'grouped_bar' THEN transform(array(1, 2), i -> named_struct('type', 'bar', 'stackStrategy', CAST(NULL AS STRING), 'barWidth', IF(q % 3 = 1, '62%', NULL), 'data', array(1D, 2D, 3D), 'markLine', {line}))
                ELSE array(named_struct('type', 'line', 'stackStrategy', CAST(NULL AS STRING), 'barWidth', CAST(NULL AS STRING), 'data', CAST(NULL AS array<double>), 'markLine', {line})) END)))"""
    png = "named_struct('key', IF(p = 0 AND k % 2 = 0, 'cpi-release', 'c' || p), 'value', IF(q % 8 = 0, NULL, CAST(15000 + k % 20 * 1000 AS BIGINT)))"
    days = g.groupBy("day", "wd", "dom").agg(F.expr(f"transform(array_sort(collect_list(struct(p, {chart} AS c))), x -> x.c)").alias("charts"), F.expr(f"map_from_entries(collect_list({png}))").alias("png"))
    fields = f"""'date', CAST(day AS STRING), 'headline', repeat('h', dom + 4), 'standfirst', repeat('f', 8 + 3 * dom), 'now', CAST(day AS STRING) || 'T04:00:00+08:00',
        'about', named_struct('data_path', {words(PATHS, 'dayofyear(day) DIV 4 % 3')}, 'macro_release', IF(dom <= 12, array(named_struct('kind', 'CPI', 'fresh', dom % 3 = 0)), NULL)), 'charts', charts, 'png', png,
        'prefetch', IF(dom % 9 = 0, NULL, named_struct('finished', date_format(CAST(day AS timestamp) - make_interval(0, 0, 0, 0, dom * 2) + INTERVAL 210 MINUTES, "yyyy-MM-dd'T'HH:mm:ss") || 'Z', 'failed', IF(dom % 5 = 0, map('H10', 'x'), map('other', 'x')))),
        'blob', IF(month(day) = 1 AND dom <= 10, repeat('x', 1024 * CASE dom % 5 WHEN 0 THEN 400 WHEN 1 THEN 900 ELSE 1 END), '')"""
    return documents(days, "CAST(day AS STRING)", fields, "chart")


_G = f"""g0 AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(left(o_orderpriority, 1) AS INT) - 1 AS p, min(o_orderkey) AS k FROM orders GROUP BY 1, 2),
g AS (SELECT *, k // 5 AS q, {listed(KINDS, 'k % 5')} AS kind, isodow(day) - 1 AS wd, k // 5 % 6 = 0 AS bare, dayofmonth(day) AS dom, CASE WHEN p = 0 AND k % 2 = 0 THEN 'cpi-release' ELSE 'c' || p END AS slug,
CASE WHEN k % 11 = 0 THEN 'odd' ELSE {listed(THEMES, '(p + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END) % 4')} END AS theme FROM g0)"""
_LINES = "CASE WHEN k % 10 = 0 THEN 3 ELSE ceil(2 * (k % 40) / 60) + ceil((k % 150) / 60) END"

query(
    "rules_nested_charts", "charts",
    f"""{_G}, y AS (SELECT *, (q % 4 = 1)::INT + CASE WHEN kind NOT IN ('waterfall', 'grouped_bar') THEN 0 ELSE
 (CASE WHEN q % 10 = 3 THEN 1 WHEN kind = 'waterfall' THEN 4 ELSE 3 END <> CASE WHEN bare THEN 0 ELSE 3 END + (kind = 'waterfall')::INT)::INT END
 + (kind = 'waterfall' AND q % 3 = 0)::INT + (kind = 'waterfall' AND NOT bare AND q % 5 = 2)::INT + (kind = 'grouped_bar' AND q % 3 = 1)::INT + (k % 9 = 0 AND kind <> 'heatmap' AND q % 2 <> 0)::INT
 + CASE WHEN bare AND kind = 'waterfall' THEN 1 WHEN bare AND kind = 'grouped_bar' THEN 2 ELSE 0 END AS bad FROM g), x AS (SELECT *, strftime(day, '%Y-%m-%d') || ':' || slug AS key FROM y)""",
    {
        "chart.kind_data_present": fails("bare"),
        "chart.lengths": fails(
            f"6 + k % 40 NOT BETWEEN {C['title_low']} AND {C['title_high']} OR 30 + k % 400 + CASE WHEN k % 9 = 0 THEN 0 ELSE 3 END NOT BETWEEN {C['reading_low']} AND {C['reading_high']} OR 5 + k % 130 NOT BETWEEN {C['takeaway_low']} AND {C['takeaway_high']}"
            f" OR 8 + k % 110 NOT BETWEEN {C['so_what_low']} AND {C['so_what_high']} OR k % 9 = 0 OR k % 5 NOT BETWEEN 1 AND 3 OR k % 6 = 5 OR dom + 4 NOT BETWEEN 5 AND 30 OR 8 + 3 * dom NOT BETWEEN 10 AND 100",
            skip="kind = 'heatmap' AND day < DATE '1994-01-01' AND slug = 'c1'",
        ),
        "chart.series_cap": fails("NOT bare AND kind = 'timeseries' AND 1 + k % 9 > 8", "NOT bare AND kind = 'timeseries' AND 1 + k % 9 = 8"),
        "chart.footer_lines": fails(f"{_LINES} > 2", f"{_LINES} = 2"),
        "chart.option_matches_spec": fails("q % 9 = 0 OR bad > 0"),
        "chart.provenance": fails("q % 7 = 0 OR q % 12 - 2 NOT BETWEEN 0 AND 7", skip="p <> 2"),
        "chart.png_present": fails("q % 8 = 0 OR 15000 + k % 20 * 1000 < 20000"),
    },
)(lambda spark, d: frames.charts(chart_documents(spark, d), exempt=_exempt(spark, d)))


def _exempt(spark, d) -> DataFrame:
    """The heat maps among the second charts of days before 1994 are known exceptions."""
    o = table(spark, d, "orders").where("o_orderdate < '1994-01-01'")
    g = o.groupBy(F.to_date("o_orderdate").alias("date"), (F.left("o_orderpriority", F.lit(1)).cast("int") - 1).alias("p")).agg(F.min("o_orderkey").alias("k"))
    return g.where("p = 1 AND k % 5 = 2").select("date", F.lit("c1").alias("slug"))


query(
    "rules_nested_series", "chart_series",
    f"""{_G}, s AS (SELECT *, unnest(range(0, k % 9 + 1)) AS i, CASE WHEN k % 8 = 0 THEN CAST(date_trunc('month', day - 40) AS DATE) ELSE day - CAST(k % 7 AS INT) END AS last FROM g WHERE kind = 'timeseries' AND NOT bare),
x AS (SELECT *, strftime(day, '%Y-%m-%d') || ':' || slug || ':' || i AS key, day - last AS age, CASE WHEN dayofmonth(last) = 1 THEN 'm' WHEN i = 0 AND day >= DATE '1993-01-01' THEN 'w' ELSE 'd' END AS c FROM s)""",
    {
        "chart.series_freshness": fails("(c = 'd' AND age >= 5) OR (c = 'm' AND age // 30 >= 3) OR (c = 'w' AND age // 7 >= 3)", "(c = 'd' AND age >= 2) OR (c = 'm' AND age // 30 >= 2) OR (c = 'w' AND age // 7 >= 2)"),
        "chart.series_wellformed": fails("k % 13 = 0 OR 15 + k % 12 < 20"),
    },
)(lambda spark, d: frames.chart_series(chart_documents(spark, d)))

query(
    "rules_nested_chart_days", "chart_days",
    f"""{_G}, h AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY p) - 1 AS i FROM g),
t AS (SELECT day, wd, dom, count(*) AS n, bool_and(p = i) AS ordered, count(*) FILTER (WHERE theme <> 'odd') - count(DISTINCT theme) FILTER (WHERE theme <> 'odd') AS dup, count(*) FILTER (WHERE theme = 'odd') AS odd,
count(*) FILTER (WHERE kind <> 'timeseries') AS shaped, max(k) FILTER (WHERE p = 4) AS tk, bool_or(kind = 'timeseries' AND NOT bare) AS lined, max(slug) FILTER (WHERE p = 0) AS slug, max(theme) FILTER (WHERE p = 0) AS theme,
{listed(PATHS, 'dayofyear(day) // 4 % 3')} AS path FROM h GROUP BY 1, 2, 3),
u AS (SELECT *, CASE WHEN wd >= 5 THEN {listed(TRACKS, 'tk % 5')} WHEN tk % 7 = 0 THEN {listed(TRACKS, '(wd + 1) % 5')} WHEN tk IS NOT NULL THEN {listed(TRACKS, 'least(wd, 4)')} END AS track, row_number() OVER (ORDER BY day) AS place FROM t),
v AS (SELECT *, max(place) FILTER (WHERE path <> 'manual') OVER (ORDER BY day) AS other FROM u),
x AS (SELECT strftime(v.day, '%Y-%m-%d') AS key, v.*, CASE WHEN path = 'manual' THEN place - coalesce(other, 0) ELSE 0 END AS streak, b.track AS before FROM v LEFT JOIN (SELECT day + 1 AS day, track FROM u) b USING (day))""",
    {
        "chart.structure": fails("n <> 5 OR NOT ordered"),
        "chart.theme_unique": fails("dup > 0 OR odd > 0"),
        "chart.diversity": fails("shaped < 2", skip="day < DATE '1993-01-01'"),
        "chart.track_of_the_day": fails("track IS NULL OR (wd < 5 AND tk % 7 = 0) OR (wd >= 5 AND (tk % 6 = 0 OR (wd = 6 AND coalesce(track = before, false))))"),
        "chart.size": fails("month(day) = 1 AND dom <= 10 AND dom % 5 = 1", "month(day) = 1 AND dom <= 10 AND dom % 5 = 0"),
        "chart.data_path_named": fails("false", "path = 'manual'"),
        "chart.prefetch_fresh": fails("dom % 9 = 0 OR dom * 2 > 30 OR (dom % 5 = 0 AND lined)", skip="path <> 'primary'"),
        "chart.data_path_streak": fails("streak >= 3", "streak > 0"),
        "chart.release_day": fails("dom % 3 = 0 AND (slug <> 'cpi-release' OR theme <> 'rates')", skip="dom > 12"),
    },
)(lambda spark, d: frames.chart_days(chart_documents(spark, d)))


# advisory: a document for each day of events, a card for each event

TONES, TAGS, KEYS = C["tones"], C["tags"], C["pulse_keys"]


#: Fixed value: about so many cards are in a part of a document.
PART = 500


def advisory_documents(spark, d) -> DataFrame:
    """A document for each day, in parts: the events of a day are dealt by hash, and what is shuffled are events, not cards or documents."""
    e = table(spark, d, "events").select("event_id", "ts", "event_type", F.to_date("ts").alias("day")).withColumn("dom", F.dayofmonth("day"))
    iso = """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")"""
    card = f"""named_struct('title', 'e' || event_id, 'url', CASE event_id % 9 WHEN 0 THEN 'https://a.com/markets/' WHEN 1 THEN 'https://a.com' ELSE 'https://a.com/x/' || (event_id % 500) END, 'src', IF(event_id % 29 = 0, ' ', 'a'),
        'ts', CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN {iso} ELSE {iso} || '+08:00' END, 'date', IF(event_id % 37 = 0, '2020/01/01', date_format(ts, 'yyyy/MM/dd')), 'tone', IF(event_id % 10 = 0, 'loud', {words(TONES, 'event_id % 3')}),
        'tagcls', {words(TAGS, 'event_id % 3')}, 'body', IF(event_id % 50 = 0, parse_json('["x"]'), parse_json('"' || repeat('b', CAST(event_id % 400 AS INT)) || '"')), 'bullets', IF(event_id % 3 = 0, array('c', 'dd'), NULL),
        'base', event_id % 100 = 0, 'deep', event_id % 30 = 0, 'thread', IF(event_id % 25 = 0, 't', NULL))"""
    label = "IF(event_type = 'error' AND dom % 5 = 0, 'stray', event_type)"
    sizes = e.groupBy(F.col("day").alias("of")).agg(F.count("*").alias("n"))
    dealt = e.join(F.broadcast(sizes), F.col("day").eqNullSafe(F.col("of"))).withColumn("part", F.pmod(F.xxhash64("event_id", "ts"), F.ceil(F.col("n") / PART))).repartition("day", "part")
    g = dealt.groupBy("day", "dom", "n", "part").agg(F.expr(f"collect_list(named_struct('label', {label}, 'card', {card}))").alias("found"))
    days = g.withColumn("groups", F.expr("transform(array_sort(array_distinct(found.label)), l -> named_struct('label', l, 'cards', transform(filter(found, x -> x.label <=> l), x -> x.card)))"))
    pulse = ", ".join(f"named_struct('k', IF(dom % 8 = 0, '{KEYS[5 - i]}', '{k}'), 'dir', IF(dom % 14 = {i}, 'x', 'up'), 'note', repeat('n', IF(dom % 16 = {i}, 0, dom + 10)))" for i, k in enumerate(KEYS))
    fields = f"""'date', CAST(day AS STRING), 'weekday', IF(dom % 12 = 0, ' ', 'day'), 'stamp', 's', 'headline', 'h', 'cards', n, 'now', CAST(day AS STRING) || 'T23:00:00+08:00',
        'window', named_struct('from', CAST(date_sub(day, 1) AS STRING) || IF(dom % 15 = 0, 'T07:00:01+08:00', 'T07:00:00+08:00'), 'to', CAST(day AS STRING) || IF(dom % 6 = 0, 'T06:30:00+08:00', 'T14:00:00+08:00')),
        'sections', array(named_struct('name', 'one', 'groups', slice(groups, 1, 2)), named_struct('name', 'two', 'groups', slice(groups, 3, 9))),
        'overview', named_struct('snap', array_repeat(named_struct('k', 'a'), IF(dom % 7 = 0, 5, 6)), 'takeaways', transform(sequence(1, 5), i -> IF(i <= dom % 6, '<b>x</b> y', 'z')), 'pulse', array({pulse}), 'thermo', named_struct('level', CAST(dom * 4 AS STRING), 'note', 'n'),
            'watch', array(named_struct('w', 'x')), 'watchReview', IF(dom % 4 = 0, array(named_struct('d', 'a', 'w', 'x', 't', 'y', 'verdict', 'open')), array(named_struct('d', 'a', 'w', 'x', 't', IF(dom % 10 = 0, '', 'y'), 'verdict', IF(dom % 11 = 0, 'bad', 'hit')), named_struct('d', 'b', 'w', 'x', 't', 'y', 'verdict', 'open'))))"""
    return documents(days, "CAST(day AS STRING)", fields, "advisory")


def plan_documents(spark, d) -> DataFrame:
    """One plan: a group for each kind of event and one that never comes; owners, batches and sources from the names of nations."""
    kinds = table(spark, d, "events").select(F.col("event_type").alias("name")).distinct().unionByName(spark.sql("SELECT 'missing' AS name"))
    n = F.length("name")
    g = kinds.select(
        "name", F.struct((n * 10).alias("weekday"), (n * 12).alias("weekend")).alias("floor"), F.struct((n + 1).alias("weekday"), (n + 2).alias("weekend")).alias("quota"), (n % 2 == 0).alias("base"),
        F.struct(F.create_map(F.lit("a"), n, F.lit("b"), F.lit(1)).alias("weekday"), F.create_map(F.lit("a"), n + n % 2 + 1, F.lit("b"), F.lit(1)).alias("weekend")).alias("owners"),
    ).agg(F.collect_list(F.struct("name", "floor", "quota", "base", "owners")).alias("groups"))
    c = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("k"))
    sources = F.when(F.col("k") % 10 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("s"), F.col("k") - F.when(F.col("k") % 7 == 3, 1).otherwise(0))))
    batch = lambda i: F.expr(f"collect_list(name) FILTER (WHERE k % 2 = {i} AND k % 9 <> 8 OR k % 11 = 5)")
    r = c.agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct(sources.alias("sources"))))).alias("roster"), F.array(batch(0), batch(1)).alias("batches"))
    return documents(g.join(F.broadcast(r)), "'plan'", "'groups', groups, 'roster', roster, 'batches', batches", "plan")


_E = """e AS (SELECT *, CAST(ts AS DATE) AS day, dayofmonth(ts) AS dom, CASE WHEN event_type = 'error' AND dayofmonth(ts) % 5 = 0 THEN 'stray' ELSE event_type END AS label,
CASE event_id % 9 WHEN 0 THEN 'https://a.com/markets/' WHEN 1 THEN 'https://a.com' ELSE 'https://a.com/x/' || (event_id % 500) END AS url FROM events)"""
_TS = "event_id % 41 <> 0 AND event_id % 43 <> 0"

query(
    "rules_nested_cards", "cards",
    f"""{_E}, b AS (SELECT DISTINCT day + 1 AS day, url, true AS again FROM e), x AS (SELECT strftime(e.day, '%Y-%m-%d') || ':' || label || ':e' || event_id AS key, e.*, again, e.day > (SELECT min(day) FROM e) AS later FROM e LEFT JOIN b USING (day, url))""",
    {
        "advisory.ts_wellformed": fails(f"NOT ({_TS})"),
        # a time without an offset is read in the zone of the session, UTC
        "advisory.ts_in_window": fails("date_trunc('second', ts) + INTERVAL 8 HOUR * (event_id % 43 = 0)::INT > day + CASE WHEN dom % 6 = 0 THEN INTERVAL 390 MINUTE ELSE INTERVAL 840 MINUTE END", skip="event_id % 41 = 0"),
        "advisory.date_ts_consistent": fails("event_id % 37 = 0 OR (event_id % 43 = 0 AND hour(ts) >= 16)", skip="event_id % 41 = 0"),
        "advisory.cross_version_dedup": fails("coalesce(again, false) AND event_id % 9 <> 1", skip="NOT later"),
        "advisory.url_is_article": fails("event_id % 9 < 2"),
        "advisory.card_vocab": fails("event_id % 10 = 0 OR event_id % 29 = 0"),
    },
)(lambda spark, d: frames.cards(advisory_documents(spark, d), exempt=["https://a.com"]))

_PLAN = "p AS (SELECT name, len(name) AS n FROM (SELECT DISTINCT event_type AS name FROM events UNION ALL SELECT 'missing'))"

query(
    "rules_nested_groups", "groups",
    f"""{_E}, {_PLAN}, h AS (SELECT day, label, count(*) AS cards, count(*) FILTER (WHERE event_id % 100 = 0) AS base FROM e GROUP BY 1, 2), days AS (SELECT DISTINCT day FROM e), w AS (SELECT day, name AS label, n FROM days, p),
x AS (SELECT strftime(day, '%Y-%m-%d') || ':' || label AS key, n, cards, base, isodow(day - 1) >= 6 AS weekend FROM w FULL JOIN h USING (day, label))""",
    {
        "advisory.group_names": fails("n IS NULL OR cards IS NULL"),
        "advisory.group_floors": fails("n IS NOT NULL AND coalesce(cards, 0) < n * CASE WHEN weekend THEN 12 ELSE 10 END"),
        "advisory.base_cards": fails("n % 2 = 0 AND coalesce(base, 0) = 0"),
    },
)(lambda spark, d: frames.groups(advisory_documents(spark, d), plan_documents(spark, d)))

query(
    "rules_nested_dispatch", "dispatch",
    f"""{_PLAN}, m AS (SELECT 'plan:' || name || ':' || m AS key, CASE WHEN m = 'weekday' THEN 0 ELSE n % 2 + 1 + n + 1 - (n + 2) END AS off, 1 AS batches, 1 AS owners FROM p, (VALUES ('weekday'), ('weekend')) v(m)),
c AS (SELECT n_name AS name, n_nationkey AS k FROM nation), s AS (SELECT 's' || (k - CASE WHEN k % 7 = 3 THEN 1 ELSE 0 END) AS s FROM c WHERE k % 10 <> 0),
x AS (SELECT * FROM m UNION ALL SELECT 'plan:' || name, 0, CASE WHEN k % 11 = 5 THEN 2 WHEN k % 9 = 8 THEN 0 ELSE 1 END, CASE WHEN k % 10 = 0 THEN 0 ELSE 1 END FROM c UNION ALL SELECT 'plan:' || s, 0, 1, count(*) FROM s GROUP BY s)""",
    {"advisory.dispatch_wellformed": fails("off <> 0 OR batches <> 1 OR owners <> 1")},
)(lambda spark, d: frames.dispatch(plan_documents(spark, d)))

_CHARS = "CASE WHEN event_id % 50 = 0 THEN 0 ELSE event_id % 400 END + CASE WHEN event_id % 3 = 0 THEN 3 ELSE 0 END"

query(
    "rules_nested_advisory_days", "advisory_days",
    f"""{_E}, c AS (SELECT day, dom, event_id % 30 = 0 AS deep, {_CHARS} AS n, event_id % 25 = 0 AS thread FROM e),
t AS (SELECT day, dom, count(*) AS cards, list_sort(list(n) FILTER (WHERE deep)) AS dl, list_sort(list(n) FILTER (WHERE NOT deep)) AS rl, count(*) FILTER (WHERE thread) AS threaded FROM c GROUP BY 1, 2),
x AS (SELECT strftime(day, '%Y-%m-%d') AS key, *, coalesce(len(dl), 0) AS deep, dl[len(dl) // 2 + 1] AS dm, rl[len(rl) // 2 + 1] AS rm, day > (SELECT min(day) FROM t) AS later, lag(dom) OVER (ORDER BY day) AS pd FROM t)""",
    {
        "advisory.site_total": fails("cards < 40", "cards > 120"),
        "advisory.watch_review": fails("dom % 4 = 0 OR dom % 11 = 0", skip="NOT later"),
        "advisory.fixed_structure": fails("dom % 7 = 0 OR dom % 8 = 0 OR dom % 14 < 6 OR dom * 4 > 100"),
        "advisory.card_lengths": "WHEN dm < 300 OR rm < 60 OR deep NOT BETWEEN 3 AND 12 THEN 'WARN'",
        "advisory.index_entry_source": fails("dom % 12 = 0", "threaded NOT BETWEEN 1 AND 12"),
        "advisory.overview_prose": fails("dom % 16 < 6 OR (dom % 10 = 0 AND dom % 4 <> 0) OR dom + 10 < 20", "least(dom % 6, 5) / 5 < 0.5"),
        "advisory.window_wellformed": fails("dom % 15 = 0 OR (later AND pd % 6 = 0 AND dom % 15 = 0) OR (later AND CASE WHEN pd % 6 = 0 THEN 390 ELSE 840 END < 420)", "(later AND pd % 6 <> 0) OR (dom % 6 = 0 AND 23.5 < 24)"),
    },
)(lambda spark, d: frames.advisory_days(advisory_documents(spark, d)))


# drafts and repository: a document for each part

query(
    "rules_nested_drafts", "drafts",
    "x AS (SELECT CAST(p_partkey AS VARCHAR) AS key, p_partkey AS k, p_size AS n, len(p_name) AS c FROM part)",
    {"demo.date_present": fails("k % 7 < 2"), "demo.items_nonempty": fails("n % 5 = 1", skip="n % 5 = 0"), "demo.note_length": "WHEN c * 6 > 100 THEN 'WARN'", "demo.upstream_fresh": fails("false", "true", "k % 3 = 0")},
)(lambda spark, d: frames.drafts(documents(
    table(spark, d, "part"), "CAST(p_partkey AS STRING)",
    """'date', CASE p_partkey % 7 WHEN 0 THEN '20260820' WHEN 1 THEN NULL ELSE '2026-08-20' END, 'items', CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(array() AS array<string>) ELSE array_repeat('i', p_size) END,
    'note', repeat(p_name, 6), 'upstream_date', IF(p_partkey % 3 = 0, NULL, '2026-08-19')""", "draft"), env_broken=True))  # fmt: skip

query(
    "rules_nested_files", "files",
    "x AS (SELECT p_partkey || ':' || p_name AS key, p_partkey AS k FROM part)",
    {"repo.no_pull_request_target": fails("k % 6 = 0")},
)(lambda spark, d: frames.files(documents(
    table(spark, d, "part"), "CAST(p_partkey AS STRING)",
    "'path', p_name, 'text', 'on: push\\n' || CASE WHEN p_partkey % 6 = 0 THEN '  pull_request_target: # x' WHEN p_partkey % 6 = 1 THEN '# pull_request_target is not used' ELSE 'jobs:' END || '\\nend'", "files")))

query(
    "rules_nested_briefs", "briefs",
    "x AS (SELECT p_partkey || ':' || p_name AS key, p_size % 7 AS wide, len(p_name) * p_size AS plain, p_size * 5 AS budget, p_partkey % 9 = 0 AS unsourced FROM part)",
    {"repo.brief_budget": fails("wide + ceil(plain / 4) > budget OR unsourced")},
)(lambda spark, d: frames.briefs(documents(
    table(spark, d, "part"), "CAST(p_partkey AS STRING)",
    "'path', p_name, 'budget', p_size * 5, 'budget_source', IF(p_partkey % 9 = 0, ' ', 'plan'), 'text', repeat('字', p_size % 7) || repeat(p_name, p_size)", "brief")))


# podcast: a manifest for each day of events, a day document for each date of conversations


def manifest_documents(spark, d) -> DataFrame:
    e = table(spark, d, "events").withColumn("day", F.to_date("ts")).withColumn("dom", F.dayofmonth("day"))
    episode = """named_struct('showKey', event_type, 'title', IF(event_id % 40 = 0, 'Weekly Trailer', 'T' || event_id), 'releaseDate', IF(event_id % 21 = 0, CAST(day AS STRING) || 'T01:00:00Z', CAST(date_add(day, IF(event_id % 33 = 0, 2, 0)) AS STRING) || date_format(ts, "'T'HH:mm:ss.SSSSSS'Z'")),
        'durationMs', event_id % 30 * 60000, 'status', CASE event_id % 12 WHEN 0 THEN 'ok' WHEN 1 THEN 'FAILED' ELSE 'OK' END, 'completeness', IF(event_id % 8 = 0, NULL, value / 20), 'file', 'x-' || event_id || IF(event_id % 31 = 0, '.txt', '.md'), 'appleUrl', 'https://p.com/?i=' || (event_id + IF(event_id % 27 = 0, 1, 0)))"""
    days = e.groupBy("day", "dom").agg(F.expr(f"collect_list({episode})").alias("episodes"))
    fields = """'generatedAt', IF(dom % 10 = 0, NULL, CAST(date_add(day, 1) AS STRING) || 'T00:00:00Z'), 'windowStartUtc', CAST(IF(dom % 8 = 0, date_sub(day, 3), day) AS STRING) || 'T00:00:00Z', 'windowEndUtc', CAST(date_add(day, 1) AS STRING) || IF(dom % 7 = 0, 'T00:10:00Z', 'T00:00:00Z'),
        'episodes', IF(dom % 13 = 0, parse_json('{"a": 1}'), parse_json(to_json(episodes)))"""
    return documents(days, "CAST(day AS STRING)", fields, "manifest")


query(
    "rules_nested_manifests", "manifests",
    "x AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS key, dayofmonth(ts) AS dom FROM events)",
    {"podcast.manifest_wellformed": fails("dom % 10 = 0 OR dom % 13 = 0"), "podcast.window_sane": fails("(dom % 7 = 0 AND dom % 10 <> 0) OR dom % 8 = 0")},
)(lambda spark, d: frames.manifests(manifest_documents(spark, d)))


def _fetched(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    shows = e.where("event_type <> 'error'").select(F.col("event_type").alias("show")).distinct()
    block = lambda tokens, first: e.where("event_id % 20 = 0").select(F.expr("'x-' || event_id || IF(event_id % 31 = 0, '.txt', '.md')").alias("file"), F.expr(tokens).alias("tokens"), F.expr(first).alias("first"))
    return frames.fetched(manifest_documents(spark, d), shows, block("100 + event_id % 160", "event_id % 700").unionByName(block("900", "17")))


query(
    "rules_nested_fetched", "fetched",
    """e AS (SELECT *, CAST(ts AS DATE) AS day, dayofmonth(ts) AS dom, CASE WHEN event_id % 21 = 0 THEN CAST(ts AS DATE) + INTERVAL 1 HOUR ELSE ts + INTERVAL 2 DAY * (event_id % 33 = 0)::INT END AS r FROM events),
x AS (SELECT strftime(day, '%Y-%m-%d') || ':x-' || event_id || CASE WHEN event_id % 31 = 0 THEN '.txt' ELSE '.md' END AS key, *, CASE WHEN event_id % 8 <> 0 THEN value / 20 END AS c, count(*) OVER (PARTITION BY day, event_type, r) AS same FROM e WHERE dom % 13 <> 0)""",
    {
        "podcast.episode_admission": fails("event_id % 40 = 0 OR event_id % 30 < 10"),
        "podcast.show_keys_known": fails("event_type = 'error'"),
        "podcast.status_vocabulary": fails("event_id % 12 = 0"),
        "podcast.no_failed_episodes": fails("event_id % 12 = 1"),
        "podcast.completeness_band": fails("c < 0.55", "c > 1.35"),
        "podfetch.no_block_repetition": fails("event_id % 20 = 0 AND 100 + event_id % 160 >= 150 AND event_id % 700 >= 200"),
        "podcast.release_in_window": fails("event_id % 33 = 0 AND event_id % 21 <> 0 AND r > day + 1 + INTERVAL 10 MINUTE * (dom % 7 = 0)::INT"),
        "podcast.no_duplicate_episodes": fails("same > 1"),
        "podcast.file_id_matches_url": fails("event_id % 31 = 0 OR event_id % 27 = 0"),
    },
)(_fetched)


def _said(spark, d) -> DataFrame:
    """``id, date, turns`` of the conversations: their texts in order."""
    c = table(spark, d, "conversations")
    turns = F.expr("transform(array_sort(collect_list(struct(turn, role, text))), x -> coalesce(x.text, ''))")
    return c.groupBy("conv_id").agg(turns.alias("turns")).withColumn("date", F.expr("date_add(DATE '2026-01-01', CAST(conv_id % 40 AS INT))"))


def podcast_documents(spark, d) -> DataFrame:
    episode = """named_struct('id', 'c' || conv_id, 'minutes', IF(conv_id % 23 = 0, NULL, CAST(conv_id % 90 AS DOUBLE)), 'chars', aggregate(turns, 0, (a, t) -> a + length(t)), 'topics', slice(array('macro', IF(conv_id % 6 = 0, 'odd', 'tech'), 'policy', 'macro'), 1, CAST(conv_id % 5 AS INT)),
        'takeaways', array_repeat('t', CAST(2 + conv_id % 5 AS INT)), 'quotes', IF(conv_id % 24 = 0, CAST(array() AS array<struct<original:string,by:string>>), transform(sequence(0, CAST(conv_id % 5 AS INT)), i -> named_struct('original', IF(conv_id % 15 = 0 AND i = 0, 'zz nowhere', substring(turns[0], 3, 30)), 'by', 'a'))),
        'source', IF(conv_id % 12 = 0, ' [not collected]', 'feed'), 'lowerBoundException', IF(conv_id % 4 = 0, 'short', NULL), 'sections', array(named_struct('paragraphs', turns)))"""
    days = _said(spark, d).groupBy("date").agg(F.expr(f"collect_list({episode})").alias("episodes"))
    return documents(days, "CAST(date AS STRING)", "'date', CAST(date AS STRING), 'episodes', episodes, 'crossCut', IF(day(date) % 3 = 0, NULL, named_struct('points', array('p')))", "podcast")


def ledger_documents(spark, d) -> DataFrame:
    item = """named_struct('id', 'c' || conv_id, 'date', CAST(date AS STRING), 'due', CAST(date_add(date, CAST(conv_id % 50 AS INT)) AS STRING), 'status', CASE WHEN conv_id % 4 < 2 THEN 'watching' WHEN conv_id % 4 = 2 THEN 'hit' ELSE 'odd' END,
        'judge', named_struct('type', IF(conv_id % 3 = 0, 'manual', 'auto'), 'at', IF(conv_id % 2 = 0, '2026-02-01', NULL)))"""
    days = _said(spark, d).groupBy("date").agg(F.expr(f"collect_list({item})").alias("items"))
    return documents(days, "CAST(date AS STRING)", "'today', '2026-02-05', 'grace_days', 7, 'items', items", "ledger")


_P = f"""k AS (SELECT conv_id, DATE '2026-01-01' + CAST(conv_id % 40 AS INT) AS date, count(*) AS n, CAST(sum(len(coalesce(text, ''))) AS BIGINT) AS chars, first(text ORDER BY turn, role, text) AS t0, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, role, text) AS said FROM conversations GROUP BY 1),
f AS (SELECT *, {_form_sql('said')} AS sf, {_form_sql('substring(t0, 3, 30)')} AS qf FROM k)"""

query(
    "rules_nested_episodes", "episodes",
    f"""{_P}, x AS (SELECT strftime(date, '%Y-%m-%d') || ':c' || conv_id AS key, *, conv_id % 90 AS m, CASE WHEN conv_id % 90 < 30 THEN 0 WHEN conv_id % 90 < 60 THEN 1 ELSE 2 END AS t FROM k)""",
    {
        "podcast.chars_in_tier": fails("conv_id % 23 = 0 OR chars > ([900, 1600, 2600])[t + 1] OR (chars < ([100, 200, 300])[t + 1] AND conv_id % 4 <> 0) OR n NOT BETWEEN t + 1 AND ([4, 6, 9])[t + 1]"),
        "podcast.topics_controlled": fails("conv_id % 5 = 0 OR conv_id % 5 = 4 OR (conv_id % 6 = 0 AND conv_id % 5 >= 2)"),
        "podcast.per_episode_counts": fails("2 + conv_id % 5 NOT BETWEEN 3 AND 5 OR (conv_id % 12 = 0 AND conv_id % 24 <> 0) OR (conv_id % 12 <> 0 AND 1 + conv_id % 5 NOT BETWEEN 2 AND 5)"),
    },
)(lambda spark, d: frames.episodes(podcast_documents(spark, d)))

query(
    "rules_nested_podcast_days", "podcast_days",
    f"""{_P}, q AS (SELECT *, CASE WHEN conv_id % 24 = 0 THEN 0 ELSE 1 + conv_id % 5 END AS quotes, conv_id % 24 <> 0 AND conv_id % 15 = 0 AS made, contains(sf, qf) AS there, conv_id % 9 <> 0 AS kept FROM f),
x AS (SELECT strftime(date, '%Y-%m-%d') AS key, dayofmonth(date) % 3 = 0 AS uncut, count(*) AS n, sum(CASE WHEN kept THEN quotes ELSE 0 END) AS compared,
sum(CASE WHEN kept AND made THEN (NOT contains(sf, 'zz nowhere'))::INT + CASE WHEN there THEN 0 ELSE quotes - 1 END WHEN kept AND NOT coalesce(there, false) THEN quotes ELSE 0 END) AS missed FROM q GROUP BY date)""",
    {
        "podcast.crosscut_present": fails("n >= 3 AND uncut"),
        "podcast.quotes_grounded": fails("missed > 0", skip="compared = 0"),
        "podcast.ledger_advanced": fails("n NOT BETWEEN 2 AND 3"),
    },
)(lambda spark, d: frames.podcast_days(podcast_documents(spark, d), ledger_documents(spark, d), _said(spark, d).where("conv_id % 9 <> 0").select(F.concat(F.lit("c"), "conv_id").alias("id"), F.array_join("turns", "\n").alias("text"))))

query(
    "rules_nested_ledger", "ledger",
    """k AS (SELECT DISTINCT conv_id, DATE '2026-01-01' + CAST(conv_id % 40 AS INT) AS date FROM conversations), x AS (SELECT strftime(date, '%Y-%m-%d') || ':c' || conv_id AS key, conv_id, conv_id % 4 < 2 AS watching, DATE '2026-02-05' - (date + CAST(conv_id % 50 AS INT)) AS late FROM k)""",
    {
        "podcast.ledger_no_overdue": fails("watching AND late > 7", "watching AND late > 0"),
        "research.ledger_no_overdue": fails("conv_id % 4 = 3 OR (watching AND late > 14)"),
        "sentinel.ledger_overdue": "WHEN conv_id % 3 = 0 AND conv_id % 2 = 1 AND late > 0 THEN 'WARN'",
    },
)(lambda spark, d: frames.ledger(ledger_documents(spark, d)))


# research: a report for each document, a digest for each source


def report_documents(spark, d) -> DataFrame:
    fields = """'batch', source, 'slug', 's' || (doc_id - IF(doc_id % 50 = 1, 1, 0)), 'sha256', sha2(text, 256), 'source_file', 'f' || doc_id, 'broker', IF(doc_id % 13 = 0, NULL, source), 'broker_tally', map('a', doc_id % 9, 'b', doc_id % 4, 'c', doc_id % 2),
        'date', IF(doc_id % 17 = 0, NULL, '2026-08-01'), 'pages', 1 + doc_id % 5, 'claimed_pages', CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 1 + doc_id % 5 WHEN 2 THEN 0 ELSE 2 + doc_id % 5 END, 'engine', IF(doc_id % 97 = 0, 'other', 'main'),
        'page_one', left(text, 300), 'body', split(substring(text, 301), '\\n'), 'tables', array(named_struct('rows', array(array(lang, CAST(doc_id AS STRING))))), 'strip_report', named_struct('removed_pct', doc_id % 40 / 2)"""
    return documents(table(spark, d, "documents"), "CAST(doc_id AS STRING)", fields, "report")


def digest_documents(spark, d) -> DataFrame:
    chart = """named_struct('kind', CASE (doc_id + j) % 3 WHEN 0 THEN 'waterfall' WHEN 1 THEN 'grouped_bar' ELSE 'odd' END, 'title', 't', 'grounding', CASE j WHEN 0 THEN array(lang || '  ' || doc_id) WHEN 1 THEN array(lang || ' ' || doc_id, 'nowhere zz') WHEN 2 THEN NULL ELSE array(substring(text, 5, 20)) END,
        'cats', array('a', 'b', 'c'), 'vals', IF(doc_id % 8 = 0, CAST(array() AS array<double>), array(1D, 2D, 3D)), 'groups', IF((doc_id + j) % 3 = 1, array(named_struct('name', 'x', 'values', IF(doc_id % 9 = 0, array(1D, 2D), array(1D, 2D, 3D)))), NULL),
        'png', 'p' || doc_id || '_' || j || '.png', 'svg', 'p' || doc_id || '_' || j || '.svg', 'render_error', IF(doc_id % 19 = 0 AND j = 0, 'broken', NULL))"""
    report = f"""named_struct('slug', 's' || doc_id, 'summary_chars', length(text) % 1500, 'tier_band', array(200, 1200),
        'tags', transform(sequence(0, CAST(1 + doc_id % 6 AS INT)), j -> CASE WHEN j = 0 AND doc_id % 7 = 0 THEN 'bad tag' WHEN j = 0 AND doc_id % 11 = 0 THEN 'averyveryverylongtag' ELSE 'tag' || ((doc_id + j) % 50) END),
        'stances', array(named_struct('quote', IF(doc_id % 5 = 0, 'zz ', '') || substring(text, 11, 60), 'theme', IF(doc_id % 6 = 0, 'odd', 'rates')), named_struct('quote', IF(doc_id % 4 = 0, NULL, right(text, 40)), 'theme', 'fx')),
        'charts', transform(filter(sequence(0, 5), j -> j < doc_id % 6), j -> {chart}))"""
    # one document a source would not fit a row at scale, so a digest covers a few hundred reports of one
    rows = table(spark, d, "documents").where("doc_id % 50 <> 1").groupBy("source", F.expr("doc_id DIV 256").alias("part")).agg(F.expr(f"collect_list({report})").alias("reports"))
    return documents(rows, "concat_ws(':', source, part)", "'reports', reports", "digest")


def picture_files(spark, d) -> DataFrame:
    kinds = F.explode(F.expr("flatten(transform(filter(sequence(0, 5), j -> j < doc_id % 6), j -> array(struct(j, '.png' AS x), struct(j, '.svg' AS x))))"))
    return table(spark, d, "documents").select("doc_id", kinds.alias("f")).where("NOT (doc_id % 16 = 0 AND f.x = '.png')").select(
        F.concat(F.lit("p"), "doc_id", F.lit("_"), "f.j", "f.x").alias("name"), F.expr("IF(doc_id % 22 = 0 AND f.x = '.svg', 0, 30000)").alias("bytes")
    )


_BLOB = "left(text, 300) || chr(10) || substring(text, 301)"
_LEAKS = " + ".join(f"len(regexp_extract_all({_BLOB}, '{p}'))" for k, p in PRIVATE.items() if k not in ("phone", "ipv4"))

query(
    "rules_nested_reports", "reports",
    f"""a AS (SELECT *, doc_id - CASE WHEN doc_id % 50 = 1 THEN 1 ELSE 0 END AS s FROM documents), r AS (SELECT doc_id AS s, len(text) % 1500 AS summary, doc_id % 6 AS h, doc_id % 7 = 0 AS b, doc_id % 7 <> 0 AND doc_id % 11 = 0 AS lo, doc_id % 19 = 0 AS er, doc_id % 16 = 0 OR doc_id % 22 = 0 AS miss FROM documents WHERE doc_id % 50 <> 1),
x AS (SELECT CAST(doc_id AS VARCHAR) AS key, a.*, r.* EXCLUDE s, {_LEAKS} AS leaks, len(trim(regexp_replace(left(text, 300), '\\s+', ' ', 'g'))) AS one, count(*) OVER (PARTITION BY a.s) AS slugs, count(*) OVER (PARTITION BY sha256(text)) AS shas,
list_reverse_sort([doc_id % 9, doc_id % 4, doc_id % 2]) AS tally FROM a LEFT JOIN r USING (s))""",
    {
        "research.no_pii": fails("leaks > 0"),
        "research.identified": fails("doc_id % 13 = 0 OR doc_id % 17 = 0 OR tally[1] < 3", "tally[1] < 6 * tally[2]"),
        "research.strip_bounded": fails("doc_id % 40 / 2 >= 15", "doc_id % 40 / 2 >= 8"),
        "research.page_count": fails("doc_id % 4 = 3", skip="doc_id % 4 IN (0, 2)"),
        "research.page_one_substantial": fails("one < 200"),
        "research.no_duplicates": fails("slugs > 1 OR shas > 1"),
        "research.summary_length": fails("summary < 200", "summary > 1200"),
        "research.tags_wellformed": fails("h + 2 NOT BETWEEN 3 AND 6 OR b OR lo"),
        "research.chart_files_present": fails("h = 0 OR h = 5 OR miss OR (er AND h > 0)"),
    },
)(lambda spark, d: frames.reports(report_documents(spark, d), digest_documents(spark, d), picture_files(spark, d)))

_TEXTS = f"""t AS (SELECT s, min(said) AS said, min(wide) AS wide FROM (SELECT doc_id - CASE WHEN doc_id % 50 = 1 THEN 1 ELSE 0 END AS s, {_form_sql(_BLOB)} AS said, {_form_sql(f"{_BLOB} || chr(10) || lang || ' ' || doc_id")} AS wide FROM documents) GROUP BY 1)"""

query(
    "rules_nested_stances", "stances",
    f"""{_TEXTS}, r AS (SELECT doc_id AS s, 0 AS i, CASE WHEN doc_id % 5 = 0 THEN 'zz ' ELSE '' END || substring(text, 11, 60) AS q, doc_id % 6 = 0 AS odd FROM documents WHERE doc_id % 50 <> 1 UNION ALL SELECT doc_id, 1, CASE WHEN doc_id % 4 <> 0 THEN right(text, 40) END, false FROM documents WHERE doc_id % 50 <> 1),
x AS (SELECT 's' || s || ':' || i AS key, odd, {_form_sql("coalesce(q, '')")} AS f, said FROM r JOIN t USING (s))""",
    {"research.stance_grounded": fails("f = '' OR NOT contains(said, f)"), "research.theme_in_domain": fails("odd")},
)(lambda spark, d: frames.stances(report_documents(spark, d), digest_documents(spark, d), THEMES))

query(
    "rules_nested_report_charts", "report_charts",
    f"""{_TEXTS}, r AS (SELECT doc_id AS s, unnest(range(0, doc_id % 6)) AS j, text, lang FROM documents WHERE doc_id % 50 <> 1),
x AS (SELECT 's' || s || ':' || j AS key, s, j, (s + j) % 3 AS k, (NOT contains(wide, {_form_sql("lang || ' ' || s")}))::INT AS l0, (NOT contains(wide, 'nowhere zz'))::INT AS l1, (NOT contains(wide, {_form_sql("substring(text, 5, 20)")}))::INT AS l3 FROM r JOIN t USING (s))""",
    {
        "research.chart_grounded": fails("CASE j WHEN 0 THEN l0 WHEN 1 THEN l0 + l1 WHEN 2 THEN 1 ELSE l3 END > 0"),
        "research.chart_spec_wellformed": fails("k = 2 OR (k = 0 AND s % 8 = 0) OR (k = 1 AND s % 9 = 0)"),
    },
)(lambda spark, d: frames.report_charts(report_documents(spark, d), digest_documents(spark, d)))

query(
    "rules_nested_research_days", "research_days",
    "x AS (SELECT source AS key, count(DISTINCT CASE WHEN doc_id % 97 = 0 THEN 'other' ELSE 'main' END) AS n FROM documents GROUP BY 1)",
    {"research.one_engine": fails("n = 0", "n > 1")},
)(lambda spark, d: frames.research_days(report_documents(spark, d), digest_documents(spark, d)))


# sentinels: an index for each customer, a heartbeat for each supplier

query(
    "rules_nested_indexes", "indexes",
    """x AS (SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey % 11 = 0 AS none, CASE WHEN c_nationkey % 3 = 0 THEN 168 ELSE 24 END AS cadence, 28.0::DOUBLE + 24 * (c_custkey % 6 - 2) - 8 AS age, (c_custkey % 60) AS since, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 3 END AS days, CASE WHEN c_custkey % 4 > 0 THEN 1 + c_custkey % 5 END AS before FROM customer)""",
    {
        "sentinel.data_fresh": fails("none OR age > 1.5 * cadence"),
        "sentinel.no_future_date": fails("age < 0", skip="none"),
        "sentinel.updated_fresh": fails("since - 5 > 1.25 * cadence", "since < 5"),
        "sentinel.no_data_loss": fails("days < before", skip="before IS NULL"),
    },
)(lambda spark, d: frames.indexes(documents(
    table(spark, d, "customer"), "CAST(c_custkey AS STRING)",
    """'now', '2026-08-21T12:00:00Z', 'updated', date_format(TIMESTAMP '2026-08-21 17:00:00' - make_interval(0, 0, 0, 0, CAST(c_custkey % 60 AS INT)), "yyyy-MM-dd'T'HH:mm:ss'Z'"), 'cadence_hours', CASE WHEN c_nationkey % 3 = 0 THEN 168 WHEN c_nationkey % 3 = 1 THEN 24 END,
    'days', IF(c_custkey % 11 = 0, CAST(array() AS array<struct<date:string>>), transform(array(5, 0, 2), j -> named_struct('date', CAST(date_sub(DATE '2026-08-21', CAST(c_custkey % 6 - 2 + j AS INT)) AS STRING)))), 'prev', IF(c_custkey % 4 > 0, named_struct('day_count', 1 + c_custkey % 5), NULL)""", "index")))  # fmt: skip

query(
    "rules_nested_heartbeats", "heartbeats",
    "x AS (SELECT CAST(s_suppkey AS VARCHAR) AS key, s_suppkey AS k FROM supplier)",
    {
        "watch.sentinel_alive": fails("k % 9 = 0 OR k % 50 > 30"),
        "watch.sentinel_verdict": fails("k % 4 = 1"),
        "watch.no_code_drift": fails("k % 5 > 1", skip="k % 5 = 0"),
        "watch.external_binaries": fails("k % 6 = 1", skip="k % 6 = 0"),
    },
)(lambda spark, d: frames.heartbeats(documents(
    table(spark, d, "supplier"), "CAST(s_suppkey AS STRING)",
    """'now', '2026-08-21T12:00:00Z', 'heartbeat', named_struct('at', IF(s_suppkey % 9 = 0, 'never', date_format(TIMESTAMP '2026-08-21 12:00:00' - make_interval(0, 0, 0, 0, CAST(s_suppkey % 50 AS INT)), "yyyy-MM-dd'T'HH:mm:ss'Z'")), 'exit', IF(s_suppkey % 4 = 1, 10, 0)),
    'drift', CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE array_repeat('f', CAST(s_suppkey % 5 - 1 AS INT)) END, 'binaries', IF(s_suppkey % 6 = 0, NULL, map('a', true, 'b', s_suppkey % 6 <> 1))""", "heartbeat")))  # fmt: skip


query(
    "rules_nested_malformed", "files",
    "x AS (SELECT p_partkey || ':' || p_name AS key, p_partkey AS k FROM part WHERE p_partkey % 10 <> 0)",
    {"repo.no_pull_request_target": fails("k % 4 = 0")},
)(lambda spark, d: frames.files(frames.parsed(table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("key"), F.expr(
    """IF(p_partkey % 10 = 0, '{"path": "' || p_name, to_json(named_struct('path', p_name, 'text', IF(p_partkey % 4 = 0, 'on: pull_request_target', ''))))""").alias("json")), "files").where("malformed IS NULL")))  # fmt: skip
