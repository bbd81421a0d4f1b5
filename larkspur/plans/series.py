"""Queries over dated series."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.functions import scalars as C
from larkspur.operators import series as S
from larkspur.plans.inputs import MONTHLY, PANEL, RANKED, monthly, panel, table

QUERIES, ORACLES = {}, {}
W = "PARTITION BY series_id ORDER BY d"


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("series_rebase", f"WITH {PANEL} SELECT series_id, d, round(v / first_value(v) OVER ({W}) * 100, 2) AS v FROM panel")
def _(spark, d):
    return S.transform(panel(spark, d), "rebase")[0]


@query(
    "series_diff_monthly",
    f"""WITH {MONTHLY}, n AS (SELECT *, row_number() OVER ({W}) AS n FROM monthly)
SELECT a.series_id, a.d, round(a.v - b.v, 2) AS v FROM n a LEFT JOIN monthly b
ON a.series_id = b.series_id AND b.d = a.d - INTERVAL 1 MONTH WHERE n > 1""",
)
def _(spark, d):
    return S.transform(monthly(spark, d), "diff", monthly=True)[0]


@query("series_diff", f"WITH {PANEL} SELECT * FROM (SELECT series_id, d, round(v - lag(v) OVER ({W}), 2) AS v FROM panel) WHERE v IS NOT NULL")
def _(spark, d):
    return S.transform(panel(spark, d), "diff")[0]


@query(
    "series_yoy_monthly",
    f"""WITH {MONTHLY} SELECT a.series_id, a.d, round((a.v / nullif(b.v, 0) - 1) * 100, 2) AS v
FROM monthly a JOIN monthly b ON a.series_id = b.series_id AND b.d = a.d - INTERVAL 12 MONTH""",
)
def _(spark, d):
    return S.transform(monthly(spark, d), "yoy", monthly=True)[0]


@query("series_ma3", f"WITH {PANEL} SELECT series_id, d, round(avg(v) OVER ({W} ROWS 2 PRECEDING), 2) AS v FROM panel")
def _(spark, d):
    return S.transform(panel(spark, d), "ma:3")[0]


@query(
    "series_vol20",
    f"""WITH {PANEL}, r AS (SELECT *, v / nullif(lag(v) OVER ({W}), 0) - 1 AS r, row_number() OVER ({W}) AS n FROM panel)
SELECT series_id, d, round(100 * CASE WHEN count(r) OVER f = 20 THEN stddev_pop(r) OVER f END, 3) AS v FROM r
WINDOW f AS ({W} ROWS 19 PRECEDING) QUALIFY n > 20""",
)
def _(spark, d):
    return S.transform(panel(spark, d), "vol:20")[0]


@query(
    "series_realised_vol20",
    f"""WITH {PANEL}, r AS (SELECT *, ln(v / lag(v) OVER ({W})) AS r FROM panel)
SELECT series_id, d, round(CASE WHEN count(r) OVER f = 20 THEN stddev_samp(r) OVER f END * sqrt(252), 6) AS vol FROM r
WINDOW f AS ({W} ROWS 19 PRECEDING)""",
)
def _(spark, d):
    logs = panel(spark, d).withColumn("r", F.log(F.col("v") / F.lag("v").over(S.by_date())))
    vol = S.gated(F.stddev_samp("r"), 20, over="r") * F.sqrt(F.lit(252.0))
    return logs.select("series_id", "d", F.round(vol, 6).alias("vol"))


@query("series_align", f"WITH {PANEL} SELECT * FROM panel WHERE d IN (SELECT d FROM panel GROUP BY d HAVING count(DISTINCT series_id) = (SELECT count(DISTINCT series_id) FROM panel))")
def _(spark, d):
    return S.align(panel(spark, d)).select("series_id", "d", "v")


@query(
    "series_since",
    f"WITH {PANEL}, ended AS (SELECT * FROM panel WHERE series_id <> '5-LOW' OR d < DATE '1999-01-01') SELECT * FROM ended QUALIFY d >= DATE '2000-01-01' OR max(d) OVER (PARTITION BY series_id) < DATE '2000-01-01'",
)
def _(spark, d):
    """One series ends before the date, so it stays whole."""
    return S.since(panel(spark, d).where("series_id <> '5-LOW' OR d < DATE '1999-01-01'"), "2000-01-01")


@query("series_last_years", f"WITH {PANEL} SELECT series_id, d, v FROM panel QUALIFY d >= max(d) OVER (PARTITION BY series_id) - INTERVAL 2 YEAR")
def _(spark, d):
    return S.last_years(panel(spark, d), 2)


@query("series_tail_months", f"WITH {MONTHLY} SELECT * FROM monthly QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY d DESC) <= 30")
def _(spark, d):
    return S.tail(monthly(spark, d), 30)


@query(
    "series_downsample",
    f"""WITH {PANEL} SELECT series_id, d, v FROM panel
QUALIFY (row_number() OVER ({W}) - 1) % greatest(count(*) OVER (PARTITION BY series_id) // 900, 1) = 0""",
)
def _(spark, d):
    return S.every_kth(panel(spark, d), 900)


@query("series_is_monthly", f"WITH {MONTHLY} SELECT series_id, count(*) > 2 AND bool_and(day(d) = 1) AS monthly FROM monthly GROUP BY 1")
def _(spark, d):
    return S.is_monthly(monthly(spark, d))


@query(
    "macro_release",
    f"""WITH {MONTHLY}, y AS (SELECT a.series_id, a.d, round((a.v / nullif(b.v, 0) - 1) * 100, 2) AS v
FROM monthly a JOIN monthly b ON a.series_id = b.series_id AND b.d = a.d - INTERVAL 12 MONTH)
SELECT series_id, d, v AS yoy, round(avg(v) OVER ({W} ROWS 2 PRECEDING), 2) AS ma3, CAST(2.0 AS DOUBLE) AS target FROM y
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY d DESC) <= 30""",
)
def _(spark, d):
    yoy = S.yoy_monthly(monthly(spark, d))
    ma = S.moving_average(yoy, 3).withColumnRenamed("v", "ma3")
    return S.tail(yoy.withColumnRenamed("v", "yoy").join(ma, ["series_id", "d"]), 30).withColumn("target", F.lit(2.0))


@query("changes_5", f"WITH {PANEL} SELECT series_id, d, round((v / nullif(lag(v, 5) OVER ({W}), 0) - 1) * 100, 6) AS change FROM panel")
def _(spark, d):
    return S.changes(panel(spark, d), 5).select("series_id", "d", F.round("change", 6).alias("change"))


@query(
    "scan_moves",
    " UNION ALL ".join(
        f"""SELECT series_id, {w} AS w, round(max(last), 6) AS change, round(100 * avg(CASE WHEN c <= last THEN 1.0::DOUBLE ELSE 0 END), 6) AS pct_rank, count(*) AS n
FROM (SELECT series_id, c, last_value(c) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
FROM (SELECT series_id, d, (v / nullif(lag(v, {w}) OVER ({W}), 0) - 1) * 100 AS c
FROM (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)) WHERE c IS NOT NULL) GROUP BY 1"""
        for w in (1, 5)
    ),
)
def _(spark, d):
    return S.scan_moves(panel(spark, d), [1, 5])


@query("trailing_rank_60", f"WITH {RANKED} SELECT series_id, d, v, round(rank, 6) AS rank FROM ranked")
def _(spark, d):
    return S.trailing_rank(panel(spark, d), 60).withColumn("rank", F.round("rank", 6))


@query("trailing_rank_invert", f"WITH {RANKED} SELECT series_id, d, round(100 - rank, 6) AS rank FROM ranked")
def _(spark, d):
    return S.trailing_rank(panel(spark, d), 60, invert=True).select("series_id", "d", F.round("rank", 6).alias("rank"))


@query("full_rank", f"WITH {PANEL} SELECT series_id, d, v, round(100 * cume_dist() OVER (PARTITION BY series_id ORDER BY v), 6) AS rank FROM panel")
def _(spark, d):
    return S.full_rank(panel(spark, d)).withColumn("rank", F.round("rank", 6))


@query(
    "zones_cut",
    f"""WITH {RANKED} SELECT series_id, d, CASE WHEN rank IS NULL THEN NULL WHEN rank <= 10 THEN 'extreme fear' WHEN rank <= 40 THEN 'fear'
WHEN rank <= 60 THEN 'neutral' WHEN rank <= 90 THEN 'greed' ELSE 'extreme greed' END AS zone FROM ranked""",
)
def _(spark, d):
    zone = S.zones(F.col("rank"), (10, 40, 60, 90), ("extreme fear", "fear", "neutral", "greed", "extreme greed"))
    return S.trailing_rank(panel(spark, d), 60).select("series_id", "d", zone.alias("zone"))


for _name, _agg, _sql in (
    ("rolling_mean20", F.avg, "avg"),
    ("rolling_std20", F.stddev_samp, "stddev_samp"),
    ("rolling_min20", F.min, "min"),
    ("rolling_max20", F.max, "max"),
):

    @query(
        _name,
        f"""WITH {PANEL} SELECT series_id, d, round(CASE WHEN count(v) OVER f = 20 THEN {_sql}(v) OVER f END, 4) AS x
FROM panel WINDOW f AS ({W} ROWS 19 PRECEDING)""",
    )
    def _(spark, d, agg=_agg):
        return panel(spark, d).select("series_id", "d", F.round(S.gated(agg("v"), 20), 4).alias("x"))


@query(
    "rolling_min_periods",
    f"""WITH {PANEL} SELECT series_id, d, round(CASE WHEN count(v) OVER f >= 5 THEN avg(v) OVER f END, 4) AS x
FROM panel WINDOW f AS ({W} ROWS 19 PRECEDING)""",
)
def _(spark, d):
    return panel(spark, d).select("series_id", "d", F.round(S.gated(F.avg("v"), 20, least=5), 4).alias("x"))


@query(
    "rolling_median240",
    f"""WITH {PANEL} SELECT series_id, d, round(CASE WHEN count(v) OVER f >= 60 THEN quantile_cont(v, 0.5) OVER f END, 4) AS x
FROM panel WINDOW f AS ({W} ROWS 239 PRECEDING)""",
)
def _(spark, d):
    return panel(spark, d).select(
        "series_id", "d", F.round(S.gated(F.percentile("v", F.lit(0.5)), 240, least=60), 4).alias("x")
    )


@query(
    "drawdown60",
    f"""WITH {PANEL} SELECT series_id, d, round(v / CASE WHEN count(v) OVER f = 60 THEN max(v) OVER f END - 1, 6) AS dd
FROM panel WINDOW f AS ({W} ROWS 59 PRECEDING)""",
)
def _(spark, d):
    return panel(spark, d).select("series_id", "d", F.round(F.col("v") / S.gated(F.max("v"), 60) - 1, 6).alias("dd"))


@query(
    "relative_strength20",
    f"""WITH {PANEL}, g AS (SELECT *, v / lag(v, 20) OVER ({W}) AS g FROM panel)
SELECT a.d, round(a.g / b.g - 1, 6) AS rel FROM g a JOIN g b ON a.d = b.d
WHERE a.series_id = '1-URGENT' AND b.series_id = '5-LOW'""",
)
def _(spark, d):
    g = panel(spark, d).withColumn("g", F.col("v") / F.lag("v", 20).over(S.by_date()))
    of = lambda k, name: g.where(F.col("series_id") == k).select("d", F.col("g").alias(name))
    return of("1-URGENT", "a").join(of("5-LOW", "b"), "d").select("d", F.round(F.col("a") / F.col("b") - 1, 6).alias("rel"))


@query(
    "breadth50",
    f"""WITH {PANEL} SELECT d, round(avg(CASE WHEN up THEN 1.0::DOUBLE ELSE 0 END), 6) AS breadth FROM (
SELECT d, coalesce(v > CASE WHEN count(v) OVER f = 50 THEN avg(v) OVER f END, false) AS up FROM panel
WINDOW f AS ({W} ROWS 49 PRECEDING)) GROUP BY d""",
)
def _(spark, d):
    up = F.coalesce(F.col("v") > S.gated(F.avg("v"), 50), F.lit(False)).cast("double")
    return panel(spark, d).withColumn("up", up).groupBy("d").agg(F.round(F.avg("up"), 6).alias("breadth"))


@query(
    "qa_jump_flags",
    f"""WITH {PANEL}, r AS (SELECT series_id, d, r, row_number() OVER ({W}) AS n, avg(r) OVER p AS mu, stddev_pop(r) OVER p AS sd
FROM (SELECT *, v / nullif(lag(v) OVER ({W}), 0) - 1 AS r FROM panel) WHERE r IS NOT NULL WINDOW p AS (PARTITION BY series_id)),
hits AS (SELECT *, n - row_number() OVER ({W}) AS run FROM r WHERE sd > 0 AND abs(r - mu) > 3 * sd)
SELECT series_id, arg_max(d, abs(r - mu)) AS d, round(arg_max(r, abs(r - mu)), 6) AS r, count(*) AS run_length
FROM hits GROUP BY series_id, run""",
)
def _(spark, d):
    return S.jump_flags(panel(spark, d), 3.0)


@query(
    "weekly_last",
    f"""WITH {PANEL} SELECT series_id, CAST(date_trunc('week', d) AS DATE) + 6 AS week, arg_max(v, d) AS v FROM panel GROUP BY 1, 2""",
)
def _(spark, d):
    return S.weekly_last(panel(spark, d))


@query(
    "streak_from_latest",
    f"""WITH {PANEL}, s AS (SELECT series_id, d, v > 200000 AS high FROM panel),
n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY d DESC) AS n, first_value(high) OVER (PARTITION BY series_id ORDER BY d DESC) AS latest FROM s)
SELECT series_id, first(latest) AS latest, coalesce(min(n) FILTER (WHERE high <> latest), count(*) + 1) - 1 AS streak FROM n GROUP BY 1""",
)
def _(spark, d):
    return S.streak(panel(spark, d).withColumn("high", F.col("v") > 200000), "high")


@query(
    "isoweek_range",
    f"""WITH {PANEL} SELECT isoyear(d) || '-W' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS label, min(d) AS first_day, max(d) AS last_day,
CAST(date_trunc('week', min(d)) AS DATE) AS monday FROM panel GROUP BY 1""",
)
def _(spark, d):
    label = F.format_string("%d-W%02d", F.extract(F.lit("yearofweek"), "d"), F.weekofyear("d"))
    days = panel(spark, d).groupBy(label.alias("label")).agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    return days.withColumn("monday", F.date_trunc("week", "first_day").cast("date"))


@query(
    "waterfall_bases",
    f"""WITH {MONTHLY}, d AS (SELECT series_id, d, round(v - lag(v) OVER ({W}), 2) AS v FROM monthly),
r AS (SELECT *, coalesce(sum(v) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM d WHERE v IS NOT NULL)
SELECT series_id, d, v, round(least(run, run + v), 2) AS base FROM r""",
)
def _(spark, d):
    steps = S.diff(monthly(spark, d))
    run = F.coalesce(F.sum("v").over(S.by_date().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return steps.withColumn("base", F.round(F.least(run, run + F.col("v")), 2))


@query("pct_stack", f"WITH {MONTHLY} SELECT series_id, d, round(v / sum(abs(v)) OVER (PARTITION BY d) * 100, 4) AS share FROM monthly")
def _(spark, d):
    whole = F.sum(F.abs("v")).over(Window.partitionBy("d"))
    return monthly(spark, d).select("series_id", "d", F.round(F.col("v") / whole * 100, 4).alias("share"))


@query(
    "union_dates_align",
    f"""WITH {PANEL} SELECT k.series_id, x.d, p.v FROM (SELECT DISTINCT d FROM panel) x
CROSS JOIN (SELECT DISTINCT series_id FROM panel) k LEFT JOIN panel p ON p.d = x.d AND p.series_id = k.series_id""",
)
def _(spark, d):
    p = panel(spark, d)
    keys = p.agg(F.array_sort(F.collect_set("series_id")).alias("keys"))
    every = p.select("d").distinct().join(F.broadcast(keys)).select("d", F.explode("keys").alias("series_id"))
    return every.join(p, ["d", "series_id"], "left").select("series_id", "d", "v")


@query(
    "series_freshness",
    f"""WITH {MONTHLY}, l AS (SELECT series_id, max(d) AS last_d FROM monthly GROUP BY 1)
SELECT series_id, last_d, date_diff('day', last_d, DATE '2001-10-15') // 30 AS lag,
CASE WHEN date_diff('day', last_d, DATE '2001-10-15') // 30 >= 3 THEN 'FAIL' WHEN date_diff('day', last_d, DATE '2001-10-15') // 30 >= 2 THEN 'WARN' ELSE 'PASS' END AS level FROM l""",
)
def _(spark, d):
    lag = F.floor(F.datediff(F.lit("2001-10-15").cast("date"), "last_d") / 30)
    last = monthly(spark, d).groupBy("series_id").agg(F.max("d").alias("last_d")).withColumn("lag", lag)
    return last.withColumn("level", F.when(lag >= 3, "FAIL").when(lag >= 2, "WARN").otherwise("PASS"))


@query(
    "release_freshness",
    """WITH l AS (SELECT event_type, max(ts) AS last_updated FROM events GROUP BY 1), n AS (SELECT user_id, max(ts) AS now_ FROM events GROUP BY 1),
x AS (SELECT user_id, event_type, (epoch(date_trunc('second', now_)) - epoch(date_trunc('second', last_updated))) / 3600 AS age FROM n CROSS JOIN l)
SELECT user_id, event_type, round(age, 6) AS age_hours, age BETWEEN 0 AND 36 AS fresh FROM x""",
)
def _(spark, d):
    """Whether each kind's last event was fresh when a user was last seen; the kinds are a handful of aggregated rows."""
    e = table(spark, d, "events")
    kinds = e.groupBy("event_type").agg(F.max("ts").alias("last_updated")).agg(F.collect_list(F.struct("event_type", "last_updated")).alias("kinds"))
    seen = e.groupBy("user_id").agg(F.max("ts").alias("now")).join(F.broadcast(kinds)).select("user_id", "now", F.inline("kinds"))
    then, now = F.col("last_updated"), F.col("now")
    return seen.select("user_id", "event_type", F.round(C.age_hours(then, now), 6).alias("age_hours"), C.fresh(then, now).alias("fresh"))


@query(
    "half_even",
    """WITH x AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN (2 * l_orderkey + 1) * 5 / 1000::DOUBLE WHEN 1 THEN l_quantity / 8 ELSE -(l_extendedprice * l_discount) END::DOUBLE AS x FROM lineitem),
m AS (SELECT *, CASE WHEN x = 0 THEN 0 ELSE 52 - CAST(floor(log2(abs(x))) AS INT) END AS e FROM x),
i AS (SELECT *, CAST(abs(x) * pow(2, e) AS HUGEINT) * 100 AS big, CAST(pow(2::DOUBLE, e) AS HUGEINT) AS one FROM m),
q AS (SELECT *, big // one AS q, big % one AS r FROM i)
SELECT l_orderkey, l_linenumber, (CASE WHEN x < 0 THEN -1 ELSE 1 END * (q + CASE WHEN 2 * r > one OR (2 * r = one AND q % 2 = 1) THEN 1 ELSE 0 END))::DOUBLE / 100 AS v FROM q""",
)
def _(spark, d):
    """Half to even by the exact binary value: odd multiples of 0.005, few of which are the halves they look like, eighths, products."""
    k = F.col("l_linenumber") % 3
    x = F.when(k == 0, (2 * F.col("l_orderkey") + 1) * 5 / F.lit(1000.0)).when(k == 1, F.col("l_quantity").cast("double") / 8).otherwise(-(F.col("l_extendedprice") * F.col("l_discount")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.round_binary(x.cast("double"), 2).alias("v"))


@query(
    "spec_list",
    f"""WITH {PANEL}, a AS (SELECT * FROM panel WHERE series_id = '1-URGENT' AND d >= DATE '1995-01-01'), b AS (SELECT * FROM panel WHERE series_id = '2-HIGH'), c AS (SELECT * FROM panel WHERE series_id = '5-LOW' AND d >= DATE '1994-01-01'),
x AS (SELECT d FROM a INTERSECT SELECT d FROM b INTERSECT SELECT d FROM c)
SELECT 'urgent' AS name, d, v, false AS derived, 'line' AS style FROM a WHERE d IN (FROM x) UNION ALL
SELECT 'high', d, round(v / first_value(v) OVER (ORDER BY d) * 100, 2), false, NULL FROM b WHERE d IN (FROM x) UNION ALL
SELECT 'low', d, round(avg(v) OVER (ORDER BY d ROWS 2 PRECEDING), 2), true, 'bar' FROM c WHERE d IN (FROM x)""",
)
def _(spark, d):
    specs = [
        {"id": "1-URGENT", "name": "urgent", "since": "1995-01-01", "style": "line"}, {"id": "2-HIGH", "name": "high", "t": "rebase"},
        {"id": "5-LOW", "name": "low", "since": "1994-01-01", "t": "ma:3", "style": "bar"},
    ]
    return S.materialise(panel(spark, d), specs, aligned=True).withColumn("style", F.col("style")["style"])
