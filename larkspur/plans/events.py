"""Queries of event studies, strategy figures, joins of series and resampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import events as E
from larkspur.operators import joins as J
from larkspur.operators import series as S
from larkspur.operators import stats as T
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


def ranked(spark, d):
    return S.trailing_rank(panel(spark, d), 60)


@query("composite_gate", f"WITH {RANKED} SELECT d, round(CASE WHEN count(rank) >= 3 THEN avg(rank) END, 6) AS score, count(rank) AS n FROM ranked GROUP BY d")
def _(spark, d):
    parts = ranked(spark, d).select("d", F.col("rank").alias("v"))
    return E.composite(parts, 5).withColumn("score", F.round("score", 6))


@query(
    "consensus_signed",
    f"""WITH {RANKED} SELECT d, CASE WHEN count(rank) > 0 THEN count(*) FILTER (WHERE rank >= 90) - count(*) FILTER (WHERE rank <= 10) END AS net
FROM ranked GROUP BY d""",
)
def _(spark, d):
    return E.consensus(ranked(spark, d).select("d", F.col("rank").alias("v")), 10)


@query("weighted_rowsum", f"WITH {RANKED} SELECT d, round(sum(rank * CAST(left(series_id, 1) AS DOUBLE)), 6) AS score FROM ranked GROUP BY d")
def _(spark, d):
    weight = F.left("series_id", F.lit(1)).cast("double")
    return ranked(spark, d).groupBy("d").agg(F.round(F.sum(F.col("rank") * weight), 6).alias("score"))


@query("signal_extremes", f"WITH {RANKED} SELECT series_id, count(*) FILTER (WHERE rank <= 10) AS low, count(*) FILTER (WHERE rank >= 90) AS high, count(*) FILTER (WHERE rank > 10 AND rank <= 15) AS near_low FROM ranked GROUP BY 1")
def _(spark, d):
    r = F.col("rank")
    return ranked(spark, d).groupBy("series_id").agg(
        F.count_if(r <= 10).alias("low"), F.count_if(r >= 90).alias("high"), F.count_if((r > 10) & (r <= 15)).alias("near_low")
    )


@query("fwd_return_21", f"WITH {PANEL} SELECT series_id, d, round(lead(v, 21) OVER ({W}) / v - 1, 6) AS r FROM panel")
def _(spark, d):
    return panel(spark, d).select("series_id", "d", F.round(E.forward_return(21), 6).alias("r"))


@query(
    "mae_mfe_20",
    f"""WITH {PANEL} SELECT series_id, d, round(CASE WHEN lead(v, 20) OVER ({W}) IS NOT NULL THEN min(v) OVER f / v - 1 END, 6) AS mae,
round(CASE WHEN lead(v, 20) OVER ({W}) IS NOT NULL THEN max(v) OVER f / v - 1 END, 6) AS mfe
FROM panel WINDOW f AS ({W} ROWS BETWEEN CURRENT ROW AND 20 FOLLOWING)""",
)
def _(spark, d):
    return panel(spark, d).select(
        "series_id", "d", F.round(E.adverse_excursion(20), 6).alias("mae"), F.round(E.favourable_excursion(20), 6).alias("mfe")
    )


@query(
    "deep_fall_ahead",
    f"""WITH {PANEL}, p AS (SELECT *, row_number() OVER ({W}) AS n FROM panel),
x AS (SELECT a.series_id, a.d, b.n - a.n AS k, b.v, max(b.v) OVER (PARTITION BY a.series_id, a.d ORDER BY b.n) AS high
FROM p a JOIN p b ON a.series_id = b.series_id AND b.n BETWEEN a.n AND a.n + 20)
SELECT p.series_id, p.d, CASE WHEN count(x.k) = 21 THEN min(least(0, x.v / x.high - 1)) < -0.9 END AS deep
FROM p LEFT JOIN x USING (series_id, d) GROUP BY 1, 2""",
)
def _(spark, d):
    return panel(spark, d).select("series_id", "d", E.deep_fall_ahead(20, 0.9).alias("deep"))


@query(
    "local_extreme_lag",
    f"""WITH {PANEL}, h AS (SELECT series_id, d, list(v) OVER ({W} ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING) AS h,
count(*) OVER ({W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS b FROM panel)
SELECT series_id, d, CAST(b + 1 - list_position(h, list_min(h)) AS INT) AS lag FROM h""",
)
def _(spark, d):
    return panel(spark, d).select("series_id", "d", E.low_lag(30).alias("lag"))


_CROSS = f"""m AS (SELECT *, CASE WHEN count(v) OVER f = 10 THEN avg(v) OVER f END AS ma FROM panel WINDOW f AS ({W} ROWS 9 PRECEDING)),
c AS (SELECT *, coalesce(v > ma AND lag(v) OVER ({W}) <= lag(ma) OVER ({W}), false) AS cr FROM m)"""


@query("crossup_ma10", f"WITH {PANEL}, {_CROSS} SELECT series_id, d FROM c WHERE cr")
def _(spark, d):
    return E.cross_up(panel(spark, d), 10).where("cross").select("series_id", "d")


@query("ever_in_last20", f"WITH {RANKED} SELECT series_id, d, max(CASE WHEN rank <= 5 THEN 1 ELSE 0 END) OVER ({W} ROWS 19 PRECEDING) = 1 AS ever FROM ranked")
def _(spark, d):
    return ranked(spark, d).select("series_id", "d", E.ever_in_last(F.col("rank") <= 5, 20).alias("ever"))


@query(
    "setup_trigger",
    f"""WITH {RANKED}, s AS (SELECT series_id, d, max(CASE WHEN rank <= 5 THEN 1 ELSE 0 END) OVER ({W} ROWS 19 PRECEDING) = 1 AS setup FROM ranked),
{_CROSS} SELECT c.series_id, c.d FROM c JOIN s USING (series_id, d) WHERE c.cr AND s.setup""",
)
def _(spark, d):
    setup = ranked(spark, d).withColumn("setup", E.ever_in_last(F.col("rank") <= 5, 20))
    return E.cross_up(setup, 10).where("cross AND setup").select("series_id", "d")


_EPISODES = f"""f AS (SELECT *, row_number() OVER ({W}) AS pos FROM ranked), g AS (SELECT *, coalesce(pos - lag(pos) OVER ({W}) > 4, true) AS fresh
FROM f WHERE rank <= 10), e AS (SELECT *, sum(CAST(fresh AS INT)) OVER ({W}) AS k FROM g),
eps AS (SELECT series_id, min(d) AS start, max(d) AS "end", min(pos) AS pos, max(pos) - min(pos) + 1 AS n FROM e GROUP BY series_id, k)"""


def fear_episodes(spark, d):
    return E.episodes(ranked(spark, d), F.col("rank") <= 10, 3)


@query("episodes_gap3", f"WITH {RANKED}, {_EPISODES} SELECT * FROM eps")
def _(spark, d):
    return fear_episodes(spark, d)


def _greedy(source: str, least: int) -> str:
    return f"""chain AS (SELECT series_id, min(pos) AS pos FROM {source} GROUP BY 1 UNION ALL
SELECT c.series_id, (SELECT min(e.pos) FROM {source} e WHERE e.series_id = c.series_id AND e.pos >= c.pos + {least}) AS pos
FROM chain c WHERE c.pos IS NOT NULL)"""


@query("independent_h21", f"WITH RECURSIVE {RANKED}, {_EPISODES}, {_greedy('eps', 21)} SELECT e.series_id, e.start, e.pos FROM eps e JOIN chain USING (series_id, pos)")
def _(spark, d):
    return E.spaced(fear_episodes(spark, d), "pos", 21).select("series_id", "start", "pos")


@query("dedupe_gap10", f"WITH RECURSIVE {PANEL}, {_CROSS}, x AS (SELECT series_id, d, pos FROM (SELECT *, row_number() OVER ({W}) AS pos FROM c) WHERE cr), {_greedy('x', 11)} SELECT x.series_id, x.d FROM x JOIN chain USING (series_id, pos)")
def _(spark, d):
    hits = E.cross_up(panel(spark, d), 10).withColumn("pos", F.row_number().over(S.by_date())).where("cross")
    return E.spaced(hits, "pos", 11).select("series_id", "d")


@query(
    "event_study_21",
    f"""WITH RECURSIVE {RANKED}, {_EPISODES}, {_greedy('eps', 21)},
r AS (SELECT series_id, d, lead(v, 21) OVER ({W}) / v - 1 AS r FROM panel),
m AS (SELECT e.series_id, e.start AS d FROM eps e JOIN chain USING (series_id, pos))
SELECT r.series_id, count(m.d) FILTER (WHERE r IS NOT NULL) AS n_events, round(median(r) FILTER (WHERE m.d IS NOT NULL), 6) AS event_median, round(median(r), 6) AS base_median,
round(CASE WHEN count(m.d) FILTER (WHERE r IS NOT NULL) >= 3 THEN median(r) FILTER (WHERE m.d IS NOT NULL) - median(r) END, 6) AS effect
FROM r LEFT JOIN m USING (series_id, d) GROUP BY 1""",
)
def _(spark, d):
    starts = E.spaced(fear_episodes(spark, d), "pos", 21).select("series_id", F.col("start").alias("d"), F.lit(True).alias("event"))
    r = panel(spark, d).withColumn("r", E.forward_return(21)).join(starts, ["series_id", "d"], "left")
    on = F.coalesce("event", F.lit(False))
    return r.groupBy("series_id").agg(
        F.count_if(on & F.col("r").isNotNull()).alias("n_events"),
        F.round(F.median(F.when(on, F.col("r"))), 6).alias("event_median"),
        F.round(F.median("r"), 6).alias("base_median"),
        F.round(T.effect(on, F.col("r")), 6).alias("effect"),
    )


_WEIGHT = "CASE WHEN rank <= 10 THEN 1.0::DOUBLE WHEN rank >= 90 THEN 0.5 ELSE 0.75 END"
_STRATEGY = f"""s AS (SELECT series_id, d, coalesce(lag({_WEIGHT}) OVER ({W}), 0.75) AS held, v / nullif(lag(v) OVER ({W}), 0) - 1 AS r FROM ranked),
t AS (SELECT *, abs(held - coalesce(lag(held) OVER ({W}), held)) AS turnover FROM s), net AS (SELECT *, r * held - turnover * 0.0005 AS net FROM t)"""
_PERF = """round(pow(product(1 + x), 252.0 / count(*)) - 1, 6) AS annual, round(avg(x) / nullif(stddev_samp(x), 0) * sqrt(252), 6) AS sharpe,
round(min(fall), 6) AS mdd, count(*) AS n"""


def _curve(source: str, x: str, keys: str = "series_id") -> str:
    w = f"PARTITION BY {keys} ORDER BY d ROWS UNBOUNDED PRECEDING"
    return f"""c AS (SELECT {keys}, d, {x} AS x, product(1 + {x}) OVER ({w}) AS c FROM {source} WHERE {x} IS NOT NULL),
p AS (SELECT *, c / max(c) OVER ({w}) - 1 AS fall FROM c)"""


def timed(spark, d):
    weight = F.when(F.col("rank") <= 10, 1.0).when(F.col("rank") >= 90, 0.5).otherwise(0.75)
    return E.strategy(ranked(spark, d).withColumn("w", weight), "w")


@query("strategy_returns", f"WITH {RANKED}, {_STRATEGY} SELECT series_id, d, held, turnover, round(net, 8) AS net FROM net")
def _(spark, d):
    return timed(spark, d).select("series_id", "d", "held", "turnover", F.round("net", 8).alias("net"))


@query("exposure_matched", f"WITH {RANKED} SELECT series_id, round(0.75 - 0.25 * avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE ELSE 0 END), 8) AS w0 FROM ranked GROUP BY 1")
def _(spark, d):
    on = F.when(F.col("rank") <= 10, 1.0).otherwise(0.0)
    return ranked(spark, d).groupBy("series_id").agg(F.round(0.75 - 0.25 * F.avg(on), 8).alias("w0"))


def _damped(spark, d):
    """Daily returns scaled to a hundredth, so that products stay in range."""
    return panel(spark, d).withColumn("x", S.lag_return() / 100)


_DAMPED = f"damped AS (SELECT *, (v / nullif(lag(v) OVER ({W}), 0) - 1) / 100 AS x FROM panel)"


@query("sharpe_ann_mdd", f"WITH {PANEL}, {_DAMPED}, {_curve('damped', 'x')} SELECT series_id, {_PERF} FROM p GROUP BY 1")
def _(spark, d):
    return E.performance(_damped(spark, d), "x")


_SEGMENTS = f"""q AS (SELECT *, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM damped),
seg AS (SELECT q.*, s.segment FROM q JOIN range(5) s(segment) ON q.pos BETWEEN least(q.n * s.segment // 5, q.n - 1) AND least(q.n * (s.segment + 1) // 5, q.n - 1))"""


@query("walkforward5", f"WITH {PANEL}, {_DAMPED}, {_SEGMENTS} SELECT series_id, segment, min(d) AS first_d, max(d) AS last_d, count(*) AS n, round(avg(x), 8) AS mean FROM seg GROUP BY 1, 2")
def _(spark, d):
    return E.segments(_damped(spark, d), 5).groupBy("series_id", F.col("segment").cast("long").alias("segment")).agg(
        F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.count("*").alias("n"), F.round(F.avg("x"), 8).alias("mean")
    )


@query("split_60_40", f"WITH {PANEL}, {_DAMPED}, q AS (SELECT *, row_number() OVER ({W}) <= floor(0.6 * count(*) OVER (PARTITION BY series_id)) AS inside FROM damped) SELECT series_id, inside, count(*) AS n, round(avg(x), 8) AS mean FROM q GROUP BY 1, 2")
def _(spark, d):
    inside = F.row_number().over(S.by_date()) <= F.floor(F.lit(0.6) * F.count("*").over(Window.partitionBy("series_id")))
    return _damped(spark, d).withColumn("inside", inside).groupBy("series_id", "inside").agg(
        F.count("*").alias("n"), F.round(F.avg("x"), 8).alias("mean")
    )


# joins of series


_GAPPY = "gappy AS (SELECT series_id, d, CASE WHEN dayofmonth(d) % 7 < 3 THEN v END AS v FROM panel)"


@query("ffill_limit3", f"WITH {PANEL}, {_GAPPY} SELECT series_id, d, last_value(v IGNORE NULLS) OVER ({W} ROWS 3 PRECEDING) AS v FROM gappy")
def _(spark, d):
    gappy = panel(spark, d).withColumn("v", F.when(F.dayofmonth("d") % 7 < 3, F.col("v")))
    return J.forward_fill(gappy, "series_id", "d", "v", 3)


@query("left_reindex", f"WITH {PANEL}, days AS (SELECT DISTINCT d FROM panel) SELECT d, p.v FROM days LEFT JOIN (SELECT * FROM panel WHERE series_id = '2-HIGH') p USING (d)")
def _(spark, d):
    p = panel(spark, d)
    return J.reindex(p.select("d").distinct(), p.where("series_id = '2-HIGH'").select("d", "v"), ["d"])


_MONTHLY_END = MONTHLY.replace("monthly AS", "m AS")


@query("asof_backward", f"WITH {PANEL}, {_MONTHLY_END} SELECT p.series_id, p.d, p.v, m.v AS mv FROM panel p ASOF LEFT JOIN m ON p.series_id = m.series_id AND p.d >= m.d")
def _(spark, d):
    right = monthly(spark, d).withColumnRenamed("v", "mv")
    return J.asof(panel(spark, d), right, "series_id", "d", "mv")


@query("asof_scalar", f"WITH {PANEL} SELECT series_id, arg_max(v, d) AS v FROM panel WHERE d <= DATE '1999-06-15' GROUP BY 1")
def _(spark, d):
    return panel(spark, d).where("d <= DATE '1999-06-15'").groupBy("series_id").agg(F.max_by("v", "d").alias("v"))


@query(
    "nearest_20d",
    f"""WITH {PANEL}, {MONTHLY}, q AS (SELECT series_id, d, v AS mv FROM monthly WHERE month(d) % 2 = 0),
x AS (SELECT p.series_id, p.d, arg_max(q.mv, 1000000 - abs(date_diff('day', p.d, q.d)) * 1000 + CASE WHEN q.d > p.d THEN 1 ELSE 0 END) AS mv
FROM panel p JOIN q ON p.series_id = q.series_id AND abs(date_diff('day', p.d, q.d)) <= 20 GROUP BY 1, 2)
SELECT p.series_id, p.d, p.v, x.mv FROM panel p LEFT JOIN x USING (series_id, d)""",
)
def _(spark, d):
    right = monthly(spark, d).where(F.month("d") % 2 == 0).withColumnRenamed("v", "mv")
    return J.nearest(panel(spark, d), right, "series_id", "d", "mv", 20)


@query(
    "last_session",
    """WITH s AS (SELECT DISTINCT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_totalprice > 300000),
a AS (SELECT DISTINCT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT a.key, a.d, max(s.d) AS session, CAST(date_diff('day', max(s.d), a.d) AS INT) AS looked_back
FROM a LEFT JOIN s ON s.key = a.key AND s.d BETWEEN a.d - 10 AND a.d - 1 GROUP BY 1, 2""",
)
def _(spark, d):
    days = table(spark, d, "orders").select(F.col("o_orderpriority").alias("key"), F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    return J.last_session(days.select("key", "d").distinct(), days.where("o_totalprice > 300000"), "key", "d", 10)


@query(
    "splice_scale",
    f"""WITH {PANEL}, h AS (SELECT * FROM panel WHERE d < DATE '1999-01-01'), t AS (SELECT series_id, d, v * 0.1 AS v FROM panel WHERE d >= DATE '1998-06-01'),
j AS (SELECT series_id, max(d) AS j, arg_max(v, d) AS at FROM h GROUP BY 1), b AS (SELECT t.series_id, arg_max(t.v, t.d) AS base FROM t JOIN j USING (series_id) WHERE t.d <= j GROUP BY 1)
SELECT series_id, d, round(v, 2) AS v FROM (SELECT * FROM h UNION ALL SELECT t.series_id, t.d, t.v * j.at / nullif(b.base, 0) FROM t JOIN j USING (series_id) JOIN b USING (series_id) WHERE t.d > j.j)""",
)
def _(spark, d):
    p = panel(spark, d)
    tail = p.where("d >= DATE '1998-06-01'").withColumn("v", F.col("v") * F.lit(0.1))
    return J.splice(p.where("d < DATE '1999-01-01'"), tail, "series_id", "d", "v").withColumn("v", F.round("v", 2))


@query("predecessor_document", f"WITH {MONTHLY} SELECT series_id, d, lag(d) OVER ({W}) AS previous FROM monthly")
def _(spark, d):
    return J.predecessor(monthly(spark, d).select("series_id", "d"), "d", "series_id")


@query("pivot_last", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, " + ", ".join(f"arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderpriority LIKE '{i}%') AS p{i}" for i in range(1, 6)) + " FROM orders GROUP BY 1")
def _(spark, d):
    rows = table(spark, d, "orders").select(
        F.date_trunc("month", "o_orderdate").cast("date").alias("d"),
        F.concat(F.lit("p"), F.left("o_orderpriority", F.lit(1))).alias("p"),
        "o_totalprice",
        F.struct("o_orderdate", "o_orderkey").alias("at"),
    )
    return rows.groupBy("d").pivot("p", [f"p{i}" for i in range(1, 6)]).agg(F.max_by("o_totalprice", "at"))


# tests and resampling


@query(
    "mannwhitney",
    """WITH x AS (SELECT event_type = 'purchase' AS g, round(value, 2) AS v FROM events WHERE event_type IN ('purchase', 'view')),
t AS (SELECT v, count(*) AS t, count(*) FILTER (WHERE g) AS k FROM x GROUP BY 1),
r AS (SELECT *, coalesce(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0::DOUBLE AS rank FROM t),
s AS (SELECT sum(rank * k) AS r1, sum(k)::DOUBLE AS n1, sum(t)::DOUBLE AS n, sum(pow(t, 3) - t) AS ties FROM r)
SELECT round(r1 - n1 * (n1 + 1) / 2, 2) AS u, round((abs(r1 - n1 * (n1 + 1) / 2 - n1 * (n - n1) / 2) - 0.5) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))), 6) AS z,
CAST(n1 AS BIGINT) AS n1, CAST(n - n1 AS BIGINT) AS n2 FROM s""",
)
def _(spark, d):
    x = table(spark, d, "events").where(F.col("event_type").isin("purchase", "view"))
    return T.mann_whitney(x.withColumn("v", F.round("value", 2)), "event_type", "v", "purchase")


def _fisher_log(x):
    choose = lambda m, k: f"lgamma({m} + 1) - lgamma({k} + 1) - lgamma({m} - ({k}) + 1)"
    return f"{choose('k', x)} + {choose('(n - k)', f'(r - {x})')} - ({choose('n', 'r')})"


FISHER = f"""mg AS (SELECT *, a + b AS r, a + c AS k, a + b + c + d AS n FROM tb), tx AS (SELECT *, unnest(range(greatest(0, r + k - n), least(r, k) + 1)) AS i FROM mg),
lg AS (SELECT *, {_fisher_log('i')} AS li, {_fisher_log('a')} AS la FROM tx)"""


@query(
    "fisher_exact",
    f"""WITH tb AS (SELECT user_id, count(*) FILTER (WHERE hour(ts) < 12 AND event_type = 'purchase') AS a, count(*) FILTER (WHERE hour(ts) < 12 AND event_type <> 'purchase') AS b,
count(*) FILTER (WHERE hour(ts) >= 12 AND event_type = 'purchase') AS c, count(*) FILTER (WHERE hour(ts) >= 12 AND event_type <> 'purchase') AS d FROM events GROUP BY 1), {FISHER}
SELECT user_id, a, b, c, d, round(least(1, sum(exp(li)) FILTER (WHERE li <= la + 1e-7)), 9) AS p FROM lg GROUP BY ALL""",
)
def _(spark, d):
    """Purchases of the first against the second half of the day, for each user."""
    e = table(spark, d, "events")
    day = F.hour("ts") < 12
    counts = e.groupBy("user_id").agg(
        F.count_if(day & (F.col("event_type") == "purchase")).alias("a"),
        F.count_if(day & (F.col("event_type") != "purchase")).alias("b"),
        F.count_if(~day & (F.col("event_type") == "purchase")).alias("c"),
        F.count_if(~day & (F.col("event_type") != "purchase")).alias("d"),
    )
    return counts.withColumn("p", F.round(T.fisher_p(*map(F.col, "abcd")), 9))


_COIN = "lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.2::DOUBLE) + (n - i) * ln(0.8::DOUBLE)"


@query(
    "binomial_tail",
    f"""WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS k, count(*) AS n FROM events GROUP BY 1),
x AS (SELECT user_id, k, n, unnest(range(k, n + 1)) AS i FROM c), s AS (SELECT user_id, k, n, least(1, sum(exp({_COIN}))) AS p FROM x GROUP BY ALL)
SELECT user_id, k, n, round(p, 9) AS p, round(1 - pow(1 - p, 12), 9) AS family FROM s""",
)
def _(spark, d):
    """At least as many purchases among a user's events if each were one with probability 0.2; ``family``: in any of 12 such tests."""
    c = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("k"), F.count("*").alias("n"))
    c = c.withColumn("p", T.binomial_p(F.col("k"), F.col("n"), F.lit(0.2)))
    return c.withColumn("family", F.round(1 - F.pow(1 - F.col("p"), F.lit(12)), 9)).withColumn("p", F.round("p", 9))


_POS = f"base AS (SELECT series_id, row_number() OVER ({W}) - 1 AS pos, v, rank <= 10 AS flag FROM ranked WHERE rank IS NOT NULL), n AS (SELECT series_id, count(*) AS n, sum(v) AS total FROM base GROUP BY 1)"


def _base(spark, d):
    """``series_id, pos, v, flag`` of all days with a rank."""
    every = ranked(spark, d).where("rank IS NOT NULL")
    return every.select("series_id", (F.row_number().over(S.by_date()) - 1).cast("long").alias("pos"), "v", (F.col("rank") <= 10).alias("flag"))


@query(
    "block_bootstrap",
    f"""WITH {RANKED}, {_POS}, s AS (SELECT series_id, b, k, n, {T.DRAW_SQL.format(b='b', k='k', seed=3, n='n')} AS at_
FROM n, range(800) x(b), LATERAL (SELECT unnest(range((n + 20) // 21)) AS k)),
p AS (SELECT series_id, b, (at_ + i) % n AS pos FROM s, range(21) y(i) WHERE k * 21 + i < n)
SELECT series_id, CAST(b AS INT) AS b, round(avg(v), 6) AS mean FROM p JOIN base USING (series_id, pos) GROUP BY 1, 2""",
)
def _(spark, d):
    return T.circular_blocks(_base(spark, d), "series_id", 800, 21, 3, "v")


_SHIFT = f"""WITH {RANKED}, {_POS},
m AS (SELECT series_id, s, (pos + s) % n AS pos, n, total FROM base JOIN n USING (series_id), LATERAL (SELECT unnest(range(n)) AS s) WHERE flag),
e AS (SELECT series_id, s, round(sum(v) / count(*) - (any_value(total) - sum(v)) / nullif(any_value(n) - count(*), 0), 9) AS e FROM m JOIN base USING (series_id, pos) GROUP BY 1, 2),
o AS (SELECT series_id, e AS effect FROM e WHERE s = 0)
SELECT series_id, round(effect, 4) AS effect, round(avg(CASE WHEN abs(e) >= abs(effect) THEN 1.0::DOUBLE ELSE 0 END), 6) AS p, count(*) AS shifts FROM e JOIN o USING (series_id) WHERE s > 0 GROUP BY series_id, effect"""


@query("circular_shift_p", _SHIFT)
def _(spark, d):
    return T.circular_shift_p(_base(spark, d), "series_id", "flag", "v")


@query(
    "mde_grid",
    f"""WITH {RANKED}, {_POS},
x AS (SELECT series_id, b, {T.DRAW_SQL.format(b='b', k='k', seed=7, n='n')} AS pos FROM n, range(4000) u(b), range(9) w(k)),
m AS (SELECT series_id, b, median(v / 200000) AS m FROM x JOIN base USING (series_id, pos) GROUP BY 1, 2), c AS (SELECT series_id, quantile_cont(m, 0.95) AS crit FROM m GROUP BY 1)
SELECT series_id, round(any_value(crit), 6) AS crit, CAST(shift AS INT) AS shift, round(avg(CASE WHEN m + shift * 0.005::DOUBLE > crit THEN 1.0::DOUBLE ELSE 0 END), 6) AS power
FROM m JOIN c USING (series_id), range(160) g(shift) GROUP BY series_id, shift""",
)
def _(spark, d):
    base = _base(spark, d)
    draws = (
        base.groupBy("series_id").agg(F.count("*").alias("n"))
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(3999))))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(8))))
        .select("series_id", "b", T.draw(7, F.col("b").cast("long"), F.col("k").cast("long"), F.col("n")).alias("pos"))
        .hint("merge")
    )
    m = draws.join(base, ["series_id", "pos"]).groupBy("series_id", "b").agg(F.median(F.col("v") / 200000).alias("m"))
    crit = m.groupBy("series_id").agg(F.percentile("m", F.lit(0.95)).alias("crit"))
    grid = m.join(crit, "series_id").withColumn("shift", F.explode(F.sequence(F.lit(0), F.lit(159))))
    over = (F.col("m") + F.col("shift") * F.lit(0.005) > F.col("crit")).cast("double")
    return grid.groupBy("series_id", "shift").agg(F.round(F.first("crit"), 6).alias("crit"), F.round(F.avg(over), 6).alias("power"))


# with the statistic, draws and grid of the survey


_EVERY = f"""fwd AS (SELECT series_id, d, rank, lead(v, 21) OVER ({W}) / v - 1 AS r FROM ranked),
every_r AS (SELECT series_id, row_number() OVER ({W}) - 1 AS pos, r AS v, coalesce(rank <= 10, false) AS flag FROM fwd WHERE r IS NOT NULL),
sizes AS (SELECT series_id, count(*) AS n FROM every_r GROUP BY 1)"""


def _returns(spark, d):
    """``series_id, pos, v, flag`` of all days with a return over the next 21 rows."""
    r = ranked(spark, d).withColumn("r", E.forward_return(21)).where("r IS NOT NULL")
    return r.select("series_id", (F.row_number().over(S.by_date()) - 1).cast("long").alias("pos"), F.col("r").alias("v"), F.coalesce(F.col("rank") <= 10, F.lit(False)).alias("flag"))


_BOOTSTRAP = f"""{RANKED}, {_EVERY}, xb AS (SELECT series_id, b, k, n, {T.DRAW_SQL.format(b='b', k='k', seed=0, n='n')} AS at_ FROM sizes, range(800) t(b), LATERAL (SELECT unnest(range((n + 20) // 21)) AS k)),
pb AS (SELECT series_id, b, (at_ + i) % n AS pos FROM xb, range(21) y(i) WHERE k * 21 + i < n),
eb AS (SELECT series_id, b, CASE WHEN count(*) FILTER (WHERE flag) >= 3 THEN median(v) FILTER (WHERE flag) - median(v) END AS e FROM pb JOIN every_r USING (series_id, pos) GROUP BY 1, 2),
lb AS (SELECT series_id, count(e) AS k, quantile_cont(e, 0.05) AS lo, quantile_cont(e, 0.95) AS hi FROM eb GROUP BY 1),
ob AS (SELECT series_id, count(*) AS n, CASE WHEN count(*) >= 63 AND count(*) FILTER (WHERE flag) >= 3 THEN median(v) FILTER (WHERE flag) - median(v) END AS point FROM every_r GROUP BY 1)"""
_BOOTSTRAP_ROWS = """SELECT series_id, round(point, 6) AS point, round(CASE WHEN point IS NOT NULL AND k >= 400 THEN lo END, 6) AS low, round(CASE WHEN point IS NOT NULL AND k >= 400 THEN hi END, 6) AS high FROM ob JOIN lb USING (series_id)"""


@query("bootstrap_effect", f"WITH {_BOOTSTRAP} {_BOOTSTRAP_ROWS}")
def _(spark, d):
    return T.bootstrap_effect(_returns(spark, d), "series_id", "flag", "v", 21)


_DETECTABLE = f"""ev AS (SELECT series_id, count(*) AS n_events FROM chain WHERE pos IS NOT NULL GROUP BY 1),
z AS (SELECT series_id, n, coalesce(n_events, 0) AS n_events FROM sizes LEFT JOIN ev USING (series_id)),
xm AS (SELECT series_id, b, {T.DRAW_SQL.format(b='b', k='k', seed=1, n='n')} AS pos FROM z, range(4000) t(b), LATERAL (SELECT unnest(range(n_events)) AS k) WHERE n >= 50 AND n_events >= 3),
med AS (SELECT series_id, b, median(v) AS m FROM xm JOIN every_r USING (series_id, pos) GROUP BY 1, 2), c AS (SELECT series_id, quantile_cont(m, 0.95) AS crit FROM med GROUP BY 1),
grid AS (SELECT series_id, s, avg(CASE WHEN m + s * 0.005::DOUBLE > crit THEN 1.0::DOUBLE ELSE 0 END) AS p FROM med JOIN c USING (series_id), range(160) t(s) GROUP BY 1, 2),
lm AS (SELECT series_id, min(s) AS s FROM grid WHERE p >= 0.8 GROUP BY 1)"""
_DETECTABLE_ROWS = """SELECT series_id, n_events, round(crit, 6) AS crit, round(s * 0.005::DOUBLE, 3) AS shift FROM z LEFT JOIN c USING (series_id) LEFT JOIN lm USING (series_id)"""


@query("min_detectable", f"WITH RECURSIVE {RANKED}, {_EVERY}, {_EPISODES}, {_greedy('eps', 21)}, {_DETECTABLE} {_DETECTABLE_ROWS}")
def _(spark, d):
    events = E.spaced(fear_episodes(spark, d), "pos", 21).groupBy("series_id").agg(F.count("*").alias("n_events"))
    return T.min_detectable(_returns(spark, d), events, "series_id", "v")


@query(
    "three_way_verdict",
    f"""WITH RECURSIVE {_BOOTSTRAP}, bo AS ({_BOOTSTRAP_ROWS}), {_EPISODES}, {_greedy('eps', 21)}, {_DETECTABLE}, de AS ({_DETECTABLE_ROWS})
SELECT series_id, n_events, CASE WHEN n_events < 8 THEN 'too few' WHEN point IS NULL OR low IS NULL THEN 'unknown' WHEN low > 0 AND point >= 0.02 THEN 'pass'
  WHEN shift IS NOT NULL AND abs(point) < shift AND low < 0 AND high > 0 THEN 'undetectable' WHEN high < 0 THEN 'reverse' ELSE 'fail' END AS verdict FROM bo JOIN de USING (series_id)""",
)
def _(spark, d):
    """The resampled interval and the smallest detectable effect of each series, judged together."""
    every = _returns(spark, d)
    events = E.spaced(fear_episodes(spark, d), "pos", 21).groupBy("series_id").agg(F.count("*").alias("n_events"))
    interval = T.bootstrap_effect(every, "series_id", "flag", "v", 21)
    both = interval.join(T.min_detectable(every, events, "series_id", "v"), "series_id")
    point, low, high, least, n = (F.col(c) for c in ("point", "low", "high", "shift", "n_events"))
    return both.select("series_id", "n_events", T.verdict(point, low, high, least, 0.02, n).alias("verdict"))


@query(
    "trigger_progress",
    f"""WITH {RANKED}, p AS (SELECT d, rank, CASE WHEN rank IS NOT NULL THEN greatest(0, least(100, (100 - rank) / 90 * 100)) END AS p FROM ranked)
SELECT d, count(*) FILTER (WHERE p >= 100) AS n_lit, count(*) FILTER (WHERE p >= 80 AND p < 100) AS n_near FROM p GROUP BY d""",
)
def _(spark, d):
    p = F.when(F.col("rank").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), (100 - F.col("rank")) / 90 * 100)))
    return ranked(spark, d).withColumn("p", p).groupBy("d").agg(
        F.count_if(F.col("p") >= 100).alias("n_lit"), F.count_if((F.col("p") >= 80) & (F.col("p") < 100)).alias("n_near")
    )
