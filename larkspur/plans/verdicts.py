"""Queries that judge a signal: event studies over all horizons, shift tests, timeliness, gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import events as E
from larkspur.operators import series as S
from larkspur.operators import stats as T
from larkspur.plans.events import _EPISODES, W, fear_episodes, ranked
from larkspur.plans.inputs import PANEL, RANKED, panel

QUERIES, ORACLES = {}, {}
HORIZONS = (5, 21, 63)
DRAWS = 1000


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def _every_horizon(df):
    """Rows with ``h`` and the return ``r`` over the next h rows, null at the end."""
    return reduce(lambda a, b: a.unionByName(b), (df.withColumn("h", F.lit(h)).withColumn("r", E.forward_return(h)) for h in HORIZONS))


_H = f"(VALUES {', '.join(f'({h})' for h in HORIZONS)}) hs(h)"
_AHEAD = " UNION ALL ".join(f"SELECT series_id, d, {h} AS h, rank, lead(v, {h}) OVER ({W}) / v - 1 AS r, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM ranked" for h in HORIZONS)
_TAIL = "(" + " + ".join(f"{c}::DOUBLE * pow(1 / (1 + {T.TAIL_SCALE}::DOUBLE * abs(z)), {i + 1})" for i, c in enumerate(T.TAIL)) + ") * exp(-z * z / 2) / sqrt(2 * pi())"


@query(
    "event_study_horizons",
    f"""WITH RECURSIVE {RANKED}, {_EPISODES}, ahead AS ({_AHEAD}),
chain AS (SELECT series_id, h, min(pos) AS pos FROM eps, {_H} GROUP BY 1, 2 UNION ALL
SELECT c.series_id, c.h, (SELECT min(e.pos) FROM eps e WHERE e.series_id = c.series_id AND e.pos >= c.pos + c.h) AS pos FROM chain c WHERE c.pos IS NOT NULL),
ev AS (SELECT series_id, h, pos - 1 AS pos FROM chain WHERE pos IS NOT NULL),
x AS (SELECT a.series_id, a.h, a.r, e.pos IS NOT NULL AS ev FROM ahead a LEFT JOIN ev e USING (series_id, h, pos)),
t AS (SELECT series_id, h, r, count(*) AS t, count(*) FILTER (WHERE ev) AS k FROM x WHERE r IS NOT NULL GROUP BY 1, 2, 3),
c AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY series_id, h ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM t),
s AS (SELECT series_id, h, sum(k * (below + t / 2)) AS u, sum(k)::DOUBLE AS n1, sum(t)::DOUBLE AS n2, sum(pow(t + k, 3) - (t + k)) AS ties FROM c GROUP BY 1, 2),
q AS (SELECT *, (abs(u - n1 * n2 / 2) - 0.5) / nullif(sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / nullif((n1 + n2) * (n1 + n2 - 1), 0))), 0) AS z FROM s),
p AS (SELECT series_id, h, CASE WHEN z IS NULL THEN NULL WHEN z >= 0 THEN least(1, 2 * {_TAIL}) ELSE least(1, 2 * (1 - {_TAIL})) END AS p FROM q),
m AS (SELECT series_id, h, count(*) FILTER (WHERE ev) AS n_independent, count(*) FILTER (WHERE ev AND r IS NOT NULL) AS n, median(r) FILTER (WHERE ev) AS em, median(r) AS bm FROM x GROUP BY 1, 2)
SELECT series_id, h, n_independent, n, round(bm * 100, 2) AS base_median, CASE WHEN n >= 2 THEN round(em * 100, 2) END AS event_median,
CASE WHEN n >= 2 THEN round((em - bm) * 100, 2) END AS difference, CASE WHEN n >= 2 THEN round(p, 4) END AS p FROM m LEFT JOIN p USING (series_id, h)""",
)
def _(spark, d):
    """Per horizon: returns after independent starts of low episodes against those of all days."""
    eps = fear_episodes(spark, d)
    starts = reduce(
        lambda a, b: a.unionByName(b),
        (E.spaced(eps, "pos", h).select("series_id", F.col("start").alias("d"), F.lit(h).alias("h"), F.lit(True).alias("event")) for h in HORIZONS),
    )
    x = _every_horizon(panel(spark, d)).join(starts, ["series_id", "h", "d"], "left").withColumn("event", F.coalesce("event", F.lit(False)))
    on, r = F.col("event"), F.col("r")
    m = x.groupBy("series_id", "h").agg(
        F.count_if(on).alias("n_independent"), F.count_if(on & r.isNotNull()).alias("n"), F.median(F.when(on, r)).alias("em"), F.median(r).alias("bm")
    )
    tested = T.events_against_all(x, ["series_id", "h"], "event", "r")
    enough = F.col("n") >= 2
    return m.join(tested, ["series_id", "h"], "left").select(
        "series_id", "h", "n_independent", "n", F.round(F.col("bm") * 100, 2).alias("base_median"), F.when(enough, F.round(F.col("em") * 100, 2)).alias("event_median"),
        F.when(enough, F.round((F.col("em") - F.col("bm")) * 100, 2)).alias("difference"), F.when(enough, F.round("p", 4)).alias("p"),
    )


@query(
    "timeliness",
    f"""WITH {RANKED}, {_EPISODES}, h AS (SELECT series_id, d, list(v) OVER ({W} ROWS BETWEEN 60 PRECEDING AND 60 FOLLOWING) AS h, count(*) OVER ({W} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS b FROM panel),
l AS (SELECT e.series_id, e.n, CAST(b + 1 - list_position(h, list_min(h)) AS INT) AS lag FROM eps e JOIN h ON h.series_id = e.series_id AND h.d = e.start),
a AS (SELECT series_id, count(*) AS events, CAST(trunc(median(n)) AS INT) AS length, CAST(trunc(median(lag)) AS INT) AS lag FROM l GROUP BY 1),
y AS (SELECT series_id, date_diff('day', min(d), max(d)) / 365.25::DOUBLE AS years, avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE ELSE 0 END) AS share FROM ranked GROUP BY 1)
SELECT series_id, coalesce(events, 0) AS events, round(events / years, 2) AS per_year, length, round(share * 100, 1) AS extreme_share, lag FROM y LEFT JOIN a USING (series_id)""",
)
def _(spark, d):
    """How rare low episodes are, how long they last and how many rows behind the lowest value they start."""
    r = ranked(spark, d)
    lags = panel(spark, d).select("series_id", F.col("d").alias("start"), E.low_lag(60).alias("lag"))
    whole = lambda c: F.median(c).cast("int")
    a = fear_episodes(spark, d).join(lags, ["series_id", "start"]).groupBy("series_id").agg(F.count("*").alias("events"), whole("n").alias("length"), whole("lag").alias("lag"))
    low = F.coalesce((F.col("rank") <= 10).cast("double"), F.lit(0.0))
    y = r.groupBy("series_id").agg((F.datediff(F.max("d"), F.min("d")) / 365.25).alias("years"), F.avg(low).alias("share"))
    return y.join(a, "series_id", "left").select(
        "series_id", F.coalesce("events", F.lit(0)).alias("events"), F.round(F.col("events") / F.nullif("years", F.lit(0.0)), 2).alias("per_year"), "length",
        F.round(F.col("share") * 100, 1).alias("extreme_share"), "lag",
    )


# shift tests


def _timed(spark, d):
    """``series_id, d, pos, n, w, x, v``: the weight decided on a day and the return of that day, a hundredth of it."""
    whole = Window.partitionBy("series_id")
    w = F.when(F.col("rank") <= 10, 1.0).when(F.col("rank") >= 90, 0.5).otherwise(0.75)
    return ranked(spark, d).select(
        "series_id", "d", (F.row_number().over(S.by_date()) - 1).cast("long").alias("pos"), F.count("*").over(whole).alias("n"), w.alias("w"),
        F.coalesce(S.lag_return() / 100, F.lit(0.0)).alias("x"), "v",
    )


_TIMED = f"""timed AS (SELECT series_id, d, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n,
CASE WHEN rank <= 10 THEN 1.0::DOUBLE WHEN rank >= 90 THEN 0.5 ELSE 0.75 END AS w, coalesce((v / nullif(lag(v) OVER ({W}), 0) - 1) / 100, 0) AS x, v FROM ranked)"""


def _sharpe_sql(x):
    return f"avg({x}) / nullif(stddev_samp({x}), 0) * sqrt(252)"


_SHIFTED = f"""wt AS (SELECT series_id, pos AS at_, w, coalesce(lag(w) OVER (PARTITION BY series_id ORDER BY pos), arg_max(w, pos) OVER (PARTITION BY series_id)) AS bef FROM timed),
sh AS (SELECT t.series_id, b, pos, x, n, CASE WHEN b < 0 THEN 0 ELSE 1 + {T.DRAW_SQL.format(b='b', k='0', seed=7, n='(n - 1)')} END AS s FROM timed t, range(-1, {DRAWS}) u(b)),
jo AS (SELECT sh.series_id, b, x, CASE WHEN pos = 0 THEN 0.75 ELSE w END * x - CASE WHEN pos = 0 THEN 0 WHEN pos = 1 THEN abs(w - 0.75) ELSE abs(w - bef) END * 0.0005 AS r
FROM sh JOIN wt ON wt.series_id = sh.series_id AND wt.at_ = ((pos - 1 - s) % n + n) % n),
gains AS (SELECT series_id, b, round({_sharpe_sql('r')} - {_sharpe_sql('x')}, 9) AS gain FROM jo GROUP BY 1, 2),
own AS (SELECT series_id, gain AS own FROM gains WHERE b < 0),
ps AS (SELECT series_id, avg(CASE WHEN gain >= own THEN 1.0::DOUBLE ELSE 0 END) AS p FROM gains JOIN own USING (series_id) WHERE b >= 0 AND gain IS NOT NULL GROUP BY 1)"""


@query("sharpe_shift_p", f"WITH {RANKED}, {_TIMED}, {_SHIFTED} SELECT series_id, round(own, 6) AS gain, round(p, 6) AS p FROM own LEFT JOIN ps USING (series_id)")
def _(spark, d):
    return T.sharpe_shift_p(_timed(spark, d), "series_id", DRAWS)


_SIDE = "CASE WHEN rank <= 10 THEN 'low' WHEN rank >= 90 THEN 'high' END"
_MEDIANS = f"""ahead AS ({_AHEAD}), mv AS (SELECT series_id, h, {_SIDE} AS side, b, (pos + CASE WHEN b < 0 THEN 0 ELSE 1 + {T.DRAW_SQL.format(b='b', k='0', seed=3, n='(n - 1)')} END) % n AS pos
FROM ahead, range(-1, {DRAWS}) u(b) WHERE {_SIDE} IS NOT NULL),
md AS (SELECT mv.series_id, mv.h, mv.side, mv.b, CASE WHEN count(r) >= 3 THEN median(r) END AS m FROM mv JOIN ahead USING (series_id, h, pos) GROUP BY 1, 2, 3, 4)"""


def _medians(spark, d):
    side = F.when(F.col("rank") <= 10, "low").when(F.col("rank") >= 90, "high")
    base = _every_horizon(ranked(spark, d)).select(
        "series_id", "h", "r", side.alias("side"), (F.row_number().over(Window.partitionBy("series_id", "h").orderBy("d")) - 1).cast("long").alias("pos")
    )
    return base, T.shifted_medians(base, ["series_id", "h"], "side", "r", DRAWS, 3)


@query(
    "gap_shift_p",
    f"""WITH {RANKED}, {_MEDIANS}, g AS (SELECT series_id, h, b, max(m) FILTER (WHERE side = 'low') - max(m) FILTER (WHERE side = 'high') AS gap FROM md GROUP BY 1, 2, 3),
o AS (SELECT series_id, h, gap AS own FROM g WHERE b < 0), p AS (SELECT series_id, h, avg(CASE WHEN round(abs(gap), 9) >= round(abs(own), 9) THEN 1.0::DOUBLE WHEN own IS NULL THEN NULL ELSE 0 END) AS p FROM g JOIN o USING (series_id, h) WHERE b >= 0 AND gap IS NOT NULL GROUP BY 1, 2)
SELECT series_id, h, round(own, 6) AS gap, round(p, 6) AS p FROM o LEFT JOIN p USING (series_id, h)""",
)
def _(spark, d):
    """Whether returns after low ranks differ from those after high ones by more than shifted flags give."""
    pick = lambda s: F.max(F.when(F.col("side") == s, F.col("m")))
    gaps = _medians(spark, d)[1].groupBy("series_id", "h", "b").agg((pick("low") - pick("high")).alias("gap"))
    return T.shift_p(gaps, ["series_id", "h"], "gap")


@query(
    "family_shift_p",
    f"""WITH {RANKED}, {_MEDIANS}, bm AS (SELECT series_id, h, median(r) AS bm FROM ahead GROUP BY 1, 2),
g AS (SELECT side, b, avg(m - bm) AS effect FROM md JOIN bm USING (series_id, h) GROUP BY 1, 2), o AS (SELECT side, effect AS own FROM g WHERE b < 0)
SELECT side, round(own, 6) AS effect, round(avg(CASE WHEN round(abs(effect), 9) >= round(abs(own), 9) THEN 1.0::DOUBLE ELSE 0 END), 6) AS p FROM g JOIN o USING (side) WHERE b >= 0 AND effect IS NOT NULL GROUP BY side, own""",
)
def _(spark, d):
    """The mean effect of all series and horizons, tested with one shift for all of them."""
    base, m = _medians(spark, d)
    overall = base.groupBy("series_id", "h").agg(F.median("r").alias("bm"))
    each = m.join(overall, ["series_id", "h"]).groupBy("side", "b").agg(F.avg(F.col("m") - F.col("bm")).alias("effect"))
    return T.shift_p(each, ["side"], "effect")


# gates


def _net(spark, d, start=0.75):
    """Adds ``net``, the timed return after cost, and ``ma``, that of holding while the day before closed above its 20-row average.

    ``start`` is the weight held on the first day.
    """
    w = S.by_date()
    t = _timed(spark, d)
    held = F.coalesce(F.lag("w").over(w), F.lit(start))
    above = F.coalesce((F.col("v") > S.gated(F.avg("v"), 20)).cast("double"), F.lit(0.0))
    t = t.withColumn("held", held).withColumn("above", above)
    turned = F.abs(F.col("held") - F.coalesce(F.lag("held").over(w), F.col("held")))
    kept = F.coalesce(F.lag("above").over(w), F.lit(0.0))
    t = t.withColumn("turned", turned).withColumn("kept", kept)
    switched = F.abs(F.col("kept") - F.coalesce(F.lag("kept").over(w), F.col("kept")))
    return t.withColumn("net", F.col("held") * F.col("x") - F.col("turned") * 0.0005).withColumn("ma", F.col("kept") * F.col("x") - switched * 0.0005)


def _net_sql(start=0.75):
    return f"""n1 AS (SELECT *, coalesce(lag(w) OVER ({W}), {start}) AS held, CASE WHEN count(v) OVER ({W} ROWS 19 PRECEDING) = 20 AND v > avg(v) OVER ({W} ROWS 19 PRECEDING) THEN 1.0::DOUBLE ELSE 0 END AS above FROM timed),
n2 AS (SELECT *, abs(held - coalesce(lag(held) OVER ({W}), held)) AS turned, coalesce(lag(above) OVER ({W}), 0) AS kept FROM n1),
net AS (SELECT *, held * x - turned * 0.0005 AS net, kept * x - abs(kept - coalesce(lag(kept) OVER ({W}), kept)) * 0.0005 AS ma FROM n2)"""


_NET = _net_sql()


def _fall_sql(x, part):
    w = f"PARTITION BY {part} ORDER BY d ROWS UNBOUNDED PRECEDING"
    return f"SELECT {part}, min(c / hi - 1) AS mdd FROM (SELECT *, max(c) OVER ({w}) AS hi FROM (SELECT {part}, d, product(1 + {x}) OVER ({w}) AS c FROM halves)) GROUP BY {part}"


_HALVES = "halves AS (SELECT *, pos >= floor(0.6 * n) AS later FROM net)"


def _halves(spark, d):
    return _net(spark, d).withColumn("later", F.col("pos") >= F.floor(F.lit(0.6) * F.col("n")))


def _falls(df, x, name):
    """Deepest fall of the curve of ``x`` in each part."""
    w = Window.partitionBy("series_id", "later").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    curve = df.select("series_id", "later", "d", F.product(1 + F.col(x)).over(w).alias("c"))
    return curve.withColumn("fall", F.col("c") / F.max("c").over(w) - 1).groupBy("series_id", "later").agg(F.min("fall").alias(name))


@query(
    "timing_halves",
    f"""WITH {RANKED}, {_TIMED}, {_NET}, {_HALVES}, f1 AS ({_fall_sql('net', 'series_id, later')}), f2 AS ({_fall_sql('x', 'series_id, later')}),
a AS (SELECT series_id, later, pow(product(1 + net), 252.0::DOUBLE / count(*)) - 1 AS a1, pow(product(1 + x), 252.0::DOUBLE / count(*)) - 1 AS a2, {_sharpe_sql('net')} AS s1, {_sharpe_sql('x')} AS s2, count(*) FILTER (WHERE turned > 0) AS turns FROM halves GROUP BY 1, 2)
SELECT series_id, later, round(a1, 6) AS timed_annual, round(a2, 6) AS held_annual, round(s1, 6) AS timed_sharpe, round(s2, 6) AS held_sharpe, round(f1.mdd, 6) AS timed_mdd, round(f2.mdd, 6) AS held_mdd, turns
FROM a JOIN f1 USING (series_id, later) JOIN f2 USING (series_id, later)""",
)
def _(spark, d):
    """Timing against holding in the first 60 % of each series and after."""
    h = _halves(spark, d)
    annual = lambda x: F.round(F.pow(F.product(1 + F.col(x)), F.lit(252.0) / F.count("*")) - 1, 6)
    ratio = lambda x: F.round(T.sharpe(F.col(x)), 6)
    a = h.groupBy("series_id", "later").agg(
        annual("net").alias("timed_annual"), annual("x").alias("held_annual"), ratio("net").alias("timed_sharpe"), ratio("x").alias("held_sharpe"), F.count_if(F.col("turned") > 0).alias("turns")
    )
    both = a.join(_falls(h, "net", "timed_mdd"), ["series_id", "later"]).join(_falls(h, "x", "held_mdd"), ["series_id", "later"])
    return both.withColumns({c: F.round(c, 6) for c in ("timed_mdd", "held_mdd")})


_GATES = f"""gs AS (SELECT series_id, s.k, round({_sharpe_sql('net')} - {_sharpe_sql('x')}, 9) AS gain FROM net JOIN range(5) s(k) ON pos BETWEEN least(n * k // 5, n - 1) AND least(n * (k + 1) // 5, n - 1) GROUP BY 1, 2),
wf AS (SELECT series_id, count(*) FILTER (WHERE gain > 0) AS wins FROM gs GROUP BY 1),
ho AS (SELECT series_id, round({_sharpe_sql('net')}, 9) AS sn, round({_sharpe_sql('x')}, 9) AS sx, round({_sharpe_sql('ma')}, 9) AS sm FROM halves WHERE later GROUP BY 1),
f1 AS ({_fall_sql('net', 'series_id, later')}), f2 AS ({_fall_sql('x', 'series_id, later')})"""


@query(
    "four_gates",
    f"""WITH {RANKED}, {_TIMED}, {_SHIFTED}, {_NET}, {_HALVES}, {_GATES}
SELECT own.series_id, wins, round(p, 6) AS p, coalesce(sn > sx AND sn > sm AND f1.mdd > f2.mdd, false) AS beats, coalesce(wins >= 4 AND p < 0.1 AND sn > sx AND sn > sm AND f1.mdd > f2.mdd, false) AS alive
FROM own LEFT JOIN ps USING (series_id) LEFT JOIN wf USING (series_id) LEFT JOIN ho USING (series_id) LEFT JOIN f1 ON f1.series_id = own.series_id AND f1.later LEFT JOIN f2 ON f2.series_id = own.series_id AND f2.later""",
)
def _(spark, d):
    """A signal lives if it gains in four of five parts, by more than shifted weights, and later than 60 % beats holding and an average."""
    net, h = _net(spark, d), _halves(spark, d)
    gain = F.round(T.sharpe(F.col("net")) - T.sharpe(F.col("x")), 9)
    parts = E.segments(net.drop("pos"), 5).groupBy("series_id", "segment").agg(gain.alias("gain"))
    wf = parts.groupBy("series_id").agg(F.count_if(F.col("gain") > 0).alias("wins"))
    ratio = lambda x: F.round(T.sharpe(F.col(x)), 9)
    late = h.where("later").groupBy("series_id").agg(ratio("net").alias("sn"), ratio("x").alias("sx"), ratio("ma").alias("sm"))
    falls = _falls(h, "net", "f1").join(_falls(h, "x", "f2"), ["series_id", "later"]).where("later").drop("later")
    joined = reduce(lambda a, b: a.join(b, "series_id", "left"), [T.sharpe_shift_p(_timed(spark, d), "series_id", DRAWS), wf, late, falls])
    beats = F.coalesce(F.expr("sn > sx AND sn > sm AND f1 > f2"), F.lit(False))
    alive = F.coalesce(F.expr("wins >= 4 AND p < 0.1"), F.lit(False)) & beats
    return joined.select("series_id", "wins", "p", beats.alias("beats"), alive.alias("alive"))


def _gate_signals(spark, d):
    """The four rules: fall and reclaim; panic alone; panic, exhaustion and reclaim; those with a fall."""
    w = S.by_date()
    r = E.cross_up(ranked(spark, d).withColumn("panic", F.coalesce(F.col("rank") >= 85, F.lit(False))), 10)
    r = r.withColumn("fall", F.col("v") / S.gated(F.max("v"), 60) - 1).withColumn("ma5", S.gated(F.avg("v"), 5))
    exhaust = (F.col("ma5") < F.lag("ma5", 3).over(w)) & (F.lag("rank", 3).over(w) >= 85)
    fallen = F.coalesce(S.gated(F.min("fall"), 20, over="fall") <= -0.05, F.lit(False))
    r = r.withColumn("ex", exhaust).withColumn("fallen", fallen).withColumn("tried", E.ever_in_last(F.col("panic"), 10) & E.ever_in_last(F.col("ex"), 10) & F.col("cross"))
    r = r.withColumn("pos", F.row_number().over(w))
    return r, {"A": F.col("cross") & F.col("fallen"), "B": F.col("panic"), "C": F.col("tried"), "D": F.col("tried") & F.col("fallen")}


_BG = f"""b1 AS (SELECT *, row_number() OVER ({W}) AS pos, coalesce(rank >= 85, false) AS panic, CASE WHEN count(v) OVER ({W} ROWS 9 PRECEDING) = 10 THEN avg(v) OVER ({W} ROWS 9 PRECEDING) END AS ma10,
CASE WHEN count(v) OVER ({W} ROWS 59 PRECEDING) = 60 THEN v / max(v) OVER ({W} ROWS 59 PRECEDING) - 1 END AS fall, CASE WHEN count(v) OVER ({W} ROWS 4 PRECEDING) = 5 THEN avg(v) OVER ({W} ROWS 4 PRECEDING) END AS ma5 FROM ranked),
b2 AS (SELECT *, coalesce(v > ma10 AND lag(v) OVER ({W}) <= lag(ma10) OVER ({W}), false) AS cr, coalesce(ma5 < lag(ma5, 3) OVER ({W}) AND lag(rank, 3) OVER ({W}) >= 85, false) AS ex,
coalesce(CASE WHEN count(fall) OVER ({W} ROWS 19 PRECEDING) = 20 THEN min(fall) OVER ({W} ROWS 19 PRECEDING) END <= -0.05, false) AS fallen FROM b1),
b3 AS (SELECT *, bool_or(panic) OVER ({W} ROWS 9 PRECEDING) AND bool_or(ex) OVER ({W} ROWS 9 PRECEDING) AND cr AS tried FROM b2),
sig AS (SELECT series_id, 'A' AS gate, pos FROM b3 WHERE cr AND fallen UNION ALL SELECT series_id, 'B', pos FROM b3 WHERE panic UNION ALL SELECT series_id, 'C', pos FROM b3 WHERE tried UNION ALL SELECT series_id, 'D', pos FROM b3 WHERE tried AND fallen),
chain AS (SELECT series_id, gate, min(pos) AS pos FROM sig GROUP BY 1, 2 UNION ALL SELECT c.series_id, c.gate, (SELECT min(e.pos) FROM sig e WHERE e.series_id = c.series_id AND e.gate = c.gate AND e.pos >= c.pos + 11) AS pos FROM chain c WHERE c.pos IS NOT NULL),
hv AS (SELECT series_id, pos, v, list(v) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING) AS h, count(*) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS b,
list(v) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 60 FOLLOWING) AS f FROM b3),
dp AS (SELECT c.series_id, c.gate, c.pos, min(x.v / x.hi - 1) AS deep FROM (SELECT c.series_id, c.gate, c.pos, p.v, max(p.v) OVER (PARTITION BY c.series_id, c.gate, c.pos ORDER BY p.pos) AS hi FROM chain c JOIN b3 p ON p.series_id = c.series_id AND p.pos BETWEEN c.pos AND c.pos + 60) x
JOIN chain c USING (series_id, gate, pos) GROUP BY 1, 2, 3),
jd AS (SELECT c.series_id, c.gate, b + 1 - list_position(h, list_min(h)) AS lag, list_min(f) / v - 1 AS mae, list_max(f[1:21]) / v - 1 AS mfe, f[21] / v - 1 AS r20, f[61] / v - 1 AS r60, deep < -0.05 AS deep
FROM chain c JOIN hv USING (series_id, pos) JOIN dp USING (series_id, gate, pos) WHERE len(f) = 61)"""


@query(
    "bottom_gate",
    f"""WITH RECURSIVE {RANKED}, {_BG} SELECT gate, count(*) AS n, round(avg(CASE WHEN abs(lag) <= 5 THEN 1.0::DOUBLE ELSE 0 END), 6) AS tier1, round(avg(CASE WHEN mfe > 0.07 AND mae >= -0.05 THEN 1.0::DOUBLE ELSE 0 END), 6) AS tier2,
round(avg(CASE WHEN r60 > 0.1 AND NOT deep THEN 1.0::DOUBLE ELSE 0 END), 6) AS tier3, median(lag) AS lag, round(median(mae), 6) AS mae, round(median(mfe), 6) AS mfe, round(median(r20), 6) AS r20, round(median(r60), 6) AS r60 FROM jd GROUP BY 1""",
)
def _(spark, d):
    """How the signals of four rules for a low did, over all series; signals within ten rows of the last kept one are left out."""
    r, gates = _gate_signals(spark, d)
    chosen = lambda g: E.spaced(r.where(gates[g]).select("series_id", "pos"), "pos", 11).select("series_id", "pos", F.lit(g).alias("gate"))
    picked = reduce(lambda a, b: a.unionByName(b), map(chosen, gates)).groupBy("series_id", "pos").agg(F.collect_set("gate").alias("gates"))
    marked = r.select("series_id", "d", "v", "pos").join(picked, ["series_id", "pos"], "left")
    return E.signal_quality(marked, "gates", "gate")


# the record of a market


_ANALOGS = f"""ch AS (SELECT series_id, min(pos) AS pos FROM eps GROUP BY 1 UNION ALL SELECT c.series_id, (SELECT min(e.pos) FROM eps e WHERE e.series_id = c.series_id AND e.pos >= c.pos + 21) AS pos FROM ch c WHERE c.pos IS NOT NULL),
al AS (SELECT *, row_number() OVER ({W}) AS pos, CASE WHEN count(v) OVER ({W} ROWS 59 PRECEDING) = 60 THEN v / max(v) OVER ({W} ROWS 59 PRECEDING) - 1 END AS dd,
{', '.join(f'lead(v, {h}) OVER ({W}) / v - 1 AS f{h}' for h in HORIZONS)}, CASE WHEN lead(v, 1) OVER ({W}) IS NOT NULL THEN min(v) OVER ({W} ROWS BETWEEN CURRENT ROW AND 21 FOLLOWING) / v - 1 END AS mae FROM ranked),
an AS (SELECT al.* FROM al JOIN ch USING (series_id, pos))"""


def _analogs(spark, d):
    starts = E.spaced(fear_episodes(spark, d), "pos", 21).select("series_id", F.col("start").alias("d"))
    w = S.by_date()
    r = ranked(spark, d).withColumn("dd", F.col("v") / S.gated(F.max("v"), 60) - 1)
    for h in HORIZONS:
        r = r.withColumn(f"f{h}", E.forward_return(h))
    # the last starts are judged on the rows there are
    r = r.withColumn("mae", F.when(F.lead("v").over(w).isNotNull(), F.min("v").over(w.rowsBetween(0, 21)) / F.col("v") - 1))
    return r.join(starts, ["series_id", "d"], "left_semi")


_PCT = ["dd", *(f"f{h}" for h in HORIZONS), "mae"]


@query("market_analogs", f"WITH RECURSIVE {RANKED}, {_EPISODES}, {_ANALOGS} SELECT series_id, d, round(rank, 4) AS rank, {', '.join(f'round({c}, 6) AS {c}' for c in _PCT)} FROM an")
def _(spark, d):
    """Earlier starts of low episodes: the rank, the fall from the 60-row high, returns over each horizon, the worst within 21 rows."""
    return _analogs(spark, d).select("series_id", "d", F.round("rank", 4).alias("rank"), *(F.round(c, 6).alias(c) for c in _PCT))


_POINTS = (0.1, 0.25, 0.5, 0.75, 0.9)


@query("market_baseline", f"WITH {RANKED}, ahead AS ({_AHEAD}) SELECT series_id, h, {', '.join(f'round(quantile_cont(r, {p}) * 100, 4) AS p{round(p * 100)}' for p in _POINTS)} FROM ahead GROUP BY 1, 2")
def _(spark, d):
    q = F.percentile("r", F.array(*map(F.lit, _POINTS)))
    got = _every_horizon(panel(spark, d)).groupBy("series_id", "h").agg(q.alias("q"))
    return got.select("series_id", "h", *(F.round(F.col("q")[i] * 100, 4).alias(f"p{round(p * 100)}") for i, p in enumerate(_POINTS)))


_FIFTHS = f"""fv AS (SELECT *, pos // greatest(n // 5, 1) AS k FROM net), fi AS (SELECT * FROM fv WHERE k < 5 AND pos < n - 1),
dr AS (SELECT series_id, k, count(*) AS rows_, min(c1 / h1 - 1) AS f1, min(c2 / h2 - 1) AS f2 FROM (SELECT *, max(c1) OVER o AS h1, max(c2) OVER o AS h2 FROM
(SELECT series_id, k, d, product(1 + net) OVER o AS c1, product(1 + x) OVER o AS c2 FROM fi WINDOW o AS (PARTITION BY series_id, k ORDER BY d ROWS UNBOUNDED PRECEDING))
WINDOW o AS (PARTITION BY series_id, k ORDER BY d ROWS UNBOUNDED PRECEDING)) GROUP BY 1, 2),
ds AS (SELECT series_id, count(*) AS parts, count(*) FILTER (WHERE round((f1 - f2) * 100, 6) > 0.5) AS derisked FROM dr WHERE rows_ >= 20 GROUP BY 1)"""


@query(
    "market_record",
    f"""WITH RECURSIVE {RANKED}, {_EPISODES}, {_ANALOGS}, {_TIMED}, {_net_sql(1.0)}, {_FIFTHS},
la AS (SELECT series_id, max(d) AS last_d, arg_max(round(rank, 4), d) AS rank, arg_max(round(dd, 6), d) AS dd60, count(*) FILTER (WHERE rank IS NULL) AS warmup FROM al GROUP BY 1),
na AS (SELECT series_id, count(*) AS n, round(median(mae), 6) AS mae_median FROM an GROUP BY 1)
SELECT series_id, last_d, rank, dd60, warmup, greatest(date_diff('day', last_d, DATE '2001-10-15'), 0) AS stale_days, coalesce(n, 0) AS n, mae_median, coalesce(parts, 0) AS parts, coalesce(derisked, 0) AS derisked
FROM la LEFT JOIN na USING (series_id) LEFT JOIN ds USING (series_id)""",
)
def _(spark, d):
    """Where each series stands, how its earlier starts went, and in how many fifths timing fell less deep than holding."""
    r = ranked(spark, d).withColumn("dd", F.col("v") / S.gated(F.max("v"), 60) - 1)
    latest = lambda c, n: F.max_by(F.round(c, n), "d")
    la = r.groupBy("series_id").agg(F.max("d").alias("last_d"), latest("rank", 4).alias("rank"), latest("dd", 6).alias("dd60"), F.count_if(F.col("rank").isNull()).alias("warmup"))
    na = _analogs(spark, d).groupBy("series_id").agg(F.count("*").alias("n"), F.round(F.median("mae"), 6).alias("mae_median"))
    fifth = F.floor(F.col("pos") / F.greatest(F.floor(F.col("n") / 5), F.lit(1)))
    fifths = _net(spark, d, 1.0).withColumn("later", fifth).where("later < 5 AND pos < n - 1")
    sizes = fifths.groupBy("series_id", "later").agg(F.count("*").alias("size")).where("size >= 20")
    falls = sizes.join(_falls(fifths, "net", "f1"), ["series_id", "later"]).join(_falls(fifths, "x", "f2"), ["series_id", "later"])
    ds = falls.groupBy("series_id").agg(F.count("*").alias("parts"), F.count_if(F.round((F.col("f1") - F.col("f2")) * 100, 6) > 0.5).alias("derisked"))
    stale = F.greatest(F.datediff(F.lit("2001-10-15").cast("date"), "last_d"), F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return la.join(na, "series_id", "left").join(ds, "series_id", "left").select(
        "series_id", "last_d", "rank", "dd60", "warmup", stale.alias("stale_days"), zero("n"), "mae_median", zero("parts"), zero("derisked")
    )


_WEIGHT_DRAWS = 300
_DRAWN = f"-ln(({T.DRAW_SQL.format(b='b', k='CAST(left(series_id, 1) AS BIGINT)', seed=5, n='1000003')} + 1) / 1000004::DOUBLE)"


@query(
    "random_weights",
    f"""WITH {RANKED}, wg AS (SELECT series_id, b, CASE WHEN b < 0 THEN 1.0::DOUBLE ELSE {_DRAWN} END AS w FROM (SELECT DISTINCT series_id FROM ranked), range(-1, {_WEIGHT_DRAWS}) u(b)),
wn AS (SELECT series_id, b, w / sum(w) OVER (PARTITION BY b) AS w FROM wg),
co AS (SELECT b, d, round(sum(w * rank), 6) AS c FROM ranked JOIN wn USING (series_id) WHERE rank IS NOT NULL GROUP BY 1, 2),
rk AS (SELECT b, d, CASE WHEN len(h) = 60 THEN 100.0::DOUBLE * len(list_filter(h, lambda y: y < c)) / 59 END AS rk FROM (SELECT *, list(c) OVER (PARTITION BY b ORDER BY d ROWS 59 PRECEDING) AS h FROM co)),
px AS (SELECT d, round(avg(v), 4) AS v FROM panel GROUP BY 1), pr AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS pos, count(*) OVER () AS n, coalesce((v / nullif(lag(v) OVER (ORDER BY d), 0) - 1) / 100, 0) AS x FROM px),
ps AS (SELECT b, pr.d, pos, n, x, CASE WHEN rk <= 10 THEN 1.0::DOUBLE WHEN rk >= 90 THEN 0.5 ELSE 0.75 END AS w FROM pr CROSS JOIN range(-1, {_WEIGHT_DRAWS}) u(b) LEFT JOIN rk USING (b, d)),
hd AS (SELECT *, coalesce(lag(w) OVER (PARTITION BY b ORDER BY d), 0.75) AS held FROM ps),
nt AS (SELECT *, held * x - abs(held - coalesce(lag(held) OVER (PARTITION BY b ORDER BY d), held)) * 0.0005 AS net FROM hd),
s AS (SELECT b, round({_sharpe_sql('net')}, 9) AS s FROM nt WHERE pos >= floor(0.6 * n) GROUP BY 1), e AS (SELECT s AS own FROM s WHERE b < 0)
SELECT round(any_value(own), 6) AS equal, round(median(s), 6) AS middle, round(avg(CASE WHEN s < own THEN 1.0::DOUBLE ELSE 0 END), 6) AS below, avg(CASE WHEN s < own THEN 1.0::DOUBLE ELSE 0 END) >= 0.9 AS holds FROM s, e WHERE b >= 0 AND s IS NOT NULL""",
)
def _(spark, d):
    """Where equal weights of the parts stand among random ones, by the Sharpe ratio of the later 40 % of days.

    Weights are exponential draws scaled to one. A draw is a key of every window, so draws spread over tasks.
    """
    r = ranked(spark, d).where("rank IS NOT NULL").select("series_id", "d", "rank")
    b = F.explode(F.sequence(F.lit(-1), F.lit(_WEIGHT_DRAWS - 1)))
    drawn = T.draw(5, F.col("b").cast("long"), F.left("series_id", F.lit(1)).cast("long"), F.lit(1000003))
    weight = F.when(F.col("b") < 0, 1.0).otherwise(-F.ln((drawn + 1) / F.lit(1000004.0)))
    parts = ranked(spark, d).select("series_id").distinct().withColumn("b", b).withColumn("w", weight)
    parts = parts.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy("b")))
    c = r.join(parts, "series_id").groupBy(F.col("b").alias("series_id"), "d").agg(F.round(F.sum(F.col("w") * F.col("rank")), 6).alias("v"))
    rk = S.trailing_rank(c, 60).select("series_id", "d", "rank")
    px = panel(spark, d).groupBy("d").agg(F.round(F.avg("v"), 4).alias("v")).withColumn("series_id", b)
    whole = Window.partitionBy("series_id")
    ret = F.coalesce(S.lag_return() / 100, F.lit(0.0))
    days = px.select("series_id", "d", "v", (F.row_number().over(S.by_date()) - 1).alias("pos"), F.count("*").over(whole).alias("n"), ret.alias("x"))
    w = F.when(F.col("rank") <= 10, 1.0).when(F.col("rank") >= 90, 0.5).otherwise(0.75)
    held = F.coalesce(F.lag("w").over(S.by_date()), F.lit(0.75))
    run = days.join(rk, ["series_id", "d"], "left").withColumn("w", w).withColumn("held", held)
    turned = F.abs(F.col("held") - F.coalesce(F.lag("held").over(S.by_date()), F.col("held")))
    late = run.withColumn("net", F.col("held") * F.col("x") - turned * 0.0005).where(F.col("pos") >= F.floor(F.lit(0.6) * F.col("n")))
    s = late.groupBy("series_id").agg(F.round(T.sharpe(F.col("net")), 9).alias("s"))
    own = s.where("series_id < 0").select(F.col("s").alias("own"))
    below = F.avg((F.col("s") < F.col("own")).cast("double"))
    return s.where("series_id >= 0 AND s IS NOT NULL").join(F.broadcast(own)).agg(
        F.round(F.any_value("own"), 6).alias("equal"), F.round(F.median("s"), 6).alias("middle"), F.round(below, 6).alias("below"), (below >= 0.9).alias("holds")
    )
