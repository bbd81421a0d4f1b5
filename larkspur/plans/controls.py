"""Queries that hold a signal against controls: matched thresholds, arms without the signal, the power of a test, parts of a ratio."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import events as E
from larkspur.operators import series as S
from larkspur.operators import stats as T
from larkspur.plans.events import FISHER, W, ranked
from larkspur.plans.inputs import PANEL, RANKED, panel, table
from larkspur.plans.verdicts import _BG, _TIMED, HORIZONS, _every_horizon, _gate_signals, _sharpe_sql, _timed

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


# more choice or more fear: the rule with the signal against deeper falls without it

THRESHOLDS = (0.05, 0.09, 0.13, 0.2)
#: The gain that a larger sample should show, and the sizes that are tried.
GAIN, LEVEL, SIZES = 0.07, 0.1, range(20, 4000, 10)
_LOW = "CASE WHEN count(fall) OVER ({0} ROWS 19 PRECEDING) = 20 THEN min(fall) OVER ({0} ROWS 19 PRECEDING) END".format(W)
_SIG = " UNION ALL ".join([f"SELECT series_id, '{t}' AS gate, pos FROM b3 WHERE cr AND low20 <= -{t}::DOUBLE" for t in THRESHOLDS] + ["SELECT series_id, 'D', pos FROM b3 WHERE tried AND fallen"])
_MATCHED = _BG[: _BG.index("sig AS (")].replace(" AS fallen FROM b1)", f" AS fallen, {_LOW} AS low20 FROM b1)") + f"sig AS ({_SIG}),\n" + _BG[_BG.index("chain AS (") :]


@query(
    "matched_control",
    f"""WITH RECURSIVE {RANKED}, {_MATCHED}, q AS (SELECT gate, count(*) AS n, round_even(round(avg(CASE WHEN mfe > 0.07 AND mae >= -0.05 THEN 1.0::DOUBLE ELSE 0 END), 6) * count(*), 0)::BIGINT AS hits FROM jd GROUP BY 1),
dd AS (SELECT n AS dn, hits AS dh FROM q WHERE gate = 'D'), al AS (SELECT gate::DOUBLE AS threshold, n, hits, dn, dh, row_number() OVER (ORDER BY abs(n - dn), gate::DOUBLE) = 1 AS chosen FROM q, dd WHERE gate <> 'D'),
sz AS (SELECT threshold, hits::DOUBLE / n AS base, unnest(range(20, 4000, 10)) AS size FROM al),
tb AS (SELECT threshold, 0 AS size, dh AS a, dn - dh AS b, hits AS c, n - hits AS d FROM al UNION ALL
SELECT threshold, size, least(size, round_even((base + {GAIN}::DOUBLE) * size, 0))::BIGINT, size - least(size, round_even((base + {GAIN}::DOUBLE) * size, 0))::BIGINT, round_even(base * size, 0)::BIGINT, size - round_even(base * size, 0)::BIGINT FROM sz), {FISHER},
p AS (SELECT threshold, size, least(1, sum(exp(li)) FILTER (WHERE li <= la + 1e-7)) AS p FROM lg GROUP BY 1, 2)
SELECT al.threshold, n, hits, dn AS signals, dh AS signal_hits, chosen, round(any_value(p) FILTER (WHERE size = 0), 6) AS p, min(size) FILTER (WHERE size > 0 AND p < {LEVEL}) AS needed FROM al JOIN p USING (threshold) GROUP BY ALL""",
)
def _(spark, d):
    """Falls and reclaims without the signal, by threshold: hits, which threshold fires about as often as the rule with the signal, Fisher's p of
    the two, and from what size on a gain of seven points would be seen."""
    r, gates = _gate_signals(spark, d)
    r = r.withColumn("low20", S.gated(F.min("fall"), 20, over="fall"))
    rules = {str(t): F.col("cross") & F.coalesce(F.col("low20") <= -t, F.lit(False)) for t in THRESHOLDS} | {"D": gates["D"]}
    chosen = lambda g: E.spaced(r.where(rules[g]).select("series_id", "pos"), "pos", 11).select("series_id", "pos", F.lit(g).alias("gate"))
    picked = reduce(lambda a, b: a.unionByName(b), map(chosen, rules)).groupBy("series_id", "pos").agg(F.collect_set("gate").alias("gates"))
    q = E.signal_quality(r.select("series_id", "d", "v", "pos").join(picked, ["series_id", "pos"], "left"), "gates", "gate")
    q = q.select("gate", "n", F.rint(F.col("tier2") * F.col("n")).cast("long").alias("hits"))
    own = q.where("gate = 'D'").select(F.col("n").alias("signals"), F.col("hits").alias("signal_hits"))
    both = q.where("gate <> 'D'").join(F.broadcast(own)).withColumn("threshold", F.col("gate").cast("double"))
    nearest = Window.orderBy(F.abs(F.col("n") - F.col("signals")), "threshold")
    both = both.withColumn("chosen", F.row_number().over(nearest) == 1)
    p = T.fisher_p(F.col("signal_hits"), F.col("signals") - F.col("signal_hits"), F.col("hits"), F.col("n") - F.col("hits"))
    size = F.col("size")
    share = F.col("hits") / F.col("n")
    more, less = F.least(size, F.rint((share + GAIN) * size).cast("long")), F.rint(share * size).cast("long")
    tried = both.withColumn("size", F.explode(F.sequence(F.lit(SIZES.start).cast("long"), F.lit(SIZES.stop - 1).cast("long"), F.lit(SIZES.step).cast("long"))))
    seen = tried.withColumn("q", T.fisher_p(more, size - more, less, size - less)).where(F.col("q") < LEVEL).groupBy("threshold").agg(F.min("size").alias("needed"))
    columns = ["threshold", "n", "hits", "signals", "signal_hits", "chosen"]
    return both.select(*columns, F.round(p, 6).alias("p")).join(seen, "threshold", "left").select(*columns, "p", "needed")


# arms without the signal

_ARMS = {"hold": None, "average": "wb", "setup": "wc", "setup_average": "wd"}
_LATE = "pos >= floor(0.6 * n)"


def _arm_sql(arm, w):
    if w is None:
        return f"SELECT series_id, '{arm}' AS arm, d, pos, n, x AS net, 0 AS turn FROM a2"
    held = f"coalesce(lag({w}) OVER ({W}), 0.75)"
    return f"SELECT series_id, '{arm}' AS arm, d, pos, n, held * x - coalesce(abs(held - lag(held) OVER ({W})), 0) * 0.0005 AS net, ({w} <> lag({w}) OVER ({W}))::INT AS turn FROM (SELECT *, {held} AS held FROM a2)"


@query(
    "control_arms",
    f"""WITH {RANKED}, {_TIMED}, a1 AS (SELECT t.*, CASE WHEN count(t.v) OVER (PARTITION BY t.series_id ORDER BY t.d ROWS 19 PRECEDING) = 20 THEN avg(t.v) OVER (PARTITION BY t.series_id ORDER BY t.d ROWS 19 PRECEDING) END AS ma,
coalesce(rank <= 10, false) AS lo, coalesce(rank >= 90, false) AS hi FROM timed t JOIN ranked r ON r.series_id = t.series_id AND r.d = t.d),
a2 AS (SELECT *, CASE WHEN v > ma THEN 1.0 WHEN v < ma THEN 0.5 ELSE 0.75 END AS wb, CASE WHEN ls AND NOT lo THEN 1.0 WHEN hs AND NOT hi THEN 0.5 ELSE 0.75 END AS wc, CASE WHEN ls AND NOT lo AND v > ma THEN 1.0 WHEN hs AND NOT hi AND v < ma THEN 0.5 ELSE 0.75 END AS wd
FROM (SELECT *, bool_or(lo) OVER ({W} ROWS 19 PRECEDING) AS ls, bool_or(hi) OVER ({W} ROWS 19 PRECEDING) AS hs FROM a1)),
ar AS ({' UNION ALL '.join(_arm_sql(a, w) for a, w in _ARMS.items())}),
tu AS (SELECT series_id, arm, CAST(coalesce(sum(turn), 0) AS BIGINT) AS turns FROM ar GROUP BY 1, 2),
cu AS (SELECT series_id, arm, d, net, product(1 + net) OVER (PARTITION BY series_id, arm ORDER BY d ROWS UNBOUNDED PRECEDING) AS c FROM ar WHERE {_LATE}),
fa AS (SELECT *, c / max(c) OVER (PARTITION BY series_id, arm ORDER BY d ROWS UNBOUNDED PRECEDING) - 1 AS fall FROM cu)
SELECT series_id, arm, round({_sharpe_sql('net')}, 6) AS sharpe, round(pow(product(1 + net), 252.0::DOUBLE / count(*)) - 1, 6) AS annual, round(min(fall), 6) AS deepest, any_value(turns) AS turns FROM fa JOIN tu USING (series_id, arm) GROUP BY 1, 2""",
)
def _(spark, d):
    """Holding, an average alone, the setup alone, and both, over the later 40 % of days: is it the signal or the average?"""
    w = S.by_date()
    rank = F.col("rank")
    a = _timed(spark, d).join(ranked(spark, d).select("series_id", "d", "rank"), ["series_id", "d"])
    a = a.withColumn("ma", S.gated(F.avg("v"), 20)).withColumn("lo", F.coalesce(rank <= 10, F.lit(False))).withColumn("hi", F.coalesce(rank >= 90, F.lit(False)))
    a = a.withColumn("ls", E.ever_in_last(F.col("lo"), 20)).withColumn("hs", E.ever_in_last(F.col("hi"), 20))
    up, down = F.col("v") > F.col("ma"), F.col("v") < F.col("ma")
    calm, dear = F.col("ls") & ~F.col("lo"), F.col("hs") & ~F.col("hi")
    weight = lambda one, half: F.when(one, 1.0).when(half, 0.5).otherwise(0.75)
    arms = {"hold": None, "average": weight(up, down), "setup": weight(calm, dear), "setup_average": weight(calm & up, dear & down)}

    def run(arm, chosen):
        if chosen is None:
            return a.select("series_id", F.lit(arm).alias("arm"), "d", "pos", "n", F.col("x").alias("net"), F.lit(0).alias("turn"))
        held = a.withColumn("w", chosen).withColumn("held", F.coalesce(F.lag("w").over(w), F.lit(0.75)))
        cost = F.coalesce(F.abs(F.col("held") - F.lag("held").over(w)), F.lit(0.0)) * 0.0005
        turn = F.coalesce((F.col("w") != F.lag("w").over(w)).cast("int"), F.lit(0))
        return held.select("series_id", F.lit(arm).alias("arm"), "d", "pos", "n", (F.col("held") * F.col("x") - cost).alias("net"), turn.alias("turn"))

    every = reduce(lambda p, q: p.unionByName(q), (run(*x) for x in arms.items()))
    turns = every.groupBy("series_id", "arm").agg(F.sum("turn").cast("long").alias("turns"))
    path = Window.partitionBy("series_id", "arm").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    late = every.where(F.col("pos") >= F.floor(F.lit(0.6) * F.col("n"))).withColumn("c", F.product(1 + F.col("net")).over(path))
    late = late.withColumn("fall", F.col("c") / F.max("c").over(path) - 1)
    yearly = F.pow(F.product(1 + F.col("net")), F.lit(252.0) / F.count("*")) - 1
    got = late.groupBy("series_id", "arm").agg(F.round(T.sharpe(F.col("net")), 6).alias("sharpe"), F.round(yearly, 6).alias("annual"), F.round(F.min("fall"), 6).alias("deepest"))
    return got.join(turns, ["series_id", "arm"])


# what a test could see

_SEEN = {5: 15, 21: 9, 63: 8}
_POWER_SIZES = ", ".join(f"({h}, {n})" for h, n in _SEEN.items())


def _power_sql() -> str:
    draw = T.DRAW_SQL.format(b="b", k="k", seed=1, n="size")
    z = "(abs(u - m * size / 2.0::DOUBLE) - 0.5) / nullif(sqrt(m * size / 12.0::DOUBLE * (m + size + 1 - (base_ties + more) / ((m + size) * (m + size - 1.0::DOUBLE)))), 0)"
    tail = "(" + " + ".join(f"{c}::DOUBLE * pow(1 / (1 + {T.TAIL_SCALE}::DOUBLE * abs(z)), {i + 1})" for i, c in enumerate(T.TAIL)) + ") * exp(-z * z / 2) / sqrt(2 * pi())"
    return f"""ah AS ({' UNION ALL '.join(f"SELECT series_id, {h} AS h, d, lead(v, {h}) OVER ({W}) / v - 1 AS v FROM panel" for h in HORIZONS)}),
ba AS (SELECT series_id, h, v, row_number() OVER (PARTITION BY series_id, h ORDER BY d) - 1 AS pos, count(*) OVER (PARTITION BY series_id, h) AS size FROM ah WHERE v IS NOT NULL),
ti AS (SELECT series_id, h, v, count(*) AS t FROM ba GROUP BY 1, 2, 3), ix AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY series_id, h ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below FROM ti),
bt AS (SELECT series_id, h, sum(t)::BIGINT AS size, sum(pow(t, 3) - t) AS base_ties FROM ti GROUP BY 1, 2),
dr AS (SELECT series_id, h, size, base_ties, m, b, {draw} AS pos FROM bt JOIN (VALUES {_POWER_SIZES}) s(h, m) USING (h), range(400) u(b), LATERAL (SELECT unnest(range(m)) AS k)),
dx AS (SELECT dr.*, s, v + s * 0.01::DOUBLE AS x FROM dr JOIN ba USING (series_id, h, pos), range(60) g(s)),
gx AS (SELECT series_id, h, size, base_ties, m, b, s, x, count(*) AS own FROM dx GROUP BY ALL),
lx AS (SELECT g.*, CASE WHEN i.v = g.x THEN i.t ELSE 0 END AS same, CASE WHEN i.v IS NULL THEN 0 WHEN i.v = g.x THEN i.below ELSE i.below + i.t END AS below FROM gx g ASOF LEFT JOIN ix i ON i.series_id = g.series_id AND i.h = g.h AND g.x >= i.v),
ux AS (SELECT series_id, h, size, base_ties, m, b, s, sum(own * (below + same / 2.0::DOUBLE)) AS u, sum((pow(same + own, 3) - (same + own)) - (pow(same, 3) - same)) AS more FROM lx GROUP BY ALL),
zx AS (SELECT *, {z} AS z FROM ux), px AS (SELECT series_id, h, m, s, avg(CASE WHEN z > 0 AND 2 * {tail} < 0.1 THEN 1.0::DOUBLE ELSE 0 END) AS p FROM zx GROUP BY 1, 2, 3, 4)"""


@query(
    "power_simulation",
    f"""WITH {PANEL}, {_power_sql()}, fi AS (SELECT series_id, h, min(s) AS s FROM px WHERE p >= 0.8 GROUP BY 1, 2)
SELECT b.series_id, b.h, max(b.m)::BIGINT AS n, round(any_value(fi.s) * 0.01::DOUBLE, 6) AS shift, max(b.p) FILTER (WHERE b.s = fi.s) AS power FROM px b LEFT JOIN fi USING (series_id, h) GROUP BY 1, 2""",
)
def _(spark, d):
    """How large an effect must be for a rank test of so many events to see it, for each series and horizon."""
    base = _every_horizon(panel(spark, d)).where("r IS NOT NULL")
    base = base.select("series_id", "h", "r", (F.row_number().over(Window.partitionBy("series_id", "h").orderBy("d")) - 1).alias("pos"))
    sizes = base.select("series_id", "h").distinct().join(F.broadcast(spark.createDataFrame(list(_SEEN.items()), "h int, n long")), "h")
    return T.detection_power(base, sizes, ["series_id", "h"], "r")


# the parts of a ratio

_PARTS = """pt AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS num, count(*)::DOUBLE AS den FROM orders GROUP BY 1, 2)"""


@query(
    "ratio_components",
    f"""WITH {_PARTS}, ra AS (SELECT *, round(num / den, 6) AS ratio FROM pt),
hs AS (SELECT *, {', '.join(f'list({c}) OVER ({W} ROWS 59 PRECEDING) AS h_{c}' for c in ('ratio', 'num', 'den'))}, {', '.join(f'round(({c} / lag({c}, 20) OVER ({W}) - 1) * 100, 4) AS {c}_change' for c in ('num', 'den'))} FROM ra),
rk AS (SELECT *, {', '.join(f'CASE WHEN len(h_{c}) = 60 THEN round(100.0::DOUBLE * len(list_filter(h_{c}, lambda y: y < {c})) / 59, 4) END AS {c}_rank' for c in ('ratio', 'num', 'den'))} FROM hs)
SELECT series_id, d, ratio_rank, num_rank, den_rank, num_change, den_change, coalesce(ratio_rank <= 10 AND num_rank >= 50, false) AS warned FROM rk""",
)
def _(spark, d):
    """Mean order prices as total over count: where the ratio is low although its numerator is not, the denominator has moved, and the day is marked."""
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("d")).agg(F.round(F.sum("o_totalprice"), 2).alias("num"), F.count("*").cast("double").alias("den"))
    o = o.withColumn("ratio", F.round(F.col("num") / F.col("den"), 6))
    change = lambda c: F.round((F.col(c) / F.lag(c, 20).over(S.by_date()) - 1) * 100, 4).alias(f"{c}_change")
    ranks = [S.trailing_rank(o.select("series_id", "d", F.col(c).alias("v")), 60).select("series_id", "d", F.round("rank", 4).alias(f"{c}_rank")) for c in ("ratio", "num", "den")]
    every = reduce(lambda p, q: p.join(q, ["series_id", "d"]), [o.select("series_id", "d", change("num"), change("den")), *ranks])
    warned = F.coalesce((F.col("ratio_rank") <= 10) & (F.col("num_rank") >= 50), F.lit(False))
    return every.select("series_id", "d", "ratio_rank", "num_rank", "den_rank", "num_change", "den_change", warned.alias("warned"))


# the gauntlet: every series, side and horizon in one table

_SIDES = "(VALUES ('low'), ('high')) sd(side)"
_GAUNTLET = f"""po AS (SELECT *, row_number() OVER ({W}) AS pos FROM ranked), fl AS (SELECT series_id, side, pos FROM po, {_SIDES} WHERE CASE side WHEN 'low' THEN rank <= 10 ELSE rank >= 90 END),
fe AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY series_id, side ORDER BY pos) AS k FROM (SELECT *, coalesce(pos - lag(pos) OVER (PARTITION BY series_id, side ORDER BY pos) > 4, true) AS fresh FROM fl)),
ep AS (SELECT series_id, side, min(pos) AS pos FROM fe GROUP BY series_id, side, k),
chain AS (SELECT series_id, side, h, min(pos) AS pos FROM ep, (VALUES {', '.join(f'({h})' for h in HORIZONS)}) hs(h) GROUP BY 1, 2, 3 UNION ALL
SELECT c.series_id, c.side, c.h, (SELECT min(e.pos) FROM ep e WHERE e.series_id = c.series_id AND e.side = c.side AND e.pos >= c.pos + c.h) AS pos FROM chain c WHERE c.pos IS NOT NULL),
ev AS (SELECT series_id, side, h, count(*) AS n_events FROM chain WHERE pos IS NOT NULL GROUP BY 1, 2, 3),
ah AS ({' UNION ALL '.join(f"SELECT series_id, {h} AS h, d, rank, lead(v, {h}) OVER ({W}) / v - 1 AS v FROM ranked" for h in HORIZONS)}),
ba AS (SELECT series_id, h, v, coalesce(rank <= 10, false) AS low, coalesce(rank >= 90, false) AS high, row_number() OVER (PARTITION BY series_id, h ORDER BY d) - 1 AS pos FROM ah WHERE v IS NOT NULL), sz AS (SELECT series_id, h, count(*) AS n FROM ba GROUP BY 1, 2),
xs AS (SELECT series_id, h, b, k, n, {T.DRAW_SQL.format(b='b', k='k', seed=0, n='n')} AS at_ FROM sz, range(800) t(b), LATERAL (SELECT unnest(range((n + h - 1) // h)) AS k)),
xp AS (SELECT series_id, h, b, (at_ + i) % n AS pos FROM (SELECT *, unnest(range(h)) AS i FROM xs) WHERE k * h + i < n),
xe AS (SELECT series_id, h, b, CASE WHEN count(*) FILTER (WHERE low) >= 3 THEN median(v) FILTER (WHERE low) - median(v) END AS low, CASE WHEN count(*) FILTER (WHERE high) >= 3 THEN median(v) FILTER (WHERE high) - median(v) END AS high FROM xp JOIN ba USING (series_id, h, pos) GROUP BY 1, 2, 3),
xl AS (SELECT series_id, h, side, count(e) AS k, quantile_cont(e, 0.05) AS lo, quantile_cont(e, 0.95) AS hi FROM (SELECT series_id, h, 'low' AS side, low AS e FROM xe UNION ALL SELECT series_id, h, 'high', high FROM xe) GROUP BY 1, 2, 3),
ow AS (SELECT series_id, h, side, CASE WHEN count(*) >= 3 * h AND count(*) FILTER (WHERE f) >= 3 THEN median(v) FILTER (WHERE f) - median(v) END AS point, count(*) AS n FROM (SELECT *, CASE side WHEN 'low' THEN low ELSE high END AS f FROM ba, {_SIDES}) GROUP BY 1, 2, 3),
zs AS (SELECT ow.*, coalesce(n_events, 0) AS n_events FROM ow LEFT JOIN ev USING (series_id, side, h)),
md AS (SELECT series_id, h, side, b, median(v) AS m FROM (SELECT series_id, h, side, b, {T.DRAW_SQL.format(b='b', k='k', seed=1, n='n')} AS pos FROM zs, range(4000) t(b), LATERAL (SELECT unnest(range(n_events)) AS k) WHERE n >= 50 AND n_events >= 3) JOIN ba USING (series_id, h, pos) GROUP BY 1, 2, 3, 4),
cr AS (SELECT series_id, h, side, quantile_cont(m, 0.95) AS crit FROM md GROUP BY 1, 2, 3), gr AS (SELECT series_id, h, side, s, avg(CASE WHEN m + s * 0.005::DOUBLE > crit THEN 1.0::DOUBLE ELSE 0 END) AS p FROM md JOIN cr USING (series_id, h, side), range(160) t(s) GROUP BY 1, 2, 3, 4),
mi AS (SELECT series_id, h, side, round(min(s) * 0.005::DOUBLE, 3) AS shift FROM gr WHERE p >= 0.8 GROUP BY 1, 2, 3),
al AS (SELECT series_id, side, h, n_events, round(point, 6) AS point, round(CASE WHEN point IS NOT NULL AND k >= 400 THEN lo END, 6) AS low, round(CASE WHEN point IS NOT NULL AND k >= 400 THEN hi END, 6) AS high, shift FROM zs JOIN xl USING (series_id, h, side) LEFT JOIN mi USING (series_id, h, side))"""


@query(
    "gauntlet",
    f"""WITH RECURSIVE {RANKED}, {_GAUNTLET} SELECT *, CASE WHEN n_events < 8 THEN 'too few' WHEN point IS NULL OR low IS NULL THEN 'unknown' WHEN low > 0 AND point >= 0.03 THEN 'pass'
WHEN shift IS NOT NULL AND abs(point) < shift AND low < 0 AND high > 0 THEN 'undetectable' WHEN high < 0 THEN 'reverse' ELSE 'fail' END AS verdict FROM al""",
)
def _(spark, d):
    """Effect, resampled interval, smallest detectable effect and verdict of every series, side and horizon.

    Ranks and returns are made once; the draws of a series and horizon serve both sides.
    """
    r = ranked(spark, d)
    rank = F.col("rank")
    base = _every_horizon(r).where("r IS NOT NULL").select(
        "series_id", "h", F.col("r").alias("v"), F.coalesce(rank <= 10, F.lit(False)).alias("low"), F.coalesce(rank >= 90, F.lit(False)).alias("high"),
        (F.row_number().over(Window.partitionBy("series_id", "h").orderBy("d")) - 1).cast("long").alias("pos"), F.col("h").alias("block"),
    )
    effects = T.resampled_effects(base, ["series_id", "h"], ["low", "high"], "v", "block")
    sides = {"low": E.episodes(r, rank <= 10, 3), "high": E.episodes(r, rank >= 90, 3)}
    spaced = [E.spaced(eps, "pos", h).select("series_id", F.lit(s).alias("side"), F.lit(h).alias("h")) for s, eps in sides.items() for h in HORIZONS]
    events = reduce(lambda p, q: p.unionByName(q), spaced).groupBy("series_id", "side", "h").agg(F.count("*").alias("n_events"))
    key = F.concat_ws("|", "series_id", "side", "h").alias("key")
    names = base.select("series_id", "h").distinct().withColumn("side", F.explode(F.array(F.lit("low"), F.lit("high"))))
    values = base.select("series_id", "h", "pos", "v").join(names, ["series_id", "h"]).select(key, "pos", "v")
    seen = T.min_detectable(values, events.select(key, "n_events"), "key", "v").select("key", "n_events", "shift")
    every = effects.withColumn("key", F.concat_ws("|", "series_id", "side", "h")).join(seen, "key").drop("key")
    point, low, high, shift, n = (F.col(c) for c in ("point", "low", "high", "shift", "n_events"))
    return every.select("series_id", "side", "h", "n_events", "point", "low", "high", "shift", T.verdict(point, low, high, shift, 0.03, n).alias("verdict"))
