"""Rank tests, exact tests and resampling over groups.

Random draws come from integer arithmetic on (seed, draw, position), so any engine that
multiplies integers gives the same ones. Exact tests work on one row of counts per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: int, b: Column, k: Column, n: Column) -> Column:
    """A pseudo-random integer from 0 to n-1 for draw b at position k."""
    return F.pmod((b * 1103 + k * 12289 + seed * 7919 + 12345) * 69069 % 2147483647 * 16807 % 2147483647, n)


DRAW_SQL = "(((({b}) * 1103 + ({k}) * 12289 + {seed} * 7919 + 12345) * 69069 % 2147483647) * 16807 % 2147483647) % ({n})"


def ordered_prefix(df: DataFrame, order: str, amount: str, parts: int = 256) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over all rows with a smaller ``order`` (unique values).

    Approximate quantiles cut the values into parts; sums run inside parts, and only one row a part is added up in order.
    """
    at = F.array(*(F.lit(i / parts) for i in range(1, parts)))
    cuts = F.broadcast(df.agg(F.percentile_approx(order, at, F.lit(100 * parts)).alias("cuts")))
    placed = df.join(cuts).withColumn("part", F.size(F.filter("cuts", lambda c: c < F.col(order)))).drop("cuts")
    sums = placed.groupBy("part").agg(F.sum(amount).alias("s"))
    running = F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("part", F.coalesce(running, F.lit(0)).alias("start"))
    inside = F.sum(amount).over(Window.partitionBy("part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(starts), "part").withColumn(
        "before", F.col("start") + F.col("inside")
    ).drop("part", "start", "inside")


def mann_whitney(df: DataFrame, group: str, value: str, first: str) -> DataFrame:
    """``u, z, n1, n2`` of the values where ``group`` equals ``first`` against the rest (average ranks, tie-corrected)."""
    ties = df.groupBy(value).agg(F.count("*").alias("t"), F.count_if(F.col(group) == first).alias("k"))
    # ranks over distinct values: rows before, then half of the tied ones
    ranked = ordered_prefix(ties, value, "t").withColumn("rank", F.col("before") + (F.col("t") + 1) / 2)
    s = ranked.agg(
        F.sum(F.col("rank") * F.col("k")).alias("r1"),
        F.sum("k").alias("n1"),
        F.sum("t").alias("n"),
        F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"),
    ).withColumn("n2", F.col("n") - F.col("n1"))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    product = F.col("n1").cast("double") * F.col("n2")
    sd = F.sqrt(product / 12 * (F.col("n") + 1 - F.col("ties") / (F.col("n").cast("double") * (F.col("n") - 1))))
    return s.select(
        F.round(u, 2).alias("u"), F.round((F.abs(u - product / 2) - 0.5) / sd, 6).alias("z"), "n1", "n2"
    )


def fisher_p(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided p of a 2x2 table of counts: all tables with the same margins that are no likelier.

    Logarithms of the likelihoods follow from one table to the next; one fold finds the largest and that of the table seen, a
    second one adds up. Nothing is stored for each table.
    """
    row, column, n = a + b, a + c, a + b + c + d
    low, high = F.greatest(F.lit(0).cast("long"), row + column - n), F.least(row, column)
    every = F.sequence(low.cast("long"), high.cast("long"))
    ratio = lambda x: F.ln(((row - x + 1) * (column - x + 1)).cast("double")) - F.ln((x * (n - row - column + x)).cast("double"))
    step = lambda log, x: F.when(x == low, F.lit(0.0)).otherwise(log + ratio(x))

    def most(acc: Column, x: Column) -> Column:
        log = step(acc["log"], x)
        return F.struct(log.alias("log"), F.greatest(acc["best"], log).alias("best"), F.when(x == a, log).otherwise(acc["seen"]).alias("seen"))

    first = F.aggregate(every, F.struct(F.lit(0.0).alias("log"), F.lit(float("-inf")).alias("best"), F.lit(0.0).alias("seen")), most)

    def total(top: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            log = step(acc["log"], x)
            share = F.exp(log - top["best"])
            return F.struct(log.alias("log"), (acc["all"] + share).alias("all"), (acc["tail"] + F.when(log <= top["seen"] + 1e-7, share).otherwise(0.0)).alias("tail"))

        sums = F.aggregate(every, F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("all"), F.lit(0.0).alias("tail")), add)
        return F.least(F.lit(1.0), sums["tail"] / sums["all"])

    return F.transform(F.array(first), total)[0]


def binomial_p(k: Column, n: Column, p: Column) -> Column:
    """P(at least k successes in n trials), folded over all outcomes."""
    odds, none = F.ln(p) - F.log1p(-p), n * F.log1p(-p)

    def add(acc: Column, i: Column) -> Column:
        log = F.when(i == 0, none).otherwise(acc["log"] + F.ln((n - i + 1) / i.cast("double")) + odds)
        return F.struct(log.alias("log"), (acc["tail"] + F.when(i >= k, F.exp(log)).otherwise(0.0)).alias("tail"))

    sums = F.aggregate(F.sequence(F.lit(0).cast("long"), n.cast("long")), F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("tail")), add)
    return F.when((k <= 0) | ((p >= 1) & (k <= n)), F.lit(1.0)).when((k > n) | (p <= 0), F.lit(0.0)).otherwise(F.least(F.lit(1.0), sums["tail"]))


def effect(mask: Column, value: Column, least: int = 3) -> Column:
    """Median under the mask minus the overall median, null for fewer than ``least`` masked values."""
    return F.when(F.count_if(mask & value.isNotNull()) >= least, F.median(F.when(mask, value)) - F.median(value))


def _block_positions(sizes: DataFrame, key: str, draws: int, block: int, seed: int) -> DataFrame:
    """``key, b, pos``: the positions of each draw of circular blocks, from ``key, n``.

    Rows are dealt by key and draw before they multiply. Spark's estimate does not count what ``explode`` adds, so the join with
    the data has the merge hint: the positions must not be broadcast.
    """
    spread = sizes.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(draws - 1)))).repartition(key, "b")
    return (
        spread.withColumn("k", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / block) - 1)))
        .withColumn("at", draw(seed, F.col("b").cast("long"), F.col("k").cast("long"), F.col("n")))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(block - 1))))
        .where(F.col("k") * block + F.col("i") < F.col("n"))
        .select(key, "b", ((F.col("at") + F.col("i")) % F.col("n")).alias("pos"))
        .hint("merge")
    )


def circular_blocks(base: DataFrame, key: str, draws: int, block: int, seed: int, value: str) -> DataFrame:
    """Means of circular block resamples: ``key, b, mean``. ``base`` has ``pos`` (from 0 in each key) and the value.

    Each draw is a list of block starts; positions are found by equality, so the data are joined, never crossed.
    """
    positions = _block_positions(base.groupBy(key).agg(F.count("*").alias("n")), key, draws, block, seed)
    return positions.join(base, [key, "pos"]).groupBy(key, "b").agg(F.round(F.avg(value), 6).alias("mean"))


def bootstrap_effect(base: DataFrame, key: str, flag: str, value: str, block: int, draws: int = 800, seed: int = 0) -> DataFrame:
    """``key, point, low, high``: the effect of the flag and the 5 and 95 percentiles of its circular block resamples.

    All three are null for fewer than three blocks of rows or three flagged ones, the limits if half of the draws have no
    effect. ``base`` has ``pos`` (from 0 in each key) and no null values.
    """
    every = resampled_effects(base.withColumn("__block", F.lit(block)), [key], [flag], value, "__block", draws, seed)
    return every.select(key, "point", "low", "high")


#: Draws that a task makes at once of one key.
CHUNK = 100


def drawn_places(seed: int, b: np.ndarray, k: np.ndarray, n: int) -> np.ndarray:
    """What ``draw`` gives, for arrays of draws and places."""
    return (b * 1103 + k * 12289 + seed * 7919 + 12345) * 69069 % 2147483647 * 16807 % 2147483647 % n


def resampled_effects(base: DataFrame, keys: list[str], flags: list[str], value: str, block: str, draws: int = 800, seed: int = 0) -> DataFrame:
    """``keys, side, point, low, high`` for each of the boolean ``flags`` columns: the effect of the flag and the 5 and 95 percentiles of its circular
    block resamples, with one set of draws for all flags of a key.

    All three are null for fewer than three blocks of rows or three flagged ones, the limits if half of the draws have no effect. ``base`` has
    ``pos`` (from 0 in each key), the length of a ``block`` and no null values. A task has the values of one key and makes ``CHUNK`` of its draws.
    """
    every = F.col(value)
    own = base.groupBy(*keys).agg(F.count("*").alias("n"), F.any_value(block).alias("block"), *(effect(F.col(f), every).alias(f) for f in flags))
    own = own.withColumns({f: F.when(F.col("n") >= 3 * F.col("block"), F.col(f)) for f in flags})
    kinds = dict(base.dtypes)

    def resample(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        values, size = part[value].to_numpy(), int(part[block].iloc[0])
        n = len(values)
        b = np.arange(CHUNK, dtype=np.int64) + int(part["chunk"].iloc[0]) * CHUNK
        b = b[b < draws]
        starts = drawn_places(seed, b[:, None], np.arange(-(-n // size), dtype=np.int64)[None, :], n)
        places = ((starts[:, :, None] + np.arange(size)) % n).reshape(len(b), -1)[:, :n]
        got, overall = values[places], np.median(values[places], axis=1)
        out = {k: [part[k].iloc[0]] * len(b) for k in keys} | {"b": b}
        for f in flags:
            on = part[f].to_numpy(bool)[places]
            out[f] = [float(np.median(v[o]) - m) if o.sum() >= 3 else None for v, o, m in zip(got, on, overall)]
        return pd.DataFrame(out)

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "b long", *(f"{f} double" for f in flags)])
    chunks = F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // CHUNK)))
    drawn = base.select(*keys, "pos", value, block, *flags).withColumn("chunk", chunks).groupBy(*keys, "chunk").applyInPandas(resample, schema)
    q = F.array(F.lit(0.05), F.lit(0.95))
    limits = drawn.groupBy(*keys).agg(*(F.struct(F.count(f).alias("k"), F.percentile(f, q).alias("q")).alias(f"{f}_limits") for f in flags))
    held = lambda f, i: F.round(F.when(F.col(f).isNotNull() & (F.col(f"{f}_limits.k") >= draws * 0.5), F.col(f"{f}_limits.q")[i]), 6)
    sides = F.array(*(F.struct(F.lit(f).alias("side"), F.round(f, 6).alias("point"), held(f, 0).alias("low"), held(f, 1).alias("high")) for f in flags))
    return own.join(limits, keys, "left").select(*keys, F.inline(sides))


def min_detectable(base: DataFrame, events: DataFrame, key: str, value: str, draws: int = 4000, shifts: int = 160, step: float = 0.005, power: float = 0.8, seed: int = 1) -> DataFrame:
    """``key, n_events, crit, shift``: the smallest of ``shifts`` steps by which medians of ``n_events`` draws pass their 95 percentile
    in ``power`` of the draws; null if none does, for fewer than 50 values or three events.

    ``base`` has ``pos`` (from 0 in each key) and no null values; ``events`` has ``key, n_events``. A task has the values of one key.
    """
    kinds = dict(base.dtypes)

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        values, n = part[value].to_numpy(), int(part["n_events"].iloc[0])
        row = {key: part[key].iloc[0], "n_events": n, "crit": None, "shift": None}
        if len(values) >= 50 and n >= 3:
            places = drawn_places(seed, np.arange(draws, dtype=np.int64)[:, None], np.arange(n, dtype=np.int64)[None, :], len(values))
            m = np.sort(np.median(values[places], axis=1))
            crit = float(np.percentile(m, 95))
            enough = [s for s in range(shifts) if (m + s * step > crit).mean() >= power]
            row |= {"crit": round(crit, 6), "shift": round(enough[0] * step, 3) if enough else None}
        return pd.DataFrame([row])

    sized = base.select(key, "pos", value).join(events.select(key, "n_events"), key, "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))
    return sized.groupBy(key).applyInPandas(search, f"{key} {kinds[key]}, n_events long, crit double, shift double")


def circular_shift_p(base: DataFrame, key: str, flag: str, value: str) -> DataFrame:
    """``key, effect, p, shifts``: the share of all circular shifts of the flags whose effect (difference of means) is as large.

    Only flagged positions are shifted: rows are flags times shifts, joined with the values by position.
    """
    n = base.groupBy(key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    moved = (
        base.where(flag).select(key, "pos").join(n, key)
        .withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .select(key, "s", "n", "total", ((F.col("pos") + F.col("s")) % F.col("n")).alias("pos"))
        .hint("merge")
    )
    each = moved.join(base.select(key, "pos", value), [key, "pos"]).groupBy(key, "s", "n", "total").agg(
        F.sum(value).alias("on"), F.count("*").alias("k")
    )
    # no effect where every row is flagged
    e = F.round(F.col("on") / F.col("k") - (F.col("total") - F.col("on")) / F.nullif(F.col("n") - F.col("k"), F.lit(0)), 9)
    effects = each.select(key, "s", e.alias("e"))
    own = effects.where("s = 0").select(key, F.col("e").alias("effect"))
    return (
        effects.where("s > 0").join(own, key).groupBy(key, "effect")
        .agg(F.round(F.avg((F.abs("e") >= F.abs("effect")).cast("double")), 6).alias("p"), F.count("*").alias("shifts"))
        .withColumn("effect", F.round("effect", 4))
    )


def verdict(point: Column, low: Column, high: Column, detectable: Column, target: float, events: Column, least: int = 8) -> Column:
    """What an effect with its interval says: ``too few`` events, ``unknown`` without an interval, ``pass`` above zero and on target,
    ``undetectable`` around zero and below the smallest effect that could be seen, ``reverse`` below zero, else ``fail``."""
    return (
        F.when(events < least, "too few").when(point.isNull() | low.isNull(), "unknown").when((low > 0) & (point >= target), "pass")
        .when(detectable.isNotNull() & (F.abs(point) < detectable) & (low < 0) & (high > 0), "undetectable").when(high < 0, "reverse").otherwise("fail")
    )


#: Coefficients of a rational approximation of the normal tail, off by at most 8e-8.
TAIL_SCALE, TAIL = 0.2316419, (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_tail(z: Column) -> Column:
    """P(a standard normal value exceeds z), from the approximation above."""
    t = 1 / (1 + F.lit(TAIL_SCALE) * F.abs(z))
    series = sum((F.lit(c) * F.pow(t, F.lit(float(i + 1))) for i, c in enumerate(TAIL)), F.lit(0.0))
    upper = F.exp(-z * z / 2) / F.sqrt(2 * F.pi()) * series
    return F.when(z >= 0, upper).otherwise(1 - upper)


def events_against_all(df: DataFrame, keys: list[str], event: str, value: str) -> DataFrame:
    """``keys, u, p``: Mann-Whitney of the values at events against all values, those at events among them.

    Two-sided, average ranks, tie-corrected, with continuity; values are counted before they are ordered within their key.
    ``p`` is null without events or without different values.
    """
    on = F.coalesce(F.col(event), F.lit(False))
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__all"), F.count_if(on).alias("__on"))
    below = F.coalesce(F.sum("__all").over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    both = (F.col("__all") + F.col("__on")).cast("double")
    s = counts.withColumn("below", below).groupBy(*keys).agg(
        F.sum(F.col("__on") * (F.col("below") + F.col("__all") / 2)).alias("u"), F.sum("__on").cast("double").alias("n1"), F.sum("__all").cast("double").alias("n2"),
        F.sum(F.pow(both, F.lit(3.0)) - both).alias("ties"),
    )
    n, product = F.col("n1") + F.col("n2"), F.col("n1") * F.col("n2")
    sd = F.sqrt(product / 12 * (n + 1 - F.col("ties") / F.nullif(n * (n - 1), F.lit(0.0))))
    z = (F.abs(F.col("u") - product / 2) - 0.5) / F.nullif(sd, F.lit(0.0))
    return s.select(*keys, "u", F.when(z.isNotNull(), F.least(F.lit(1.0), 2 * normal_tail(z))).alias("p"))


def sharpe(r: Column, periods: int = 252) -> Column:
    """Aggregate: mean over deviation of returns, by the year; null without deviation."""
    return F.avg(r) / F.nullif(F.stddev_samp(r), F.lit(0.0)) * F.sqrt(F.lit(float(periods)))


def shifted_sharpe(base: DataFrame, key: str, draws: int, seed: int = 7, cost: float = 0.0005, start: float = 0.75) -> DataFrame:
    """``key, b, gain``: the Sharpe ratio of timed returns less that of holding when weights are shifted circularly.

    ``base`` has ``pos`` (from 0 in each key), the weight ``w`` decided at that row and the return ``x``. Draw -1 is no shift; one row
    alone has no other draws. Rows times draws are joined with the weights by position.
    """
    whole = Window.partitionBy(key)
    before = F.coalesce(F.lag("w").over(whole.orderBy("pos")), F.max_by("w", "pos").over(whole))
    weights = base.select(key, F.col("pos").alias("at"), "w", before.alias("before"))
    sized = base.select(key, "pos", "x", F.count("*").over(whole).alias("n"))
    shift = F.when(F.col("b") < 0, 0).otherwise(1 + draw(seed, F.col("b").cast("long"), F.lit(0), F.nullif(F.col("n") - 1, F.lit(0))))
    rows = sized.withColumn("b", F.explode(F.sequence(F.lit(-1), F.lit(draws - 1))))
    rows = rows.select(key, "b", "pos", "x", F.pmod(F.col("pos") - 1 - shift, F.col("n")).alias("at")).hint("merge")
    held = F.when(F.col("pos") == 0, start).otherwise(F.col("w"))
    turned = F.when(F.col("pos") == 0, 0.0).when(F.col("pos") == 1, F.abs(F.col("w") - start)).otherwise(F.abs(F.col("w") - F.col("before")))
    run = rows.join(weights, [key, "at"]).select(key, "b", "x", (held * F.col("x") - turned * cost).alias("r"))
    return run.groupBy(key, "b").agg(F.round(sharpe(F.col("r")) - sharpe(F.col("x")), 9).alias("gain"))


def sharpe_shift_p(base: DataFrame, key: str, draws: int = 1000, seed: int = 7) -> DataFrame:
    """``key, gain, p``: the gain in Sharpe ratio by timing and the share of shifted weights that gain as much (one-sided)."""
    every = shifted_sharpe(base, key, draws, seed)
    own = every.where("b < 0").select(key, F.col("gain").alias("own"))
    p = every.where("b >= 0 AND gain IS NOT NULL").join(own, key).groupBy(key).agg(F.avg((F.col("gain") >= F.col("own")).cast("double")).alias("p"))
    return own.join(p, key, "left").select(key, F.round("own", 6).alias("gain"), F.round("p", 6).alias("p"))


def shifted_medians(base: DataFrame, keys: list[str], side: str, value: str, draws: int, seed: int, least: int = 3) -> DataFrame:
    """``keys, side, b, m``: medians of the values at flagged rows whose positions are shifted circularly by one draw for all keys.

    ``base`` has ``pos``, the name of the flag or null in ``side``, and the value. Draw -1 is no shift. Only flagged rows multiply.
    """
    sized = base.withColumn("n", F.count("*").over(Window.partitionBy(*keys)))
    moved = sized.where(F.col(side).isNotNull()).withColumn("b", F.explode(F.sequence(F.lit(-1), F.lit(draws - 1))))
    shift = F.when(F.col("b") < 0, 0).otherwise(1 + draw(seed, F.col("b").cast("long"), F.lit(0), F.nullif(F.col("n") - 1, F.lit(0))))
    moved = moved.select(*keys, side, "b", F.pmod(F.col("pos") + shift, F.col("n")).alias("pos")).hint("merge")
    at = moved.join(base.select(*keys, "pos", value), [*keys, "pos"])
    return at.groupBy(*keys, side, "b").agg(F.when(F.count(value) >= least, F.median(value)).alias("m"))


def detection_power(base: DataFrame, sizes: DataFrame, keys: list[str], value: str, draws: int = 400, shifts: int = 60, step: float = 0.01, level: float = 0.10, power: float = 0.8, seed: int = 1) -> DataFrame:
    """``keys, n, shift, power``: the smallest of ``shifts`` steps that a Mann-Whitney test of n drawn values against all would find at
    ``level`` in ``power`` of the draws; both null if there is none.

    ``base`` has ``pos`` (from 0 in each key) and no null values, ``sizes`` the number n for each key. The base is ranked once: how many
    values are below and how many tie is looked up for all draws and one shift at a time, by bisection in the sorted values, and the search
    ends at the first shift that is found often enough. A task holds the values of one key. Average ranks, tie-corrected, with continuity.
    """
    kinds = dict(base.dtypes)
    bound = 0.0
    for _ in range(60):  # the z from which the tail's approximation is below half the level
        bound += 2.0 ** -(_ + 1) * 8 * (2 * _tail(bound + 2.0 ** -(_ + 1) * 8) >= level)

    def find(frames: Iterator[pd.DataFrame] | pd.DataFrame) -> pd.DataFrame:
        first = frames.iloc[0]
        n = int(first["n"])
        values = frames.sort_values("pos")[value].to_numpy()
        row = {k: first[k] for k in keys} | {"n": n, "shift": None, "power": None}
        if n < 1 or len(values) < 2:
            return pd.DataFrame([row])
        b, k = np.arange(draws, dtype=np.int64)[:, None], np.arange(n, dtype=np.int64)[None, :]
        drawn = values[drawn_places(seed, b, k, len(values))]
        ordered = np.sort(values)
        t = np.unique(ordered, return_counts=True)[1].astype(float)
        ties = (t**3 - t).sum()
        for s in range(shifts):
            x = drawn + s * step
            below, upto = np.searchsorted(ordered, x, "left"), np.searchsorted(ordered, x, "right")
            same = (upto - below).astype(float)
            u = (below + same / 2).sum(1)
            # each distinct drawn value once: by how much it raises the ties of the base
            own = (x[:, :, None] == x[:, None, :]).sum(2)
            more = ((((same + own) ** 3 - (same + own)) - (same**3 - same)) / own).sum(1)
            size = n + len(values)
            sd = np.sqrt(n * len(values) / 12 * (size + 1 - (ties + more) / (size * (size - 1.0))))
            share = float(((np.abs(u - n * len(values) / 2) - 0.5) / np.where(sd > 0, sd, np.inf) > bound).mean())
            if share >= power:
                return pd.DataFrame([row | {"shift": round(s * step, 6), "power": share}])
        return pd.DataFrame([row])

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", n long, shift double, power double"
    return base.select(*keys, "pos", value).join(sizes.select(*keys, "n"), keys).groupBy(*keys).applyInPandas(find, schema)


def _tail(z: float) -> float:
    """The approximation of ``normal_tail`` for one number."""
    t = 1 / (1 + TAIL_SCALE * abs(z))
    upper = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * sum(c * t ** (i + 1) for i, c in enumerate(TAIL))
    return float(upper if z >= 0 else 1 - upper)


def shift_p(every: DataFrame, keys: list[str], stat: str) -> DataFrame:
    """``keys, stat, p``: of statistics by draw, the one without a shift (-1) and the share of the others that are as large (two-sided)."""
    own = every.where("b < 0").select(*keys, F.col(stat).alias("own"))
    drawn = every.where(F.col("b") >= 0).where(F.col(stat).isNotNull())
    far = (F.round(F.abs(stat), 9) >= F.round(F.abs("own"), 9)).cast("double")
    p = drawn.join(own, keys).groupBy(*keys).agg(F.avg(far).alias("p"))
    return own.join(p, keys, "left").select(*keys, F.round("own", 6).alias(stat), F.round("p", 6).alias("p"))
