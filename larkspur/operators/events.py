"""Event studies on signals: episodes, independent events, forward outcomes, strategy figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.series import DATE, KEY, VALUE, by_date, trailing


def composite(parts: DataFrame, n_parts: int) -> DataFrame:
    """Average of the parts there are per date, null if more than two of ``n_parts`` are missing."""
    got = parts.groupBy(DATE).agg(F.avg(VALUE).alias("score"), F.count(VALUE).alias("n"))
    return got.withColumn("score", F.when(F.col("n") >= max(1, n_parts - 2), F.col("score")))


def consensus(parts: DataFrame, tail: float) -> DataFrame:
    """Parts in the upper tail minus parts in the lower, null without any part."""
    up, down = F.count_if(F.col(VALUE) >= 100 - tail), F.count_if(F.col(VALUE) <= tail)
    return parts.groupBy(DATE).agg(F.when(F.count(VALUE) > 0, up - down).alias("net"))


def ever_in_last(flag: Column, k: int) -> Column:
    """Whether the flag was set in any of the last k rows; null flags count as unset."""
    return F.max(F.coalesce(flag, F.lit(False)).cast("int")).over(trailing(k)) == 1


def cross_up(df: DataFrame, n: int) -> DataFrame:
    """Adds ``cross``: the value rises above its full n-row average, where it was not above before."""
    ma = F.when(F.count(VALUE).over(trailing(n)) == n, F.avg(VALUE).over(trailing(n)))
    w = by_date()
    crossed = (F.col(VALUE) > F.col("ma")) & (F.lag(VALUE).over(w) <= F.lag("ma").over(w))
    return df.withColumn("ma", ma).withColumn("cross", F.coalesce(crossed, F.lit(False)))


def episodes(df: DataFrame, flag: str, gap: int) -> DataFrame:
    """Flagged rows merged while at most ``gap`` unflagged rows lie between: ``series_id, start, end, n``."""
    placed = df.withColumn("pos", F.row_number().over(by_date())).where(F.coalesce(flag, F.lit(False)))
    new = F.coalesce(F.col("pos") - F.lag("pos").over(by_date()) > gap + 1, F.lit(True))
    grouped = placed.withColumn("episode", F.sum(new.cast("int")).over(by_date()))
    return grouped.groupBy(KEY, "episode").agg(
        F.min(DATE).alias("start"),
        F.max(DATE).alias("end"),
        F.min("pos").alias("pos"),
        (F.max("pos") - F.min("pos") + 1).alias("n"),
    ).drop("episode")


def spaced(df: DataFrame, pos: str, least: int) -> DataFrame:
    """Greedily keeps rows whose ``pos`` is at least ``least`` behind the last kept one, per series.

    Each decision depends on the one before, so a series' positions are folded in order; they
    are events, not rows, and few.
    """
    order = F.array_sort(F.collect_list(pos))
    kept = F.aggregate(
        F.col("all"),
        F.slice(F.col("all"), 1, 0),
        lambda acc, p: F.when(
            (F.size(acc) == 0) | (p - F.try_element_at(acc, F.lit(-1)) >= least), F.concat(acc, F.array(p))
        ).otherwise(acc),
    )
    chosen = df.groupBy(KEY).agg(order.alias("all")).select(KEY, F.explode(kept).alias(pos))
    return df.join(chosen, [KEY, pos])


def forward_return(h: int) -> Column:
    return F.lead(VALUE, h).over(by_date()) / F.col(VALUE) - 1


def adverse_excursion(h: int) -> Column:
    """Worst return within the next h rows; null if there are fewer."""
    low = F.min(VALUE).over(by_date().rowsBetween(0, h))
    return F.when(F.lead(VALUE, h).over(by_date()).isNotNull(), low / F.col(VALUE) - 1)


def favourable_excursion(h: int) -> Column:
    high = F.max(VALUE).over(by_date().rowsBetween(0, h))
    return F.when(F.lead(VALUE, h).over(by_date()).isNotNull(), high / F.col(VALUE) - 1)


def deep_fall_ahead(h: int, limit: float) -> Column:
    """Whether the value falls by more than ``limit`` from a running high within the next h rows."""
    ahead = F.collect_list(VALUE).over(by_date().rowsBetween(0, h))
    start = F.struct(F.lit(float("-inf")).alias("high"), F.lit(0.0).alias("low"))
    walked = F.aggregate(
        ahead,
        start,
        lambda s, x: F.struct(
            F.greatest(s["high"], x).alias("high"), F.least(s["low"], x / F.greatest(s["high"], x) - 1).alias("low")
        ),
    )
    return F.when(F.size(ahead) == h + 1, walked["low"] < -limit)


def low_lag(k: int) -> Column:
    """Rows from the lowest value within k rows on either side (the first such) to the current row."""
    near = by_date().rowsBetween(-k, k)
    before = F.count("*").over(by_date().rowsBetween(-k, -1))
    h = F.collect_list(VALUE).over(near)
    return (before + 1 - F.array_position(h, F.array_min(h))).cast("int")


def strategy(df: DataFrame, weight: str, start: float = 0.75, cost: float = 0.0005) -> DataFrame:
    """Adds ``held`` (yesterday's weight), ``turnover`` and ``net`` return after cost."""
    w = by_date()
    held = F.coalesce(F.lag(weight).over(w), F.lit(start))
    r = F.col(VALUE) / F.nullif(F.lag(VALUE).over(w), F.lit(0.0)) - 1
    return (
        df.withColumn("held", held)
        .withColumn("turnover", F.abs(F.col("held") - F.coalesce(F.lag("held").over(w), F.col("held"))))
        .withColumn("net", r * F.col("held") - F.col("turnover") * cost)
    )


def performance(df: DataFrame, r: str, periods: int = 252) -> DataFrame:
    """``annual, sharpe, mdd, n`` of each series' returns; the running high starts at the first return."""
    growth = F.product(1 + F.col(r)).over(by_date().rowsBetween(Window.unboundedPreceding, 0))
    curve = df.where(F.col(r).isNotNull()).withColumn("c", growth)
    high = F.max("c").over(by_date().rowsBetween(Window.unboundedPreceding, 0))
    return curve.withColumn("fall", F.col("c") / high - 1).groupBy(KEY).agg(
        F.round(F.pow(F.product(1 + F.col(r)), F.lit(float(periods)) / F.count("*")) - 1, 6).alias("annual"),
        F.round(F.avg(r) / F.nullif(F.stddev_samp(r), F.lit(0.0)) * F.sqrt(F.lit(float(periods))), 6).alias("sharpe"),
        F.round(F.min("fall"), 6).alias("mdd"),
        F.count("*").alias("n"),
    )


def signal_quality(df: DataFrame, signals: str, name: str, near: int = 30, short: int = 20, long: int = 60) -> DataFrame:
    """How signals for a low did, of those with ``long`` rows ahead: ``name, n, tier1, tier2, tier3, lag, mae, mfe, r20, r60``.

    Tier 1: at most five rows from the lowest value nearby. Tier 2: within ``short`` rows more than 7 % up, and never 5 % down
    within ``long``. Tier 3: more than 10 % up after ``long`` rows without a fall by more than 5 % from a high on the way.
    ``df`` holds every row of the series, and in ``signals`` the names of the rules that fire there (null: none).
    """
    w = by_date()
    ahead = F.lead(VALUE, long).over(w)
    judged = (
        df.withColumn("lag_", low_lag(near)).withColumn("mae_", F.min(VALUE).over(w.rowsBetween(0, long)) / F.col(VALUE) - 1)
        .withColumn("mfe_", F.max(VALUE).over(w.rowsBetween(0, short)) / F.col(VALUE) - 1)
        .withColumn("r20_", F.lead(VALUE, short).over(w) / F.col(VALUE) - 1).withColumn("r60_", ahead / F.col(VALUE) - 1)
        .withColumn("deep_", deep_fall_ahead(long, 0.05)).where("r60_ IS NOT NULL")
    )
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    middle = lambda c: F.round(F.median(c), 6)
    return judged.withColumn(name, F.explode(signals)).groupBy(name).agg(
        F.count("*").alias("n"), share(F.abs("lag_") <= 5).alias("tier1"), share((F.col("mfe_") > 0.07) & (F.col("mae_") >= -0.05)).alias("tier2"),
        share((F.col("r60_") > 0.10) & ~F.col("deep_")).alias("tier3"), F.median("lag_").alias("lag"), middle("mae_").alias("mae"), middle("mfe_").alias("mfe"),
        middle("r20_").alias("r20"), middle("r60_").alias("r60"),
    )


def segments(df: DataFrame, k: int) -> DataFrame:
    """Rows with their ``segment`` of k by position; neighbouring segments share their boundary row."""
    n = F.count("*").over(Window.partitionBy(KEY))
    placed = df.withColumn("pos", F.row_number().over(by_date()) - 1).withColumn("rows", n)
    bound = lambda i: F.least(F.floor(F.col("rows") * i / k), F.col("rows") - 1)
    both = placed.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return both.where(F.col("pos").between(bound(F.col("segment")), bound(F.col("segment") + 1))).drop("rows")
