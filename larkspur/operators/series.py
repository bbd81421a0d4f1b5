"""Transforms of dated series.

A series table has ``series_id, d, v``: one row per series and date, missing values absent or
null. Every window is partitioned by series, so series spread over tasks.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, DATE, VALUE = "series_id", "d", "v"


def by_date(key: str = KEY) -> Window:
    return Window.partitionBy(key).orderBy(DATE)


def trailing(n: int, key: str = KEY):
    """The last n rows, the current one included."""
    return by_date(key).rowsBetween(-(n - 1), 0)


def gated(value: Column, n: int, least: int | None = None, key: str = KEY, over: str = VALUE) -> Column:
    """``value`` (an aggregate) over the last n rows, null unless at least ``least`` (default n) are there."""
    frame = trailing(n, key)
    return F.when(F.count(over).over(frame) >= (least or n), value.over(frame))


def lag_return(n: int = 1, value: str = VALUE) -> Column:
    """Relative change over n rows; null where the base is zero or missing."""
    base = F.lag(value, n).over(by_date())
    return F.col(value) / F.nullif(base, F.lit(0.0)) - 1


def rebase(df: DataFrame, base: float = 100.0) -> DataFrame:
    """Each series in per cent of its first value."""
    first = F.first_value(VALUE).over(by_date())
    return df.withColumn(VALUE, F.round(F.col(VALUE) / F.nullif(first, F.lit(0.0)) * base, 2))


def is_monthly(df: DataFrame) -> DataFrame:
    """``series_id, monthly``: more than two dates, all of them the first of a month."""
    return df.groupBy(KEY).agg(((F.count("*") > 2) & F.bool_and(F.dayofmonth(DATE) == 1)).alias("monthly"))


def months_before(df: DataFrame, n: int, how: str = "left") -> DataFrame:
    """Adds ``base``: the value n calendar months earlier, found by date and never by row distance."""
    earlier = df.select(F.col(KEY).alias("b_id"), F.add_months(F.col(DATE), n).alias("b_d"), F.col(VALUE).alias("base"))
    return df.join(earlier, (F.col(KEY) == F.col("b_id")) & (F.col(DATE) == F.col("b_d")), how).drop("b_id", "b_d")


def diff_monthly(df: DataFrame) -> DataFrame:
    """Change against the previous calendar month; null where that month is missing; first rows dropped."""
    n = F.row_number().over(by_date())
    return (
        months_before(df.withColumn("n", n), 1)
        .where("n > 1")
        .select(KEY, DATE, F.round(F.col(VALUE) - F.col("base"), 2).alias(VALUE))
    )


def yoy_monthly(df: DataFrame) -> DataFrame:
    """Per cent against the same month a year before; rows without that month are dropped, a zero base gives null."""
    return months_before(df, 12, "inner").select(
        KEY, DATE, F.round((F.col(VALUE) / F.nullif("base", F.lit(0.0)) - 1) * 100, 2).alias(VALUE)
    )


def moving_average(df: DataFrame, n: int) -> DataFrame:
    """Average of the last n rows, of fewer at the head."""
    return df.withColumn(VALUE, F.round(F.avg(VALUE).over(trailing(n)), 2))


def volatility(df: DataFrame, n: int) -> DataFrame:
    """Population deviation of the last n simple returns in per cent; the first n rows are consumed."""
    changed = df.withColumn("r", lag_return())
    return (
        changed.withColumn(VALUE, F.round(gated(F.stddev_pop("r"), n, over="r") * 100, 3))
        .withColumn("n", F.row_number().over(by_date()))
        .where(F.col("n") > n)
        .select(KEY, DATE, VALUE)
    )


def diff(df: DataFrame) -> DataFrame:
    """Change against the previous row; the first row is dropped."""
    return (
        df.withColumn("p", F.lag(VALUE).over(by_date()))
        .where(F.col("p").isNotNull())
        .select(KEY, DATE, F.round(F.col(VALUE) - F.col("p"), 2).alias(VALUE))
    )


def transform(df: DataFrame, spec: str, monthly: bool = False) -> tuple[DataFrame, bool]:
    """Applies ``raw, rebase, diff, yoy, ma:N`` or ``vol:N``; also says whether the unit changed."""
    if spec == "raw":
        return df, False
    if spec == "rebase":
        return rebase(df), False
    if spec == "diff":
        return (diff_monthly(df) if monthly else diff(df)), False
    if spec == "yoy":
        if not monthly:
            raise ValueError("yoy needs a monthly series")
        return yoy_monthly(df), True
    if m := re.fullmatch(r"(ma|vol):(\d+)", spec):
        n = int(m[2])
        return (moving_average(df, n) if m[1] == "ma" else volatility(df, n)), True
    raise ValueError(f"unknown transform {spec!r}")


def materialise(df: DataFrame, specs: list[dict], aligned: bool = False) -> DataFrame:
    """The series that a list of specs asks for: ``name, d, v, derived, style``.

    A spec has ``id`` and ``name``, and may have ``since``, ``t`` (see ``transform``), ``monthly``, ``derived`` and styles, which are
    passed on as a map. ``aligned`` keeps the dates that all of the named series have from their starts on.
    """
    parts = []
    for n, spec in enumerate(specs):
        part = df.where(F.col(KEY) == spec["id"]).withColumn(KEY, F.lit(f"{n}"))
        parts.append(since(part, spec["since"]) if spec.get("since") else part)
    chosen = reduce(DataFrame.unionByName, parts)
    if aligned:
        dates = chosen.where(F.col(VALUE).isNotNull()).groupBy(DATE).agg(F.count_distinct(KEY).alias("k")).where(F.col("k") == len(specs))
        chosen = chosen.join(dates.select(DATE), DATE, "left_semi")
    out = []
    for n, spec in enumerate(specs):
        made, derived = transform(chosen.where(F.col(KEY) == f"{n}"), spec.get("t", "raw"), spec.get("monthly", False))
        style = [F.lit(x) for k in ("style", "axis", "dash", "color", "width") if k in spec for x in (k, str(spec[k]))]
        styles = F.create_map(*style) if style else F.create_map().cast("map<string,string>")
        out.append(made.select(F.lit(spec["name"]).alias("name"), DATE, VALUE, F.lit(bool(derived or spec.get("derived"))).alias("derived"), styles.alias("style")))
    return reduce(DataFrame.unionByName, out)


def align(df: DataFrame) -> DataFrame:
    """Only the dates that every series has."""
    n = df.select(KEY).distinct().agg(F.count("*").alias("series"))
    full = df.where(F.col(VALUE).isNotNull()).groupBy(DATE).agg(F.count_distinct(KEY).alias("k"))
    dates = full.join(F.broadcast(n), F.col("k") == F.col("series")).select(DATE)
    return df.join(dates, DATE, "left_semi")


def since(df: DataFrame, start: str) -> DataFrame:
    """Rows from a date on; a series without such rows stays whole."""
    late = F.max(F.col(DATE)).over(Window.partitionBy(KEY)) >= F.to_date(F.lit(start))
    return df.withColumn("late", late).where(~F.col("late") | (F.col(DATE) >= F.to_date(F.lit(start)))).drop("late")


def last_years(df: DataFrame, years: int) -> DataFrame:
    """Rows of the last years before each series' latest date."""
    last = F.max(DATE).over(Window.partitionBy(KEY))
    return df.withColumn("last", last).where(F.col(DATE) >= F.add_months("last", -12 * years)).drop("last")


def tail(df: DataFrame, n: int) -> DataFrame:
    """The latest n rows of each series."""
    newest = Window.partitionBy(KEY).orderBy(F.col(DATE).desc())
    return df.withColumn("n", F.row_number().over(newest)).where(F.col("n") <= n).drop("n")


def every_kth(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` evenly spaced rows of each series."""
    whole = Window.partitionBy(KEY)
    k = F.greatest(F.floor(F.count("*").over(whole) / most), F.lit(1))
    return (
        df.withColumn("k", k).withColumn("n", F.row_number().over(by_date()))
        .where((F.col("n") - 1) % F.col("k") == 0).drop("k", "n")
    )


def trailing_rank(df: DataFrame, n: int, invert: bool = False, value: str = VALUE) -> DataFrame:
    """Adds ``rank``: the per cent of the n-1 rows before that are strictly lower; null until n rows are there."""
    frame = F.collect_list(value).over(trailing(n))
    low = 100 * F.size(F.filter("h", lambda x: x < F.col(value))).cast("double") / (n - 1)
    rank = F.when(F.size("h") == n, 100 - low if invert else low)
    return df.withColumn("h", frame).withColumn("rank", rank).drop("h")


def full_rank(df: DataFrame) -> DataFrame:
    """Adds ``rank``: the per cent of all rows of the series that are not higher."""
    return df.withColumn("rank", F.cume_dist().over(Window.partitionBy(KEY).orderBy(VALUE)) * 100)


def changes(df: DataFrame, w: int, relative: bool = True) -> DataFrame:
    """Adds ``change`` over w rows, in per cent (null for a zero base) or in units."""
    base = F.lag(VALUE, w).over(by_date())
    out = lag_return(w) * 100 if relative else F.col(VALUE) - base
    return df.withColumn("change", out)


def scan_moves(df: DataFrame, windows: list[int]) -> DataFrame:
    """Per series and window the latest change, how many changes there are, and the per cent of them that are not higher."""
    out = None
    for w in windows:
        moved = changes(df, w).where(F.col("change").isNotNull())
        latest = F.last("change").over(by_date().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        part = (
            moved.withColumn("latest", latest)
            .groupBy(KEY)
            .agg(
                F.lit(w).alias("w"),
                F.round(F.max("latest"), 6).alias("change"),
                F.round(100 * F.avg((F.col("change") <= F.col("latest")).cast("double")), 6).alias("pct_rank"),
                F.count("*").alias("n"),
            )
        )
        out = part if out is None else out.unionByName(part)
    return out


def zones(value: Column, cuts: tuple[float, ...], names: tuple[str, ...]) -> Column:
    """The name of the right-closed band between the cuts that holds a 0-100 value; one more name than cuts."""
    out = F.when((value <= -0.01) | (value > 100.01) | value.isNull(), F.lit(None))
    for cut, name in zip(cuts, names):
        out = out.when(value <= cut, name)
    return out.otherwise(names[-1])


def jump_flags(df: DataFrame, sigmas: float = 5.0) -> DataFrame:
    """Runs of consecutive returns beyond ``sigmas`` deviations, each by its peak: ``series_id, d, r, run_length``."""
    whole = Window.partitionBy(KEY)
    r = df.withColumn("r", lag_return()).where(F.col("r").isNotNull()).withColumn("n", F.row_number().over(by_date()))
    scored = r.withColumn("mu", F.avg("r").over(whole)).withColumn("sd", F.stddev_pop("r").over(whole))
    hits = scored.where((F.col("sd") > 0) & (F.abs(F.col("r") - F.col("mu")) > sigmas * F.col("sd")))
    runs = hits.withColumn("run", F.col("n") - F.row_number().over(by_date()))
    size = F.struct(F.abs(F.col("r") - F.col("mu")), -F.col("n"))
    return runs.groupBy(KEY, "run").agg(
        F.max_by(DATE, size).alias(DATE), F.round(F.max_by("r", size), 6).alias("r"), F.count("*").alias("run_length")
    ).drop("run")


def weekly_last(df: DataFrame) -> DataFrame:
    """Each series' last value of every week, labelled by its Sunday."""
    week = F.date_add(F.date_trunc("week", DATE).cast("date"), 6).alias("week")
    known = F.when(F.col(VALUE).isNotNull(), F.col(DATE))
    return df.groupBy(KEY, week).agg(F.max_by(VALUE, known).alias(VALUE))


def streak(df: DataFrame, value: str) -> DataFrame:
    """How many rows, counted back from the latest, hold the latest value: ``series_id, value, streak``."""
    back = Window.partitionBy(KEY).orderBy(F.col(DATE).desc())
    ranked = df.withColumn("n", F.row_number().over(back)).withColumn("latest", F.first(value).over(back))
    other = F.min(F.when(~F.col(value).eqNullSafe(F.col("latest")), F.col("n")))
    return ranked.groupBy(KEY).agg(
        F.first("latest").alias("latest"), (F.coalesce(other, F.count("*") + 1) - 1).alias("streak")
    )
