"""Fixed vectors and properties of the series operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.operators import events as E
from larkspur.operators import joins as J
from larkspur.operators import series as S
from larkspur.operators import stats as T
from larkspur.operators import upserts as U


def series(spark, values, monthly=False, key="a", start=(2026, 1, 1)):
    day = dt.date(*start)
    step = lambda i: dt.date(day.year + (day.month - 1 + i) // 12, (day.month - 1 + i) % 12 + 1, 1) if monthly else day + dt.timedelta(i)
    return spark.createDataFrame([(key, step(i), None if v is None else float(v)) for i, v in enumerate(values)], "series_id string, d date, v double")


def values(df, column="v"):
    return [r[column] for r in df.orderBy("series_id", "d").collect()]


def test_transforms_of_thirteen_months(spark):
    s = series(spark, range(100, 113), monthly=True)
    assert values(S.transform(s, "raw")[0])[-1] == 112
    assert values(S.transform(s, "rebase")[0])[-1] == 112
    diff = values(S.transform(s, "diff", True)[0])
    assert len(diff) == 12 and diff[-1] == 1.0
    yoy, derived = S.transform(s, "yoy", True)
    assert values(yoy) == [12.0] and derived
    assert values(S.transform(s, "ma:3")[0])[-1] == 111.0
    assert set(values(S.transform(series(spark, [5] * 13), "vol:5")[0])) == {0.0}
    for bad in ("nope", "ma:x"):
        with pytest.raises(ValueError):
            S.transform(s, bad)
    with pytest.raises(ValueError):
        S.transform(s, "yoy", monthly=False)


def test_a_missing_month_is_not_bridged(spark):
    s = series(spark, range(100, 114), monthly=True).where("d <> DATE '2026-06-01'")
    assert values(S.diff_monthly(s))[4] is None
    assert len(values(S.yoy_monthly(s))) == 2


def test_monthly_payrolls(spark):
    s = series(spark, [158592, 158436, 158650, 158798, 158861, 158881, 158858], monthly=True)
    diff = S.diff_monthly(s)
    assert values(diff)[-1] == -23 and values(S.moving_average(diff, 3))[-1] == 20.0


def test_moving_average_has_a_partial_head(spark):
    assert values(S.moving_average(series(spark, [3, 3, 3, 9]), 3)) == [3, 3, 3, 5]


def test_changes_and_ranks(spark):
    s = series(spark, [100, 101, 99, 103, 102])
    got = [round(x, 6) for x in values(S.changes(s, 1), "change")[1:]]
    assert got == [1.0, -1.980198, 4.040404, -0.970874]
    assert values(S.changes(s, 1, relative=False), "change")[1:] == [1, -2, 4, -1]
    assert values(S.full_rank(series(spark, [1, 2, 3, 4])), "rank")[2] == 75.0
    ranks = values(S.trailing_rank(s, 3), "rank")
    inverted = values(S.trailing_rank(s, 3, invert=True), "rank")
    assert ranks == [None, None, 0.0, 100.0, 50.0] and [a + b for a, b in zip(ranks[2:], inverted[2:])] == [100.0] * 3


def test_zero_bases_give_null(spark):
    assert values(S.changes(series(spark, [0, 1]), 1), "change") == [None, None]


def test_episodes_and_independent_events(spark):
    flags = [1, 0, 0, 1, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0, 1]
    s = series(spark, flags)
    eps = E.episodes(s, F.col("v") == 1, 3).orderBy("pos").collect()
    assert [(e.pos, e.n) for e in eps] == [(1, 4), (10, 2), (17, 1)]
    kept = E.spaced(E.episodes(s, F.col("v") == 1, 3), "pos", 16)
    assert [r.pos for r in kept.orderBy("pos").collect()] == [1, 17]


def test_nearest_prefers_the_later_of_two(spark):
    left, right = series(spark, [0], start=(2026, 1, 11)), series(spark, [1], start=(2026, 1, 1)).unionByName(series(spark, [2], start=(2026, 1, 21)))
    assert J.nearest(left.drop("v"), right, "series_id", "d", "v", 20).first().v == 2
    assert J.nearest(left.drop("v"), right, "series_id", "d", "v", 9).first().v is None


def test_forward_fill_is_bounded(spark):
    s = series(spark, [1, None, None, None, None, 2])
    assert values(J.forward_fill(s, "series_id", "d", "v", 3)) == [1, 1, 1, 1, None, 2]


def test_asof_keeps_every_left_row(spark):
    left, right = series(spark, [0] * 5), series(spark, [7], start=(2026, 1, 3)).withColumnRenamed("v", "x")
    assert values(J.asof(left, right, "series_id", "d", "x"), "x") == [None, None, 7, 7, 7]


def test_splice_meets_the_history(spark):
    out = values(J.splice(series(spark, [10, 20]), series(spark, [1, 2, 3]), "series_id", "d", "v"))
    assert out == [10, 20, 30]


def test_mann_whitney(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("b", 4.0)], "g string, v double")
    r = T.mann_whitney(df, "g", "v", "a").first()
    assert (r.u, r.n1, r.n2) == (0.5, 2, 3)


def test_upserts_are_idempotent_and_guarded(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, x int")
    once = U.upsert(old, new, "k")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, U.upsert(once, new, "k").collect())) == [("a", 1), ("b", 3), ("c", 4)]
    assert {tuple(r) for r in U.changed_keys(old, new, "k").collect()} == {("a", "gone"), ("b", "changed")}
    assert U.changed_keys(old, once.where("k <> 'b'").unionByName(old.where("k = 'b'")), "k").count() == 0
    assert {tuple(r) for r in U.frozen(old, old, "k").collect()} == set()


def test_composite_needs_enough_parts(spark):
    parts = spark.createDataFrame([("2026-01-01", 1.0), ("2026-01-01", 3.0), ("2026-01-01", None), ("2026-01-02", 1.0)], "d string, v double")
    got = {r.d: r.score for r in E.composite(parts, 4).collect()}
    assert got == {"2026-01-01": 2.0, "2026-01-02": None}
