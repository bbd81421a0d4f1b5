"""Binomial tails, look-back to a session, freshness of releases."""

import datetime as dt
from math import comb

from pyspark.sql import functions as F

from larkspur.functions import scalars as C
from larkspur.operators import joins as J
from larkspur.operators import stats as T


def test_binomial_tail_against_sums_and_at_its_edges(spark):
    exact = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))
    rows = [(k, n, p, exact(k, n, p)) for n, p in ((12, 0.3), (40, 0.5), (7, 0.9), (10, 0.5)) for k in range(n + 1)]
    rows += [(0, 5, 0.0, 1.0), (6, 5, 0.5, 0.0), (5, 5, 1.0, 1.0), (1, 5, 0.0, 0.0)]
    # counts whose coefficients exceed a double
    rows += [(5_000, 10_000, 0.5, 0.503989), (9_000, 10_000, 0.5, 0.0)]
    got = spark.createDataFrame(rows, "k long, n long, p double, want double").withColumn("got", T.binomial_p(F.col("k"), F.col("n"), F.col("p"))).collect()
    assert all(abs(r.got - r.want) < (1e-5 if r.n > 100 else 1e-11) for r in got)


def test_fisher_against_exact_fractions(spark):
    def exact(a, b, c, d):
        r, k, n = a + b, a + c, a + b + c + d
        w = {x: comb(k, x) * comb(n - k, r - x) for x in range(max(0, r + k - n), min(r, k) + 1)}
        return sum(v for v in w.values() if v <= w[a]) / sum(w.values())

    rows = [(a, b, c, d, exact(a, b, c, d)) for a in range(0, 9, 2) for b in (0, 1, 7) for c in (0, 3, 11) for d in (0, 2, 5) if a + b + c + d]
    rows += [(1, 9, 11, 3, exact(1, 9, 11, 3)), (700, 300, 650, 350, exact(700, 300, 650, 350))]
    got = spark.createDataFrame(rows, "a long, b long, c long, d long, want double").withColumn("p", T.fisher_p(*map(F.col, "abcd"))).collect()
    assert all(abs(r.p - r.want) < 1e-9 for r in got)


def test_power_is_that_of_tests_one_by_one(spark):
    import math
    import random

    rng = random.Random(9)
    bases = {"a": [round(rng.gauss(0, 0.1), 2) for _ in range(90)], "b": [rng.gauss(0, 0.02) for _ in range(60)], "c": [0.5]}
    base = spark.createDataFrame([(k, i, v) for k, vs in bases.items() for i, v in enumerate(vs)], "k string, pos long, v double")
    sizes = spark.createDataFrame([("a", 8), ("b", 5), ("c", 3)], "k string, n long")
    got = {r.k: (r.shift, r.power) for r in T.detection_power(base, sizes, ["k"], "v", draws=60).collect()}

    def p(sample, values):
        both = sorted(sample + values)
        rank = {x: (2 * both.index(x) + both.count(x) + 1) / 2 for x in set(both)}
        n, m = len(sample), len(values)
        u = sum(rank[x] for x in sample) - n * (n + 1) / 2
        ties = sum(both.count(x) ** 3 - both.count(x) for x in set(both))
        z = (abs(u - n * m / 2) - 0.5) / math.sqrt(n * m / 12 * (n + m + 1 - ties / ((n + m) * (n + m - 1))))
        return math.erfc(z / math.sqrt(2))

    for k, n in (("a", 8), ("b", 5)):
        vs = bases[k]
        drawn = [[vs[(b * 1103 + j * 12289 + 7919 + 12345) * 69069 % 2147483647 * 16807 % 2147483647 % len(vs)] for j in range(n)] for b in range(60)]
        power = lambda s: sum(p([x + s * 0.01 for x in d], vs) < 0.1 for d in drawn) / 60
        first = next(s for s in range(60) if power(s) >= 0.8)
        assert got[k] == (round(first * 0.01, 6), power(first))
    assert got["c"] == (None, None)


def test_last_session_looks_back_ten_days_and_not_at_the_day_itself(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    asked = spark.createDataFrame([("a", day(n)) for n in (5, 6, 15, 16)] + [("b", day(6)), (None, day(6)), ("a", None)], "key string, d date")
    sessions = spark.createDataFrame([("a", day(3)), ("a", day(5)), ("a", day(5)), (None, day(5))], "key string, d date")
    got = {(r.key, r.d): r.looked_back for r in J.last_session(asked, sessions, "key", "d").collect()}
    assert got == {("a", day(5)): 2, ("a", day(6)): 1, ("a", day(15)): 10, ("a", day(16)): None, ("b", day(6)): None, (None, day(6)): None, ("a", None): None}


def test_releases_are_fresh_for_36_hours_and_not_before_they_appear(spark):
    at = dt.datetime(2024, 5, 2, 12)
    rows = spark.createDataFrame([(n, at - dt.timedelta(seconds=s)) for n, s in enumerate((0, 36 * 3600, 36 * 3600 + 1, -1))] + [(4, None)], "n int, then timestamp")
    got = rows.select("n", C.fresh(F.col("then"), F.lit(at)).alias("f")).orderBy("n").collect()
    assert [r.f for r in got] == [True, True, False, False, None]
