"""Shift tests, tails and signal quality against plain Python; scalars with their edges."""

import datetime as dt
import math
import random
import statistics as st

from pyspark.sql import functions as F

from larkspur.functions import scalars as C
from larkspur.operators import events as E
from larkspur.operators import series as S
from larkspur.operators import stats as T


def drawn(seed, b, n):
    return ((b * 1103 + seed * 7919 + 12345) * 69069 % 2147483647 * 16807 % 2147483647) % n


def test_normal_tail(spark):
    rows = spark.createDataFrame([(z / 10,) for z in range(-50, 51)], "z double").select("z", T.normal_tail(F.col("z")).alias("p")).collect()
    assert max(abs(r.p - math.erfc(r.z / 2**0.5) / 2) for r in rows) < 1e-7


def test_events_against_all(spark):
    rnd = random.Random(4)
    rows = [(k, round(rnd.random(), 1), rnd.random() < 0.2) for k in "ab" for _ in range(80)] + [("a", None, True), ("c", 1.0, False)]
    got = {r.k: (r.u, r.p) for r in T.events_against_all(spark.createDataFrame(rows, "k string, v double, e boolean"), ["k"], "e", "v").collect()}
    for key in "ab":
        every = [v for k, v, _ in rows if k == key and v is not None]
        some = [v for k, v, e in rows if k == key and e and v is not None]
        u = sum((x > y) + (x == y) / 2 for x in some for y in every)
        n, n1, n2 = len(every) + len(some), len(some), len(every)
        pooled = every + some
        ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
        z = (abs(u - n1 * n2 / 2) - 0.5) / math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
        assert got[key][0] == u and abs(got[key][1] - min(1, math.erfc(z / 2**0.5))) < 1e-6
    assert got["c"] == (0.0, None)


def test_shifted_sharpe(spark):
    rnd = random.Random(5)
    rows = [(k, i, rnd.choice([0.5, 0.75, 1.0]), rnd.gauss(0, 0.01)) for k, n in (("a", 40), ("b", 25)) for i in range(n)]
    base = spark.createDataFrame([*rows, ("one", 0, 1.0, 0.1)], "k string, pos long, w double, x double")
    got = {(r.k, r.b): r.gain for r in T.shifted_sharpe(base, "k", 12).collect()}
    ratio = lambda r: st.mean(r) / st.stdev(r) * 252**0.5
    for key in "ab":
        w, x = [r[2] for r in rows if r[0] == key], [r[3] for r in rows if r[0] == key]
        for b in range(-1, 12):
            s = 0 if b < 0 else 1 + drawn(7, b, len(w) - 1)
            rolled = w[-s:] + w[:-s] if s else w
            held = [0.75, *rolled[:-1]]
            run = [h * r - 0.0005 * abs(h - (held[i - 1] if i else h)) for i, (h, r) in enumerate(zip(held, x))]
            assert abs(got[key, b] - (ratio(run) - ratio(x))) < 1e-8
    assert got["one", -1] is None and ("one", 0) not in got


def test_shifted_medians(spark):
    rnd = random.Random(6)
    rows = [("a", i, rnd.choice(["low", "high", None, None]), None if i > 50 else rnd.random()) for i in range(60)]
    got = {(r.side, r.b): r.m for r in T.shifted_medians(spark.createDataFrame(rows, "k string, pos long, side string, v double"), ["k"], "side", "v", 20, 3).collect()}
    for side in ("low", "high"):
        for b in range(-1, 20):
            s = 0 if b < 0 else 1 + drawn(3, b, 59)
            values = [rows[(i + s) % 60][3] for _, i, x, _ in rows if x == side]
            assert abs(got[side, b] - st.median(v for v in values if v is not None)) < 1e-12


def test_signal_quality(spark):
    v = [100.0] * 40 + [80.0 + i for i in range(70)]
    rows = [("s", dt.date(2024, 1, 1) + dt.timedelta(i), x, {40: ["low", "both"], 45: ["both"], 100: ["both"]}.get(i)) for i, x in enumerate(v)]
    got = {r.gate: r for r in E.signal_quality(spark.createDataFrame(rows, "series_id string, d date, v double, on_ array<string>"), "on_", "gate").collect()}
    assert set(got) == {"low", "both"} and (got["low"].n, got["both"].n) == (1, 2)  # the one at 100 has no 60 rows ahead
    r = got["low"]
    assert (r.tier1, r.tier2, r.tier3, r.lag, r.mae, r.mfe, r.r20, r.r60) == (1.0, 1.0, 1.0, 0.0, 0.0, 0.25, 0.25, 0.75)


def test_specs(spark):
    rows = [(s, dt.date(2024, 1, i), float(i)) for s in "ab" for i in range(1, 6) if (s, i) != ("b", 3)]
    df = spark.createDataFrame(rows, "series_id string, d date, v double")
    specs = [{"id": "a", "name": "x", "since": "2024-01-02", "width": 2}, {"id": "b", "name": "y", "t": "diff", "since": "2030-01-01"}]
    got = S.materialise(df, specs, aligned=True).orderBy("name", "d").collect()
    assert [(r.name, r.d.day, r.v, r.derived, r.style) for r in got] == [("x", i, float(i), False, {"width": "2"}) for i in (2, 4, 5)] + [("y", 4, 2.0, False, {}), ("y", 5, 1.0, False, {})]
    assert S.materialise(df, specs).where("name = 'x'").count() == 4


def test_headlines_and_quotas(spark):
    texts = [
        ("no heading\nat all", ""), (None, ""), ("", ""), ("## 一、主張：Rates fall \nx", "Rates fall"), ("# Why?\n\n## next\n **Because** it is。And more", "Because it is"),
        ("# 2) what is 什麼\n" + "y" * 50, "y" * 40 + "…"), ("# Alone?", "Alone?"), ("#\n", ""),
    ]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string").select("i", C.headline(F.col("t")).alias("h")).orderBy("i").collect()
    assert [r.h for r in got] == [h for _, h in texts]
    raw = ['{"error": {"details": [{"retryDelay": "31.5s"}, {"violations": [{"quotaId": "GeneratePerDay"}]}]}}', '{"error": {"message": "wait"}}', "x retryDelay': '7s', 3 per day", None, "{}"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "i int, t string").select("i", C.quota_error(F.col("t")).alias("q")).orderBy("i").collect()
    assert [tuple(r.q) for r in got][:4] == [(33, "GeneratePerDay", True), (None, "wait", False), (9, raw[2], True), (None, "", False)]
