"""Resampling of all series against plain loops."""

import random
from statistics import median

import numpy as np

from larkspur.operators import stats as T


def number(seed, b, k, n):
    return (b * 1103 + k * 12289 + seed * 7919 + 12345) * 69069 % 2147483647 * 16807 % 2147483647 % n


def test_every_series_has_its_effect_and_detectable_shift(spark):
    rng = random.Random(4)
    sets = {"a": [(rng.random() < 0.2, rng.gauss(0, 0.1)) for _ in range(200)], "b": [(i % 9 == 0, rng.random()) for i in range(90)], "short": [(True, 1.0)] * 5}
    base = spark.createDataFrame([(s, i, v, f) for s, rows in sets.items() for i, (f, v) in enumerate(rows)], "series_id string, pos long, v double, flag boolean")
    got = {r.series_id: r for r in T.bootstrap_effect(base, "series_id", "flag", "v", 7, draws=60).collect()}
    events = spark.createDataFrame([("a", 9), ("b", 2)], "series_id string, n_events long")
    least = {r.series_id: r for r in T.min_detectable(base, events, "series_id", "v", draws=300).collect()}
    assert set(got) == set(least) == set(sets)
    assert (got["short"].point, got["short"].low) == (None, None) and least["b"].shift is None and least["short"].n_events == 0
    effect = lambda rows: median(v for f, v in rows if f) - median(v for _, v in rows) if sum(f for f, _ in rows) >= 3 else None
    for s in "ab":
        rows, n = sets[s], len(sets[s])
        drawn = [[rows[(number(0, b, i // 7, n) + i % 7) % n] for i in range(n)] for b in range(60)]
        e = [x for x in map(effect, drawn) if x is not None]
        want = (effect(rows), np.percentile(e, 5), np.percentile(e, 95))
        assert np.allclose((got[s].point, got[s].low, got[s].high), want, atol=1e-6)
    m = np.array([median(sets["a"][number(1, b, k, 200)][1] for k in range(9)) for b in range(300)])
    crit = np.percentile(m, 95)
    assert abs(least["a"].crit - crit) < 1e-6
    assert least["a"].shift == next(round(s * 0.005, 3) for s in range(160) if np.mean(m + s * 0.005 > crit) >= 0.8)
