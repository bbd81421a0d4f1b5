"""Repeated blocks are found without a shuffle, in texts of many pieces, by comparison of tokens and not of sums."""

import numpy as np

from larkspur.operators import text as X
from larkspur.plans import registry


def slowly(tokens, k):
    seen, out, before = {}, [], {}
    for p in range(len(tokens) - k + 1):
        first = seen.setdefault(tuple(tokens[p : p + k]), p)
        if first < p:
            before[p] = first
            if before.get(p - 1, -2) + 1 == first:
                out[-1][2] += 1
            else:
                out.append([first, p, k])
    return sorted(map(tuple, out))


def test_no_shuffle(spark):
    for name in ("significant_repeats_150", "block_repeats"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


def test_texts_of_many_pieces_and_batches(spark):
    draws = np.random.default_rng(5)
    texts = {f"k{i}": [f"w{x}" for x in draws.integers(0, 9, size=n)] for i, n in enumerate((0, 2, 3, 4, 5, 1000, 3, 300, 2500, 4))}
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()] + [("null", None)], "id string, text string").coalesce(1)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = X.block_repeats(docs, "id", "text", 3, piece=4).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    for k, v in texts.items():
        assert sorted((r.first, r.second, r.tokens) for r in rows if r.id == k) == slowly(v, 3)
    assert {r.id for r in rows} <= set(texts)


def test_grams_with_the_same_sum_are_told_apart(monkeypatch):
    monkeypatch.setattr(X, "_ODD", 0)
    hashes = np.random.default_rng(6).integers(-(2**63), 2**63 - 1, size=4)[np.random.default_rng(7).integers(0, 4, size=200)]
    assert sorted(map(tuple, X._repeats(hashes, 3).T.tolist())) == slowly(hashes.tolist(), 3)
