"""Quotes in texts against a comparison of all pairs."""

import random

import pytest

from larkspur.functions import scalars as C
from larkspur.operators import joins as J
from larkspur.plans import registry


@pytest.mark.parametrize("most_keys", [J.MOST_KEYS, 0])
def test_every_quote_is_sought_in_every_text(spark, most_keys):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    texts = ["".join(word() + rng.choice([" ", "\n", "  "]) for _ in range(60)) for _ in range(30)]
    quotes = [t[a : a + n] for t in texts[:12] for a, n in ((3, 60), (17, 45), (30, 9), (0, 90))]
    # copies, shared runs of words, absent, empty and missing quotes
    quotes += [quotes[0], quotes[0] + "zz", "zz" + quotes[0], quotes[0].replace(" ", "\t", 1), "a", "", None, " ".join("abcabcabcabc"), word()]
    texts += [texts[0], "", None, quotes[0], "x" + quotes[0] + "y", " ".join("abcabcabcabc" * 3)]
    docs = [(None if i % 7 == 3 else i // 2 + 10**12, t) for i, t in enumerate(texts)]
    items = [(i + 100, q) for i, q in enumerate(quotes)]
    got = J.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, quote string"), "doc_id", "item_id", most_keys)
    want = [(d, i) for d, t in docs for i, q in items if t is not None and q is not None and q in t]
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, got.collect())) == order(want)


def test_items_above_forty_and_unequal_remainders_are_found(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    spark.createDataFrame([(1, f"before {text} after"), (2, "none")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(77, text), (3, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = registry.QUERIES["quote_search"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 3), (1, 77)]


def test_grounding_counts_documents_of_every_item_in_its_match_form(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"before {text} after"), (2, text.replace("w7 w8", "w7  w8")), (3, "none"), (4, None), (5, f"“{text}”")]
    items = [(77, text), (3, f'"{text}"'), (40, "w1 absent"), (41, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = registry.QUERIES["quote_grounding"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(3, 1, True), (40, 0, False), (41, 0, False), (77, 3, True)]


def test_grounded_looks_in_the_text_of_the_same_key(spark):
    quotes = spark.createDataFrame([("a", "x  y"), ("a", "z"), ("b", "x y"), ("c", "x")], "slug string, quote string")
    texts = spark.createDataFrame([("a", "w x y"), ("b", None)], "slug string, text string")
    got = J.grounded(quotes, texts, "slug", C.match_form).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", "x  y", True), ("a", "z", False), ("b", "x y", None), ("c", "x", None)], key=str)
