"""Large advisories come in parts: their frames are those of whole documents, and no row holds all cards of a day."""

import pytest
from test_frames import read
from test_oracles import SF as SMALL
from test_oracles import duck, plain  # noqa: F401

from larkspur.operators import frames
from larkspur.plans import documents, registry

SF = "/root/testdata/sf0.01"
HEAD = {"weekday": "day", "stamp": "s", "headline": "h", "window": {"from": "2026-08-19T07:00:00+08:00", "to": "2026-08-20T14:00:00+08:00"}, "now": "2026-08-21T23:00:00+08:00"}


def card(i, n, **more):
    return {"title": f"t{i}", "url": f"https://a/x/{i % 3}", "tone": "up", "tagcls": "news", "src": "s", "body": "b" * n} | more


def doc(date, groups):
    return HEAD | {"date": date, "cards": 9, "sections": [{"name": "one", "groups": groups}]}


def parts(spark, *keyed):
    rows = [x[1] for x in keyed]
    keys = spark.createDataFrame([(f"k{i}", k) for i, (k, _) in enumerate(keyed)], "key string, name string")
    return read(spark, "advisory", *rows).join(keys, "key").drop("key").withColumnRenamed("name", "key")


def deck():
    """Documents of two days, in two and three parts, with no cards in one of them."""
    a = [card(i, 10 * i, deep=i % 2 == 0, thread="t" if i % 4 == 0 else "") for i in range(9)]
    b = [card(i, 7 * i, bullets=["xy", None] if i == 2 else ["xy"]) for i in range(4)]
    return [
        ("a", doc("2026-08-20", [{"label": "x", "cards": a[:2]}])), ("a", doc("2026-08-20", [{"label": "x", "cards": a[2:7]}, {"label": "y", "cards": a[7:]}])),
        ("b", doc("2026-08-21", [{"label": "x", "cards": b[:1]}])), ("b", doc("2026-08-21", [{"label": "x", "cards": b[1:]}])), ("b", doc("2026-08-21", [])), ("c", HEAD | {"date": "2026-08-23"}), ("d", doc("2026-08-24", [])),
    ], [("a", doc("2026-08-20", [{"label": "x", "cards": a[:7]}, {"label": "y", "cards": a[7:]}])), ("b", doc("2026-08-21", [{"label": "x", "cards": b}])), ("c", HEAD | {"date": "2026-08-23"}), ("d", doc("2026-08-24", []))]


def test_days_of_parts(spark):
    cut, whole = deck()
    got, want = (sorted(frames.advisory_days(parts(spark, *x)).collect(), key=lambda r: r.key) for x in (cut, whole))
    assert got == want and len(got) == 4
    seen = {r.key: (r.n_cards, r.n_deep, r.n_threaded, r.deep_median, r.regular_median, r.has_previous) for r in got}
    # upper medians: of 0 20 40 60 80, of 10 30 50 70, of 2 9 23 and one that is null
    assert seen == {"a": (9, 5, 3, 40.0, 50.0, False), "b": (4, 0, 0, None, 23.0, True), "c": (None, None, 0, None, None, False), "d": (0, 0, 0, None, None, True)}


def test_no_row_holds_a_day(spark, monkeypatch):
    monkeypatch.setattr(documents, "PART", 20)
    sizes = [r.n for r in documents.advisory_documents(spark, SF).selectExpr("aggregate(flatten(transform(doc.sections, s -> transform(s.groups, g -> size(g.cards)))), 0, (a, n) -> a + n) AS n").collect()]
    assert sum(sizes) == 10000 and max(sizes) < 60


def test_cards_and_groups_of_parts(spark):
    cut, whole = deck()
    plan = read(spark, "plan", {"groups": [{"name": "x", "floor": {"weekday": 8, "weekend": 8}, "base": True}, {"name": "z"}]})
    for f in (frames.cards, lambda docs: frames.groups(docs, plan)):
        got, want = (sorted(map(str, f(parts(spark, *x)).collect())) for x in (cut, whole))
        assert got == want and len(set(got)) == len(got) > 8


@pytest.mark.parametrize("name", ["rules_nested_cards", "rules_nested_groups", "rules_nested_advisory_days"])
def test_queries_of_many_parts(spark, duck, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(documents, "PART", 4)
    assert documents.advisory_documents(spark, SMALL).count() > 150
    assert plain(registry.QUERIES[name](spark, SMALL).toPandas()) == plain(duck.execute(registry.ORACLES[name]).df())
