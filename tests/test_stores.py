"""Incremental cache and published versions: stopped runs, failures, refused changes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.sources.incremental import Cache, Progress
from larkspur.sources.published import Refused, Store, System


def test_a_stopped_run_asks_only_for_what_is_missing(spark, tmp_path):
    asked = []

    def ask(days, fail_at=None):
        batch = [r.day for r in days.orderBy("day").collect()]
        if fail_at is not None and len(asked) + 1 == fail_at:
            raise ConnectionError("stopped")
        asked.append(batch)
        n = F.dayofmonth("day")
        return days.select("day", (n != 7).alias("ok"), F.when(n % 2 == 0, n.cast("double")).alias("v"))

    cache = Cache(spark, str(tmp_path))
    assert cache.read("x").count() == 0
    with pytest.raises(ConnectionError):
        cache.update("x", "2026-01-01", "2026-03-31", lambda d: ask(d, 3))
    assert [len(a) for a in asked] == [20, 20]
    first = {d for a in asked for d in a}
    asked.clear()
    progress = cache.update("x", "2026-01-01", "2026-03-31", ask)
    again = {d for a in asked for d in a}
    # days 7 failed, so they are asked again; the rest of the first run is not
    assert {d for d in first & again} == {d for d in first if d.day == 7} and all(d.weekday() < 5 for d in first | again)
    weekdays = [dt.date(2026, 1, 1) + dt.timedelta(i) for i in range(90)]
    want = {d: float(d.day) for d in weekdays if d.weekday() < 5 and d.day % 2 == 0}
    assert {r.day: r.v for r in cache.read("x").collect()} == want
    assert progress.tried == len(again) and progress.failed == sum(d.day == 7 for d in again) and not progress.suspicious()
    asked.clear()
    cache.update("x", "2026-01-01", "2026-03-31", ask)
    assert {d.day for a in asked for d in a} == {7} and cache.missing("y", "2026-01-01", "2026-01-04", weekdays=False).count() == 4
    assert Progress(60, 2, 0).suspicious() and not Progress(59, 0, 0).suspicious()


def test_data_without_a_manifest_are_not_read(spark, tmp_path):
    cache = Cache(spark, str(tmp_path))
    spark.sql("SELECT 'x' AS name, DATE '2026-01-01' AS day, 1D AS v").write.parquet(f"{tmp_path}/data/orphan")
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest" / ".half.json").write_text('{"name": "x"')
    assert cache.read("x").count() == 0 and cache.missing("x", "2026-01-01", "2026-01-01").count() == 1


def items(spark, *rows):
    return spark.createDataFrame([(dt.date(2026, 1, d), i, c) for d, i, c in rows], "day date, item string, content string")


def published(store, name):
    return sorted((r.day.day, r.item, r.content) for r in store.current(name).collect())


def test_a_frozen_day_stays(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.register(System("daily", "chart", "frozen"))
    assert store.publish("daily", items(spark, (1, "a", "x"), (1, "b", "y"))) == 1
    assert store.publish("daily", items(spark, (2, "a", "z"))) == 2
    assert store.publish("daily", items(spark, (1, "a", "x"), (1, "b", "y"))) == 3
    for bad in ([(1, "a", "x")], [(1, "a", "other"), (1, "b", "y")], [(1, "a", "x"), (1, "b", "y"), (1, "c", "new")]):
        with pytest.raises(Refused):
            store.publish("daily", items(spark, *bad))
    assert published(store, "daily") == [(1, "a", "x"), (1, "b", "y"), (2, "a", "z")]


def test_an_append_only_day_may_grow(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.register(System("weekly", "research", "append_only"))
    store.publish("weekly", items(spark, (1, "a", "x")))
    store.publish("weekly", items(spark, (1, "a", "x"), (1, "b", "y"), (3, "c", "z")))
    with pytest.raises(Refused) as gone:
        store.publish("weekly", items(spark, (1, "b", "changed")))
    assert gone.value.gone == ["2026-01-01 a"] and gone.value.changed == ["2026-01-01 b"]
    assert published(Store(spark, str(tmp_path)), "weekly") == [(1, "a", "x"), (1, "b", "y"), (3, "c", "z")]


def test_systems_and_ids(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.register(System("a", "s", "frozen"))
    with pytest.raises(ValueError):
        store.register(System("a", "s", "frozen"))
    for bad in (("b", "", "frozen"), ("b", "s", "whatever")):
        with pytest.raises(ValueError):
            System(*bad)
    assert store.systems() == {"a": System("a", "s", "frozen")} and store.current("a").count() == 0
    assert store.lock("checks", {"x", "y"}) == ([], ["x", "y"])
    assert store.lock("checks", {"x", "z"}) == (["y"], ["z"])
    assert store.lock("checks", {"x", "y", "z"}) == ([], ["z"]) and store.lock("checks", {"x", "y"}) == (["z"], [])


def test_a_refused_or_stopped_publication_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.register(System("daily", "chart", "append_only"))
    store.publish("daily", items(spark, (1, "a", "x")))
    monkeypatch.setattr(store, "_swap", lambda pointer: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        store.publish("daily", items(spark, (2, "a", "y")))
    assert published(Store(spark, str(tmp_path)), "daily") == [(1, "a", "x")]
