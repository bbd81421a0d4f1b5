"""Keyed upserts and guards on versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_first(frames: list[DataFrame], key: str) -> DataFrame:
    """Union in which the first frame that has a key wins (of repeats inside one, the smallest row)."""
    both = None
    for i, f in enumerate(frames):
        part = f.withColumn("__rank", F.lit(i))
        both = part if both is None else both.unionByName(part)
    w = Window.partitionBy(key).orderBy("__rank", *[c for c in frames[0].columns if c != key])
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__rank")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` with those of ``new`` in place of the same keys."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def canonical(columns: list[str]) -> Column:
    """One string for a row's content, whatever the order of its columns."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose row in ``new`` differs from the one in ``old`` or is gone: ``key, reason``."""
    rest = [c for c in old.columns if c != key]
    a = old.select(key, canonical(rest).alias("a"))
    b = new.select(key, canonical(rest).alias("b"))
    reason = F.when(F.col("b").isNull(), "gone").when(F.col("a") != F.col("b"), "changed")
    return a.join(b, key, "left").select(key, reason.alias("reason")).where("reason IS NOT NULL")


def frozen(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All differences, added keys included: an immutable table allows none."""
    added = new.join(old, key, "left_anti").select(key, F.lit("added").alias("reason"))
    return changed_keys(old, new, key).unionByName(added)


def preserving(old: DataFrame, new: DataFrame, key: str, kept: dict[str, object]) -> DataFrame:
    """Rows of ``new``; the ``kept`` columns come from ``old`` where it has them, else from their defaults."""
    held = old.select(key, *(F.col(c).alias(f"__{c}") for c in kept))
    out = new.drop(*kept).join(held, key, "left")
    return out.withColumns({c: F.coalesce(f"__{c}", F.lit(v)) for c, v in kept.items()}).drop(*(f"__{c}" for c in kept))


def first_write_wins(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """``key, value, revisions``: the first value stays; differing later ones are logged."""
    both = old.select(key, F.col(value).alias("a")).join(new.select(key, F.col(value).alias("b")), key, "full_outer")
    later = F.when(F.col("a") != F.col("b"), F.array("b")).otherwise(F.array().cast("array<string>"))
    return both.select(key, F.coalesce("a", "b").alias(value), later.alias("revisions"))


def prune_seen(seen: DataFrame, new: DataFrame, key: str, at: str, cutoff: Column) -> DataFrame:
    """Seen keys that are young enough, with the new ones added (latest time wins)."""
    both = seen.select(key, at).unionByName(new.select(key, at))
    return both.groupBy(key).agg(F.max(at).alias(at)).where(F.col(at) >= cutoff)
