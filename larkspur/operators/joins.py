"""Join kinds of dated and keyed tables that have no single Spark operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reindex(index: DataFrame, series: DataFrame, on: list[str]) -> DataFrame:
    """All rows of the index, with nulls where the series has none."""
    return index.join(series, on, "left")


def forward_fill(df: DataFrame, key: str, order: str, value: str, limit: int) -> DataFrame:
    """Fills a null from at most ``limit`` rows before."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(-limit, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(frame))


def asof(left: DataFrame, right: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Each left row with the right side's latest value at or before it.

    Both sides are stacked and carried forward in one window: one shuffle, no range join.
    """
    a = left.withColumn("__side", F.lit(1)).withColumn("__value", F.lit(None).cast(right.schema[value].dataType))
    b = right.select(key, order, F.lit(0).alias("__side"), F.col(value).alias("__value"))
    w = Window.partitionBy(key).orderBy(order, "__side").rowsBetween(Window.unboundedPreceding, 0)
    filled = a.unionByName(b, allowMissingColumns=True).withColumn(value, F.last("__value", ignorenulls=True).over(w))
    return filled.where("__side = 1").drop("__side", "__value")


def nearest(left: DataFrame, right: DataFrame, key: str, order: str, value: str, days: int) -> DataFrame:
    """Each left row (unique by key and date) with the right value at the nearest date within ``days``; of two the later.

    Dates are cut into buckets of ``days``; a left row meets three of them by equality.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / days)
    near = right.select(F.col(key).alias("r_key"), F.col(order).alias("r_d"), value).withColumn("r_b", bucket("r_d"))
    probe = left.withColumn("b", F.explode(F.array(*(bucket(order) + i for i in (-1, 0, 1)))))
    gap = F.abs(F.datediff(order, "r_d"))
    met = probe.join(near, (F.col(key) == F.col("r_key")) & (F.col("b") == F.col("r_b")) & (gap <= days))
    best = met.groupBy(key, order).agg(F.max_by(value, F.struct(-gap, F.col("r_d"))).alias(value))
    return left.join(best, [key, order], "left")


def splice(history: DataFrame, tail: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``history`` with ``tail`` appended behind its last date, scaled to meet it there."""
    joint = history.groupBy(key).agg(F.max(order).alias("j"), F.max_by(value, order).alias("at"))
    base = tail.join(joint, key).where(F.col(order) <= F.col("j")).groupBy(key).agg(
        F.max_by(F.col(value), F.col(order)).alias("base")
    )
    scaled = tail.join(joint, key).join(base, key).where(F.col(order) > F.col("j"))
    scaled = scaled.withColumn(value, F.col(value) * F.col("at") / F.nullif("base", F.lit(0.0)))
    return history.select(key, order, value).unionByName(scaled.select(key, order, value))


def predecessor(df: DataFrame, order: str, key: str | None = None) -> DataFrame:
    """Adds ``previous``: the next smaller value of ``order`` among the rows of the key."""
    days = df.select(*([key] if key else []), order).distinct()
    w = Window.partitionBy(*([key] if key else [])).orderBy(order)
    return df.join(days.withColumn("previous", F.lag(order).over(w)), ([key] if key else []) + [order], "left")


def keyed_merge(a: DataFrame, b: DataFrame, key: str, manual: list[str], columns: list[str]) -> DataFrame:
    """Union of keys; ``manual`` columns prefer side a, the others side b, each the other side where null."""
    both = a.select(key, *(F.col(c).alias(f"a_{c}") for c in columns)).join(
        b.select(key, *(F.col(c).alias(f"b_{c}") for c in columns)), key, "full_outer"
    )
    pick = lambda c: F.coalesce(*(F.col(f"{s}_{c}") for s in ("ab" if c in manual else "ba"))).alias(c)
    return both.select(key, *map(pick, columns))


def drift(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that only one side has or whose values differ: ``key, state``."""
    left = a.select(key, F.col(value).alias("x"), F.lit(1).alias("in_a"))
    both = left.join(b.select(key, F.col(value).alias("y"), F.lit(1).alias("in_b")), key, "full_outer")
    state = (
        F.when(F.col("in_b").isNull(), "only_left").when(F.col("in_a").isNull(), "only_right")
        .when(~F.col("x").eqNullSafe(F.col("y")), "differs")
    )
    return both.select(key, state.alias("state")).where("state IS NOT NULL")


def grounded(quotes: DataFrame, texts: DataFrame, key: str, normalise) -> DataFrame:
    """Adds ``found``: whether the normalised quote stands in the normalised text of the same key; null without a text."""
    docs = texts.select(key, normalise(F.col("text")).alias("__text"))
    return quotes.join(docs, key, "left").withColumn(
        "found", F.col("__text").contains(normalise(F.col("quote")))
    ).drop("__text")


def last_session(asked: DataFrame, sessions: DataFrame, key: str, day: str, days: int = 10) -> DataFrame:
    """Adds ``session`` and ``looked_back``: the last of the ``days`` days before each asked one that has a session; null if none has.

    Each session is dealt to the days that may ask for it, so both sides meet by equality.
    """
    ahead = sessions.select(key, F.col(day).alias("session")).distinct().withColumn("back", F.explode(F.sequence(F.lit(1), F.lit(days))))
    near = ahead.groupBy(key, F.date_add("session", F.col("back")).alias(day)).agg(F.max("session").alias("session"))
    return asked.join(near, [key, day], "left").withColumn("looked_back", F.datediff(day, "session"))


#: Words of the run that keys a quote, and keys that are looked up inside the scan of the texts.
GRAM, MOST_KEYS = 8, 4096


def grams(pieces: Column) -> Column:
    """The hashes of all runs of ``GRAM`` words of an array of words."""
    return F.when(
        F.size(pieces) >= GRAM, F.transform(F.sequence(F.lit(1), F.size(pieces) - GRAM + 1), lambda i: F.xxhash64(F.slice(pieces, i, GRAM)))
    ).otherwise(F.array().cast("array<bigint>"))


def contained(docs: DataFrame, quotes: DataFrame, key: str, quote_key: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """``key, quote_key`` of every text of ``docs`` and every ``quote`` that stands in it, character by character.

    Words are split at white space. All words of a quote but the first and last are whole words of any text that holds it, so
    a run of them, the one that fewest quotes share, finds the candidates; ``contains`` decides. Up to ``most_keys`` keys are
    looked up in the scan of the texts, without a shuffle; more are joined by key, where Spark splits frequent ones.
    Quotes with too few words are compared with every text. Null texts and quotes give no rows.
    """
    split = lambda c: F.split(c, r"\s+")
    inner = F.transform(F.array(split(F.col("quote"))), lambda w: F.slice(w, F.lit(2), F.greatest(F.size(w) - 2, F.lit(0))))[0]
    distinct = quotes.where("quote IS NOT NULL").select("quote").distinct().withColumn("inner", inner)
    each = distinct.where(F.size("inner") >= GRAM).select("quote", F.explode(F.array_distinct(F.transform(F.array("inner"), grams)[0])).alias("gram"))
    shared = each.groupBy("gram").agg(F.count("*").alias("n"))
    keyed = each.join(shared, "gram").groupBy("quote").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    texts = docs.where("text IS NOT NULL").select(key, "text")
    own = F.array_distinct(F.transform(F.array(split(F.col("text"))), grams)[0])
    found = [r.gram for r in keyed.select("gram").distinct().limit(most_keys + 1).collect()]
    if len(found) <= most_keys:
        hits = texts.withColumn("gram", F.explode(F.filter(own, lambda g: g.isin(found)))) if found else texts.withColumn("gram", F.lit(0)).limit(0)
        pairs = hits.join(F.broadcast(keyed), "gram")
    else:
        # rows are told apart by id and text, so null and repeated ids stay apart
        marked = texts.withColumn("__mark", F.xxhash64("text"))
        near = marked.select(key, "__mark", F.explode(own).alias("gram")).join(keyed, "gram").select(F.col(key).alias("__key"), F.col("__mark").alias("__of"), "quote").distinct()
        pairs = marked.join(near, (F.col("__mark") == F.col("__of")) & F.col(key).eqNullSafe(F.col("__key")))
    whole = pairs.where(F.contains("text", "quote")).select(key, "quote")
    short = texts.join(distinct.where(F.size("inner") < GRAM).select("quote"), F.contains("text", "quote")).select(key, "quote")
    return whole.unionByName(short).join(quotes.select(quote_key, "quote"), "quote").select(key, quote_key)


def shared_keys(new: DataFrame, old: DataFrame, key: str, exempt: DataFrame | None = None) -> DataFrame:
    """Rows of ``new`` whose key an earlier version has too, except exempt ones."""
    hits = new.join(old.select(key).distinct(), key, "left_semi")
    return hits.join(exempt.select(key), key, "left_anti") if exempt is not None else hits
