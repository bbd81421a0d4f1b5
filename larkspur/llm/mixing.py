"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a token budget. Whole epochs over the source come first; the rest of the
budget is a weighted sample without replacement: each document gets an exponential key
``-ln(u) / w`` with ``u`` a hash of the row and ``w`` its quality weight, documents are sorted by key
inside their source, and the prefix sum of their sizes is cut at the budget. The document on
the cut contributes only the words that are left.

The prefix sum is distributed: each source is divided at the quantiles of its keys, and between two quantiles in steps of
equal length, into ranges of bounded size, whatever the weights; the
ranges' totals are summed in order, and only then rows are ordered inside their range, so a
source with a third of all rows spreads over many tasks. What is ordered as a whole is one row for each source.

Defined cases: null text has size 0; a null source is a source of its own, last in order; equal
keys are ordered by row id; repeated rows are documents of their own; no rows give no rows; texts of any length are read as a
whole; extra columns are not read, and pass through ``mixed_rows``; a null weight or one below 0.001 counts as 0.001.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.shared import place_in, shielded, written

#: White space that ends a word; everything else is part of one.
WORD = r"[^\x20\x09-\x0D]+"
#: Symbols that clean prose holds few of.
SYMBOLS = "%*&#$!|@^~<>{}[]\\=_+0123456789"
#: Rows of a key range, at least; ranges grow with the square root of a large source. Quantiles that divide a source first.
RANGE_ROWS, CUTS = 1024, 256


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """From 0.05 to 1: a factor for symbols (0.1 where every tenth character or more is one) and one for words that repeat (0.5 if all do)."""
    n = F.length(text)
    symbols = n - F.length(F.translate(text, SYMBOLS, ""))
    words = F.split(text, r"[\x20\x09-\x0D]+")
    clean = F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(9.0) * symbols / F.nullif(n, F.lit(0)))
    return F.coalesce(clean * (F.lit(0.5) + F.lit(0.5) * F.size(F.array_distinct(words)) / F.size(words)), F.lit(0.05))


def targets(sizes: DataFrame, weights: tuple[float, ...], max_epochs: float) -> DataFrame:
    """``source, n_rows, source_size, target`` from the sources' sizes (one small row per source).

    Sources in code point order, null last, weigh ``weights`` in turn. They share the sum of all
    sizes; a target stops at ``max_epochs`` times its source and the excess is shared again by
    weight. That water level is found in closed form: sources are capped in the order of
    ``cap / weight``, and the first one that the remaining level does not exceed ends it.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(everything))
        .withColumn("weight", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("cap") / F.col("weight") >= F.col("level"))
    first_free = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(all_rows)
    return leveled.select(
        "source",
        "n_rows",
        "source_size",
        F.least(F.col("cap"), F.coalesce(first_free, F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def _taken(docs: DataFrame, weights: tuple[float, ...], max_epochs: float, seed: int, weight: Column | None) -> DataFrame:
    """What ``mix`` returns, with the hash ``h`` of id and text and the whole ``epochs`` of the source."""
    text = docs["text"]
    w = F.greatest(F.coalesce((quality_weight(text) if weight is None else weight).cast("double"), F.lit(0.0)), F.lit(0.001))
    h = _hash(docs, seed)
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(2.0**53)
    sized = written(
        docs.select(docs["doc_id"], docs["source"].cast("string").alias("source"), n_words(text).alias("size"), (-F.log(u) / w).alias("key"), h.alias("h")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "sizes",
    )
    quantiles = F.percentile_approx("key", [i / CUTS for i in range(CUTS)], 10_000)
    sources = sized.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("source_size"), quantiles.alias("cuts"), F.max("key").alias("top")
    )
    sources = written(sources.withColumn("cuts", F.when(F.col("n_rows") > RANGE_ROWS, F.col("cuts"))), "mix-sources")
    plan = targets(sources.drop("cuts", "top"), weights, max_epochs)
    plan = (
        plan.withColumn("ratio", F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)))
        # a source without words has nothing to fill, and its documents come once
        .withColumn("epochs", F.floor(F.coalesce("ratio", F.lit(1.0)) + F.lit(1e-9)))
        .withColumn("rest", F.greatest(F.lit(0), F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")))
        .withColumn("finer", F.ceil(F.col("n_rows") / F.greatest(F.lit(float(RANGE_ROWS)), F.sqrt("n_rows")) / CUTS))
        .drop("ratio")
    )
    held = sources.select(F.col("source").alias("of_source"), "cuts", "top")
    plan = written(plan.join(held, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source"), "mix-plan")
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    rows = rows.withColumn("cell", F.coalesce(place_in(F.col("cuts"), F.col("key"), bits=CUTS.bit_length()), F.lit(0)))
    lo = F.try_element_at("cuts", F.greatest("cell", F.lit(1)))
    hi = F.coalesce(F.try_element_at("cuts", F.col("cell") + 1), "top")
    inside = F.coalesce((F.col("key") - lo) / F.nullif(hi - lo, F.lit(0.0)), F.lit(0.0))
    part = F.floor((F.col("cell") + F.least(F.greatest(inside, F.lit(0.0)), F.lit(0.999999))) * F.col("finer"))
    rows = rows.withColumn("part", part).drop("cuts", "top", "cell")
    totals = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("source").alias("s_source"),
        F.col("part").alias("s_part"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"),
    )
    order = Window.partitionBy("source", "part").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    ordered = rows.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0)))
    placed = ordered.join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("part") == F.col("s_part")))
    left = F.col("rest") - F.col("words_before") - F.col("inside")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("long").alias("taken"),
        "h",
        "epochs",
    )


def _hash(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"], F.lit(seed))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: float = 3, seed: int = 17, weight: Column | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document.

    ``taken`` counts the words that the mix takes of the document, repeats included. ``weight`` is a
    quality weight over the columns of ``docs``, by default ``quality_weight`` of the text.
    """
    return _taken(docs, weights, max_epochs, seed, weight).drop("h", "epochs")


@shielded("__h", "__source", "__times", "__rows", "__own", "__copy")
def mixed_rows(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: float = 3, seed: int = 17, weight: Column | None = None
) -> DataFrame:
    """``docs`` in the mix: each row as often as the mix takes it, the document on a cut if at least half is taken.

    Documents without words come once per whole epoch of their source and are never in a fraction. Rows that share doc_id, text and source
    are taken as often as all of them together, in turn.
    """
    times = F.when(F.col("size") == 0, F.col("epochs")).otherwise(F.round(F.col("taken") / F.nullif("size", F.lit(0))))
    taken = _taken(docs, weights, max_epochs, seed, weight).groupBy(F.col("h").alias("__h"), F.col("source").alias("__source"))
    taken = taken.agg(F.sum(times).cast("int").alias("__times"), F.count("*").cast("int").alias("__rows")).where("__times > 0")
    rows = docs.withColumn("__own", _hash(docs, seed))
    hits = rows.join(taken, (F.col("__own") == F.col("__h")) & docs["source"].cast("string").eqNullSafe(F.col("__source")))
    alone, several = hits.where("__rows = 1"), hits.where("__rows > 1")
    nth = F.row_number().over(Window.partitionBy("__h", "__source").orderBy(F.lit(1)))
    share = F.floor(F.col("__times") / F.col("__rows")) + (nth <= F.col("__times") % F.col("__rows")).cast("int")
    every = alone.unionByName(several.withColumn("__times", share.cast("int")).where("__times > 0"))
    return every.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
