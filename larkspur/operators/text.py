"""Text mining: tokens with their lines, repeated blocks, loops, page furniture, speaker turns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larkspur.functions.scalars import SPACE, TURN, stamp_seconds, words


def _once(value: Column, keep: Callable[[Column], Column], f: Callable[[Column], Column]) -> Column:
    """An array of ``f(value)`` if ``keep(value)`` holds, else an empty one.

    ``value`` is bound by a lambda and computed once a row, however often both use it; a filter on a selected column would be
    pushed below the selection and compute it again.
    """
    return F.transform(F.filter(F.array(value), keep), f)


#: Fixed value: an odd factor, of which the places of a gram have the powers (modulo 2^64).
_ODD = 0x9E3779B97F4A7C15
#: All ends of lines.
LINE_END = r"\r\n|[\n-\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def lines(text: str) -> Column:
    """The lines of what follows the second ``---`` of a text (with one, what follows it; without, all)."""
    return F.split(F.element_at(F.split(F.col(text), "---", 3), -1), LINE_END)


def token_array(text: str) -> Column:
    """All tokens of a text in order, found line by line."""
    return F.flatten(F.transform(lines(text), words))


def tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, pos, token, line_no``; positions run through the document."""
    marked = F.transform(lines(text), lambda x, n: F.transform(words(x), lambda w: F.struct(w.alias("token"), n.alias("line_no"))))
    return docs.select(key, F.posexplode(F.flatten(marked)).alias("pos", "t")).select(key, F.col("pos").cast("long").alias("pos"), "t.token", "t.line_no")


def token_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, n, kinds, last, sha`` of each text with tokens: how many, how many kinds, the last position, a digest of all."""
    found = lambda t: F.struct(
        F.size(t).cast("long").alias("n"), F.size(F.array_distinct(t)).cast("long").alias("kinds"), (F.size(t) - 1).cast("long").alias("last"),
        F.sha2(F.array_join(t, " "), 256).alias("sha"),
    )
    return docs.select(key, F.inline(_once(token_array(text), lambda t: F.size(t) > 0, found)))


def block_repeats(docs: DataFrame, key: str, text: str, k: int, piece: int = 128) -> DataFrame:
    """Blocks of at least k tokens that stand again later in their text: ``key, first, second, tokens``.

    Each k-gram points to its first occurrence; repeats chain while both positions advance by one. Nothing is shuffled: a text goes to
    its task's Python in consecutive rows of ``piece`` tokens, so that batches are small whatever the texts, and only its blocks come
    back. Tokens are compared by 64-bit hashes, grams token by token.
    """
    cut = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - 1, F.lit(piece)), lambda i: F.slice(h, i + 1, F.lit(piece)))
    hashed = _once(F.transform(token_array(text), lambda x: F.xxhash64(x)), lambda h: F.size(h) > k, cut)
    pieces = docs.select(key, F.posexplode(F.flatten(hashed)).alias("i", "hashes"))
    kind = StructType([docs.schema[key], *(StructField(c, LongType()) for c in ("first", "second", "tokens"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _whole(batches):
            found = [_repeats(x, k) for x in texts]
            rows = np.repeat(np.arange(len(found)), [x.shape[1] for x in found])
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), *map(pa.array, np.hstack(found))], kind.names)

    return pieces.mapInArrow(run, kind)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Keys and hashes of the texts that end in each batch; the last text of a batch may go on in the next."""
    key, held = None, []
    for batch in batches:
        keys, places, lists = batch.columns
        ends, heads = np.asarray(lists.offsets), np.flatnonzero(np.asarray(places) == 0)
        before, *texts = np.split(np.asarray(lists.flatten()), ends[heads] - ends[0])
        held.append(before.copy())
        if len(heads):
            if key is not None:
                yield key, [np.concatenate(held)]
            if len(heads) > 1:
                yield keys.take(pa.array(heads[:-1])), texts[:-1]
            key, held = keys.take(pa.array(heads[-1:])), [texts[-1].copy()]
    if key is not None:
        yield key, [np.concatenate(held)]


def _repeats(hashes: np.ndarray, k: int) -> np.ndarray:
    """The blocks of one text of more than k tokens: rows of first places, second places and lengths."""
    n = len(hashes) - k + 1
    at = hashes.view(np.uint64)
    first, later = _first_places(sum(at[j : j + n] * np.uint64(pow(_ODD, j, 1 << 64)) for j in range(k)))
    if not all(np.array_equal(at[first[later] + j], at[later + j]) for j in range(k)):  # two sums of different grams are equal
        first, later = _first_places(np.unique(np.lib.stride_tricks.sliding_window_view(at, k), axis=0, return_inverse=True)[1])
    starts = np.flatnonzero((np.diff(later, prepend=-2) != 1) | (np.diff(first[later], prepend=-2) != 1))
    return np.stack([first[later[starts]], later[starts], np.diff(starts, append=len(later)) + k - 1])


def _first_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the first place of its value, and the places that are not the first."""
    order = np.argsort(values)
    starts = np.flatnonzero(np.diff(values[order], prepend=values[order[:1]] + 1))
    first = np.empty(len(values), dtype=np.int64)
    first[order] = np.repeat(np.minimum.reduceat(order, starts), np.diff(starts, append=len(order)))
    return first, np.flatnonzero(first < np.arange(len(first)))


def repeat_share(repeats: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """How much of each document stands in repeated blocks: ``key, covered, share, severity``."""
    covered = repeats.select(key, F.explode(F.sequence("second", F.col("second") + F.col("tokens") - 1)).alias("pos"))
    got = covered.groupBy(key).agg(F.count_distinct("pos").alias("covered"))
    share = F.col("covered") / F.col("total")
    return totals.join(got, key).select(
        key, "covered", F.round(share, 6).alias("share"),
        F.when(share > 0.25, "severe").when(share > 0.1, "notable").otherwise("minor").alias("severity"),
    )


def collapse_loops(docs: DataFrame, key: str, text: str, least: int = 20) -> DataFrame:
    """``key, words, removed`` of each text with tokens: words left when a token repeated ``least`` times or more in a row counts once.

    Tokens stand between white space, as they are but for their case.
    """
    starts = lambda t: F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: (i == 1) | (F.get(t, i - 1) != F.get(t, i - 2)))
    lengths = lambda s, n: F.zip_with(F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n + 1)), s, lambda end, start: end - start)
    extra = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda acc, n: acc + F.when(n >= least, n - 1).otherwise(0))
    removed = lambda t: _once(starts(t), lambda s: F.lit(True), lambda s: extra(lengths(s, F.size(t))))[0]
    spaced = F.filter(F.split(F.lower(text), f"{SPACE}+"), lambda w: w != "")
    counted = _once(spaced, lambda t: F.size(t) > 0, lambda t: F.struct(F.size(t).cast("long").alias("n"), removed(t).alias("removed")))
    return docs.select(key, F.inline(counted)).select(key, (F.col("n") - F.col("removed")).alias("words"), "removed")


def spoken_words(docs: DataFrame, key: str, text: str, least: int = 20) -> DataFrame:
    """``key, words, removed``: as ``collapse_loops``, without the stamps and names that start turns."""
    return collapse_loops(docs.select(key, F.regexp_replace(text, TURN, "").alias(text)), key, text, least)


def page_furniture(pages: DataFrame, doc: str, page: str, text: str, edge: int = 3, share: float = 0.6) -> DataFrame:
    """Lines in the first or last ``edge`` non-blank lines of most pages of a document: ``doc, line, pages``.

    Lines are alike when they are so with single spaces; pages without text do not count.
    """
    single = F.transform(F.split(text, LINE_END), lambda x: F.trim(F.regexp_replace(x, f"{SPACE}+", " ")))
    split = F.filter(single, lambda x: x != "")
    n = F.size("s")
    at_edge = F.array_union(F.slice("s", F.lit(1), F.least(F.lit(edge), n)), F.slice("s", F.greatest(n - edge + 1, F.lit(1)), F.lit(edge)))
    filled = pages.select(doc, page, split.alias("s")).where(n > 0)
    seen = filled.select(doc, page, F.explode(at_edge).alias("line")).where(F.length("line").between(4, 119))
    total = filled.groupBy(doc).agg(F.count_distinct(page).alias("total"))
    return seen.groupBy(doc, "line").agg(F.count_distinct(page).alias("pages")).join(total, doc).where(
        F.col("pages") >= F.greatest(F.lit(2.0), F.lit(share) * F.col("total"))
    ).drop("total")


def speaker_runs(turns: DataFrame, key: str, order: str, speaker: str, size: Column) -> DataFrame:
    """Runs of turns by one speaker: ``key, speaker, start, turns, size``."""
    w = Window.partitionBy(key).orderBy(order)
    new = F.coalesce(~F.lag(speaker).over(w).eqNullSafe(F.col(speaker)), F.lit(True))
    first = F.row_number().over(w) == 1
    runs = turns.withColumn("run", F.sum((new | first).cast("int")).over(w))
    return runs.groupBy(key, "run", F.col(speaker).alias("speaker")).agg(
        F.min(order).alias("start"), F.count("*").alias("turns"), F.sum(size).alias("size")
    ).drop("run")


def stamped_lines(docs: DataFrame, key: str, text: str, drop: int) -> DataFrame:
    """``key, line_no, first, tokens, stamp, segment``: where the tokens of each line start, its time stamp carried forward from the last
    stamped line, and the number of its segment; a stamp more than ``drop`` seconds below the one before starts a segment."""
    found = F.transform(lines(text), lambda x, n: F.struct(n.alias("line_no"), F.size(words(x)).alias("tokens"), stamp_seconds(x).alias("own")))
    rows = docs.select(key, F.inline(found))
    w = Window.partitionBy(key).orderBy("line_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last("own", ignorenulls=True)
    reset = F.coalesce(last.over(before) - F.col("own") > drop, F.lit(False)).cast("int")
    rows = rows.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0))).withColumn("stamp", last.over(w)).withColumn("reset", reset)
    return rows.withColumn("segment", 1 + F.sum("reset").over(w)).select(key, "line_no", "first", "tokens", "stamp", "segment")


def duplicate_map(docs: DataFrame, repeats: DataFrame, key: str, text: str, drop: int = 60, shown: int = 14) -> DataFrame:
    """Repeated blocks (``key, first, second, tokens``) with the segments and times of both places and the first ``shown`` tokens.

    Only texts with blocks are read again. A block meets the lines of its text by bisection in their sorted starts, inside the row.
    """
    texts = docs.join(repeats.select(key).distinct(), key, "left_semi")
    spoken = stamped_lines(texts, key, text, drop).where("tokens > 0")
    at = spoken.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "stamp", "segment"))).alias("lines"), F.sum("tokens").alias("total"))
    shows = texts.select(key, token_array(text).alias("all"))

    def line(pos: Column) -> Column:
        """The last line that starts at or before a token."""
        step = lambda i, width: F.when(F.try_element_at(F.col("lines"), i + width)["first"] <= pos, i + width).otherwise(i)
        return F.element_at("lines", F.aggregate(F.array(*(F.lit(1 << b) for b in reversed(range(24)))), F.lit(0), step))

    end = lambda c: F.least(F.col(c) + F.col("tokens"), F.col("total")) - 1
    places = {"first_seg": (F.col("first"), "segment"), "first_from": (F.col("first"), "stamp"), "first_to": (end("first"), "stamp"), "dup_seg": (F.col("second"), "segment"), "dup_from": (F.col("second"), "stamp"), "dup_to": (end("second"), "stamp")}
    snippet = F.array_join(F.slice("all", F.col("first").cast("int") + 1, shown), " ")
    return repeats.join(at, key).join(shows, key).select(key, "first", "second", "tokens", *(line(p)[f].alias(c) for c, (p, f) in places.items()), snippet.alias("snippet"))


#: A line of a turn, the names that stand for no person, and what a name of a person does not look like.
TURN_LINE = r"^\[(?:(\d{1,2}):)?(\d{1,2}):(\d{2})\]\s*([^:：]{1,48})[:：]"
GENERIC = r"(?i)(speaker|announcer|unknown|host|guest)"
MALFORMED = r"^(?:\S+\s+){4,}\S|^[^\p{L}\p{N}_]|\[|\d"


def label_checks(docs: DataFrame, key: str, text: str, hosts: str, alone: int = 900) -> DataFrame:
    """What is suspicious about the speaker labels of a stamped transcript: ``key, turns, speakers, unlabelled, malformed, merged, mixed, longest, alone``.

    ``unlabelled``: over a fifth of the stamped lines have no label. ``malformed``: names of persons that look like speech. ``merged``: one speaker
    although there are several hosts (the number in ``hosts``). ``mixed``: names and at least 40 % stand-ins. ``longest``: seconds of the longest run
    of one speaker until another answers (one more at the end); ``alone``: that is ``alone`` or more, with several speakers.
    """
    own = F.transform(F.split(text, LINE_END), lambda x: F.trim(x))
    part = lambda x, i: F.regexp_extract(x, TURN_LINE, i)
    at = lambda x: F.coalesce(part(x, 1).try_cast("int"), F.lit(0)) * 3600 + part(x, 2).cast("int") * 60 + part(x, 3).cast("int")
    turn = lambda x: F.struct(at(x).alias("at"), F.trim(part(x, 4)).alias("name"))
    d = docs.select(key, hosts, F.size(F.filter(own, lambda x: x.rlike(r"^\[\d"))).alias("stamped"), F.transform(F.filter(own, lambda x: x.rlike(TURN_LINE)), turn).alias("said"))
    names = F.array_distinct(F.transform("said", lambda t: t["name"]))
    d = d.withColumn("names", names).withColumn("real", F.filter("names", lambda n: ~n.rlike(GENERIC)))
    first = F.struct(F.get("said", F.lit(0))["at"].alias("start"), F.get("said", F.lit(0))["name"].alias("name"), F.lit(0).alias("longest"))

    def follow(acc: Column, t: Column) -> Column:
        other = ~acc["name"].eqNullSafe(t["name"])
        return F.struct(
            F.when(other, t["at"]).otherwise(acc["start"]).alias("start"), F.when(other, t["name"]).otherwise(acc["name"]).alias("name"),
            F.when(other, F.greatest(acc["longest"], t["at"] - acc["start"])).otherwise(acc["longest"]).alias("longest"),
        )

    end = F.struct((F.element_at("said", -1)["at"] + 1).alias("at"), F.lit(None).cast("string").alias("name"))
    longest = F.aggregate(F.concat("said", F.array(end)), first, follow, lambda a: a["longest"])
    n, generic = F.size("said"), F.size(F.filter("said", lambda t: t["name"].rlike(GENERIC)))
    d = d.withColumn("longest", F.when(n > 0, longest).otherwise(0))
    return d.select(
        key, n.alias("turns"), F.size("names").alias("speakers"), ((n == 0) | (n < 0.8 * F.col("stamped"))).alias("unlabelled"), F.size(F.filter("real", lambda x: x.rlike(MALFORMED))).alias("malformed"),
        ((F.size("names") == 1) & (F.col(hosts) > 1)).alias("merged"), ((generic > 0) & (F.size("real") > 0) & (generic >= 0.4 * n)).alias("mixed"), "longest",
        ((F.col("longest") >= alone) & (F.size("names") > 1)).alias("alone"),
    )


def identified(docs: DataFrame, key: str, text: str, patterns: dict[str, str], least: int = 3, margin: int = 3) -> DataFrame:
    """``key, best, hits, second, sure``: whose pattern a text meets most often (ties: the first name); sure from ``least`` hits on that are at least
    ``margin`` times those of the next."""
    counts = F.array_sort(F.array(*(F.struct((-F.regexp_count(text, F.lit(p))).alias("less"), F.lit(name).alias("name")) for name, p in patterns.items())))
    d = docs.select(key, counts.alias("c"))
    hits, second = -F.coalesce(F.col("c")[0]["less"], F.lit(0)), -F.coalesce(F.col("c")[1]["less"], F.lit(0))
    return d.select(key, F.col("c")[0]["name"].alias("best"), hits.alias("hits"), second.alias("second"), ((hits >= least) & (hits >= second * margin)).alias("sure"))
