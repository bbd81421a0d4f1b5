"""Phrase collocation mining: count-min sketches first, exact counts of the survivors second.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs; all counts are per
language. Pass one adds every phrase of one to five words to a count-min sketch per task. A cell stops at the least count that
matters, so it is one byte; sketches are merged cell by cell, and only whether a cell has reached the least count is kept: one bit. That
bitmap has a fixed size (``DEPTH * WIDTH`` bits, 8 MB) and is what pass two gets. Sketches never underestimate, so no frequent phrase is lost.

Pass two counts exactly those phrases whose cells have all reached the least count and whose inner phrases, never rarer, have too.
Occurrences are first added up in each task, then by Spark on the phrase itself; both passes take a few tasks for each core, since every
task has a sketch or partial counts of its own. On inputs whose distinct phrases fill the sketch more
phrases survive and are counted, which costs time and changes no result; ``WIDTH`` is the parameter to raise then.

Each candidate gets the least score ``floor(1000 * a * n / (l * r))`` of its cuts into two parts, in decimals of 38 digits, and is dropped where a
longer candidate around it occurs as often. Counts of parts come by joins: a part is never rarer than its phrase, so it has survived too.

Defined cases: null text is empty, null lang is ``und``; texts without words count nothing; repeated rows and equal texts count as often as
they occur; ties of a score go to the larger count, then to the phrase in byte order; no rows give no rows; other columns are not read; a
long text is cut into blocks of words that overlap by four words, so each phrase is counted once, where it starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.hashing import Bytes, mix
from larkspur.llm.shared import text_or_empty, written

MOST_WORDS = 5
LEAST_COUNT = 100
TOP = 2000
#: Rows and cells of a row of a sketch, cells of a merged part; powers of two.
DEPTH, WIDTH, PART = 2, 1 << 25, 1 << 18
#: Different phrases that a task keeps before it hands their counts on.
KEPT = 1 << 18
#: Bytes of normalised text that are handled at once.
BLOCK = 1 << 21
#: A-Z to a-z, tab to blank, ends of pieces to a line end.
_PLAIN = bytes(10 if c in b".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: A second, unrelated byte value, so that two hashes of the same bytes are independent.
_OTHER = bytes((c * 167 + 73) % 256 for c in range(256))


class Block(NamedTuple):
    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    #: The piece and the language (a place in ``langs``) of each word.
    piece: np.ndarray
    lang: np.ndarray
    #: Phrases that start at one of so many first words are counted; the rest are looked at only.
    counted: int


def plain(text: bytes) -> bytes:
    """Words with one blank between them and one line end between pieces."""
    data = re.sub(rb" {2,}", b" ", text.translate(_PLAIN))
    return re.sub(rb" ?\n[ \n]*", b"\n", data).strip(b" \n")


def blocks(texts: list[bytes], langs: np.ndarray) -> Iterator[Block]:
    """The words of all texts, in blocks of about ``BLOCK`` bytes."""

    def block(parts: list[bytes], own: list[int], counted: int | None = None) -> Block:
        data = b"\n".join(parts)
        raw = np.frombuffer(data, np.uint8)
        gap = np.flatnonzero((raw == 32) | (raw == 10))
        starts, ends = np.concatenate(([0], gap + 1)), np.concatenate((gap, [len(data)]))
        piece = np.concatenate(([0], np.cumsum(raw[gap] == 10)))
        text = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), starts, "right")
        return Block(data, starts, ends, piece, np.array(own)[text], len(starts) if counted is None else counted)

    parts, own, size = [], [], 0
    for text, lang in zip(texts, langs.tolist()):
        data = plain(text)
        if not data:
            continue
        if len(data) > BLOCK:
            raw = np.frombuffer(data, np.uint8)
            gap = np.concatenate(([-1], np.flatnonzero((raw == 32) | (raw == 10)), [len(data)]))
            at = 0
            while at < len(gap) - 1:
                stop = max(at + 1, int(np.searchsorted(gap, gap[at] + BLOCK)))
                stop = min(stop, len(gap) - 1)
                seen = min(stop + MOST_WORDS - 1, len(gap) - 1)
                yield block([data[gap[at] + 1 : gap[seen]]], [lang], stop - at)
                at = stop
            continue
        if parts and size + len(data) > BLOCK:
            yield block(parts, own)
            parts, own, size = [], [], 0
        parts.append(data)
        own.append(lang)
        size += len(data) + 1
    if parts:
        yield block(parts, own)


def batch_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list[str]]]:
    for batch in batches:
        lang = batch.column("lang").dictionary_encode()
        names = lang.dictionary.to_pylist()
        at, texts, size = 0, batch.column("text"), 0
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        codes = lang.indices.to_numpy(zero_copy_only=False)
        for end in range(1, len(batch) + 1):
            size += lengths[end - 1]
            if size >= 4 * BLOCK or end == len(batch):
                for b in blocks(texts.slice(at, end - at).to_pylist(), codes[at:end]):
                    yield b, names
                at, size = end, 0


class Phrases:
    """The phrase hashes of a block."""

    def __init__(self, block: Block, names: list[str]):
        self.block, self.bytes = block, Bytes(block.data)
        self.salt = np.array([xxhash.xxh64_intdigest(n, 7) for n in names], np.uint64)[block.lang]

    def starts(self, words: int) -> np.ndarray:
        """The words at which a phrase of so many words starts."""
        piece, n = self.block.piece, min(self.block.counted, len(self.block.piece) - words + 1)
        return np.flatnonzero(piece[:n] == piece[words - 1 : words - 1 + n]) if n > 0 else np.empty(0, np.int64)

    def hashes(self, at: np.ndarray, words: int, of: Bytes | None = None) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((of or self.bytes).ranges(self.block.starts[at], self.block.ends[at + words - 1]) + self.salt[at])

    def second(self) -> Bytes:
        return Bytes(self.block.data.translate(_OTHER))


class Counts:
    """Adds up the phrases of a task. What exceeds ``KEPT`` different phrases is handed on, so memory is bounded."""

    def __init__(self):
        self.totals: dict[str, int] = {}
        self.langs: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, block: Block, names: list[str], at: np.ndarray, words: np.ndarray, hashes: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The occurrences at the words ``at``, of so many words each. Two hashes tell phrases apart; texts are cut out for one of each."""
        first, n, order = self._same(hashes, other, np.ones(len(at), np.int64))
        at, words = at[order][first], words[order][first]
        spans = zip(block.starts[at].tolist(), block.ends[at + words - 1].tolist())
        text = np.empty(len(at), object)
        text[:] = [block.data[s:e] for s, e in spans]
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in names], np.int32)[block.lang[at]]
        self.parts.append((hashes[order][first], other[order][first], n, lang, text))
        self.size += len(at)
        if self.size > 2 * KEPT:
            self._combine()
            if self.size > KEPT:
                yield from self._handed_on()

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._combine()
        yield from self._handed_on()
        none = pa.nulls(len(self.totals), pa.string())
        yield self._batch(pa.array(list(self.totals), pa.string()), none, pa.array(self.totals.values(), pa.int64()))

    @staticmethod
    def _same(hashes: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(hashes)
        h, o = hashes[order], other[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (o[1:] != o[:-1]))))
        return first, np.add.reduceat(n[order], first) if len(first) else n[:0], order

    def _combine(self) -> None:
        if len(self.parts) > 1:
            hashes, other, n, lang, text = (np.concatenate(x) for x in zip(*self.parts))
            first, n, order = self._same(hashes, other, n)
            kept = order[first]
            self.parts = [(hashes[kept], other[kept], n, lang[kept], text[kept])]
            self.size = len(kept)

    def _handed_on(self) -> Iterator[pa.RecordBatch]:
        names = pa.array(list(self.langs), pa.string())
        for _, _, n, lang, text in self.parts:
            for at in range(0, len(n), 1 << 16):
                own = pa.DictionaryArray.from_arrays(pa.array(lang[at : at + (1 << 16)]), names).dictionary_decode()
                yield self._batch(own, pa.array(text[at : at + (1 << 16)], pa.binary()).cast(pa.string()), pa.array(n[at : at + (1 << 16)]))
        self.parts, self.size = [], 0

    @staticmethod
    def _batch(lang: pa.Array, phrase: pa.Array, a: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, phrase, a], ["lang", "phrase", "a"])


def cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    """The cells of a row of the sketch: two halves of the hash serve two rows, further rows mix it again."""
    for _ in range(row // 2):
        hashes = mix(hashes + np.uint64(row))
    return ((hashes >> np.uint64(32 * (row % 2))) & np.uint64(width - 1)).astype(np.uint32)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each value of a sorted array, and how often it stands there."""
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.empty(0, np.int64)
    return first, np.diff(np.concatenate((first, [len(ordered)])))


def sketched(docs: DataFrame, most_words: int, least: int, width: int) -> DataFrame:
    """``part, cells``: the parts of one sketch per task that have any count. A cell stops at ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((DEPTH, width), np.uint8)
        for block, names in batch_blocks(batches):
            phrases = Phrases(block, names)
            hashes = np.concatenate([phrases.hashes(phrases.starts(k), k) for k in range(1, most_words + 1)])
            for row in range(DEPTH):
                ordered = np.sort(cells(hashes, row, width))
                first, n = _runs(ordered)
                cell = ordered[first]
                sketch[row, cell] = np.minimum(least, sketch[row, cell] + n)
        size = min(PART, width)
        for part, counts in enumerate(sketch.reshape(-1, size)):
            if counts.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["part", "cells"])

    return docs.mapInArrow(run, "part int, cells binary")


def merged(sketches: DataFrame, least: int) -> DataFrame:
    """``part, bits``: which cells of each part reach ``least`` when all sketches are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("cells")):
                more = np.frombuffer(counts.as_buffer(), np.uint8)
                so_far = total.get(part)
                total[part] = more.copy() if so_far is None else np.minimum(least, so_far + more.astype(np.uint16)).astype(np.uint8)
        bits = [np.packbits(t >= least, bitorder="little").tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(bits, pa.binary())], ["part", "bits"])

    return sketches.repartition("part").mapInArrow(run, "part int, bits binary")


def reached(docs: DataFrame, most_words: int, least: int, width: int) -> np.ndarray:
    """One bit for each cell of the merged sketch, rows behind each other. Its size does not depend on the input."""
    spark = docs.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    size = min(PART, width) // 8
    bits = np.zeros(DEPTH * width // 8, np.uint8)
    for r in merged(sketched(docs.coalesce(tasks), most_words, least, width), least).toLocalIterator():
        bits[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return bits


def counted(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, width: int = WIDTH) -> DataFrame:
    """``lang, phrase, a``: every phrase of up to ``most_words`` words with ``a >= least`` occurrences, and per language a null phrase with
    the number of all words."""
    if not 1 <= least <= 255 or width % 8 or width & (width - 1):
        raise ValueError("the least count must fit a byte and the width be a power of two")
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_or_empty(docs["text"]).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(reached(rows, most_words, least, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, counts = shared.value, Counts()

        def frequent(hashes: np.ndarray) -> np.ndarray:
            keep = np.ones(len(hashes), bool)
            for row in range(DEPTH):
                cell = cells(hashes, row, width)
                keep &= (bits[row * (width // 8) + (cell >> np.uint32(3))] >> (cell & np.uint32(7)).astype(np.uint8)) & 1 == 1
            return keep

        for block, names in batch_blocks(batches):
            # phrases that only start among the words looked at are still asked for, since phrases around them need them
            whole = Phrases(block._replace(counted=len(block.starts)), names)
            inner, found = None, []
            for k in range(1, most_words + 1):
                at = whole.starts(k)
                if inner is not None:
                    at = at[inner[at] & inner[at + 1]]
                hashes = whole.hashes(at, k)
                keep = frequent(hashes)
                at, hashes = at[keep], hashes[keep]
                inner = np.zeros(len(block.starts) + 1, bool)
                inner[at] = True
                own = at < block.counted
                found.append((at[own], hashes[own], np.full(own.sum(), k)))
            at, hashes, words = (np.concatenate(x) for x in zip(*found))
            langs, n = np.unique(block.lang[: block.counted], return_counts=True)
            for lang, words_of in zip(langs.tolist(), n.tolist()):
                counts.totals[names[lang]] = counts.totals.get(names[lang], 0) + words_of
            yield from counts.add(block, names, at, words, hashes, whole.second().ranges(block.starts[at], block.ends[at + words - 1]))
        yield from counts.rest()

    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    found = rows.coalesce(tasks).mapInArrow(run, "lang string, phrase string, a long")
    return found.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("phrase").isNull() | (F.col("a") >= least))


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every phrase of two words and more in ``counts``: its cut of the least score."""
    big = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    known = counts.where("phrase IS NOT NULL")
    totals = counts.where("phrase IS NULL").select("lang", F.col("a").alias("n"))
    gaps = F.size(F.split("phrase", " ")) - 1
    cuts = known.withColumn("gaps", gaps).where("gaps > 0").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("gaps"))))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(head) + 2)"))
    left = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    full = cuts.join(left, ["lang", "head"]).join(right, ["lang", "rest"]).join(totals, "lang")
    over = (F.lit(1000).cast("decimal(4,0)") * big("a", 15)).cast("decimal(19,0)") * big("n", 18)
    full = full.withColumn("over", over.cast("decimal(38,0)")).withColumn("under", (big("l", 15) * big("r", 15)).cast("decimal(38,0)"))
    full = full.withColumn("score", F.expr("over div under"))
    least = F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("m")
    return full.groupBy("lang", "phrase").agg(least).select("lang", "phrase", "m.a", "m.l", "m.r", "m.n", "m.score")


def unsubsumed(phrases: DataFrame, percent: int = 100) -> DataFrame:
    """``phrases`` without those inside a longer one that has at least ``percent`` in a hundred of their occurrences."""
    words = F.split("phrase", " ")
    length = F.size("w")
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    longer = phrases.select("lang", "a", words.alias("w")).where(length > 2).select("lang", "a", F.explode(inner).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    return phrases.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * percent)).drop("around")


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rank: Column = F.row_number().over(order)
    return phrases.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))


def mined(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, top: int = TOP, width: int = WIDTH) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    counts = written(counted(docs, most_words, least, width), "phrases")
    phrases = written(scored(counts), "scores")
    return ranked(unsubsumed(phrases), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
