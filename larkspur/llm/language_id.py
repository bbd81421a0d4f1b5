"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds all substrings of a bounded sample of labelled
text. A text is parsed greedily into phrases, each the longest match that the automaton has
from there on; the number of phrases, times the bits that name a place in the sample, per character, estimates the cross
entropy. The language with the least wins.

Texts are parsed in lanes, many lanes and all languages at once with one array step per character. A lane begins some
characters early. Two greedy parses agree from the first phrase start that they share, so a lane counts what a parse of the whole text would
if the phrase in progress where it begins to count started at the same character as the one in progress where the lane before ends. That is
compared for every lane and language; texts with any difference are parsed again as one lane each, so every count is that of the whole text. The automata
are one hash table of transitions with a code for every letter of the samples, whatever the alphabet; letters of no sample
match nothing. Its size follows from the samples', which is bounded over all languages together; a table above ``TABLE_BYTES`` is an error, none is broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is every text when
no labelled row exists, as in an empty table; ties go to the first language in code point order; repeated rows are
predicted alike, and copies of a text are one text of the sample; texts of any length are read as a whole; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.hashing import slices
from larkspur.llm.shared import crc_remainder

#: Characters of labelled text: of a language, of all languages together, and of one text; texts that may provide a language's.
SAMPLE_CHARS, ALL_CHARS, SLICE_CHARS, SAMPLE_ROWS = 30_000, 600_000, 1_000, 64
#: Most bytes of the table of transitions.
TABLE_BYTES = 1 << 28
#: Characters that a lane counts, and those before them that it reads.
LANE, EARLY = 2048, 256
#: Characters of texts, each as wide as the longest, that are parsed in whole at once.
CELLS = 1 << 22
SPACE, OTHER, PAD = 0, 1, -1
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Model:
    """The transition of ``state`` by ``code`` has the key ``state * size + code``; ``first[language, code]`` is the state behind a
    phrase's first character. A key is at one of two places of the table."""

    languages: list[str]
    codes: np.ndarray
    size: int
    keys: np.ndarray
    values: np.ndarray
    first: np.ndarray
    start: np.ndarray
    bits: np.ndarray

    def following(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next states, -1 for none."""
        key = state * self.size + code
        one, two = _places(key, len(self.keys))
        return np.where(self.keys[one] == key, self.values[one], np.where(self.keys[two] == key, self.values[two], -1))


def _places(key: np.ndarray, n: int) -> list[np.ndarray]:
    shift = np.uint64(64 - (n.bit_length() - 1))
    with np.errstate(over="ignore"):
        return [((key.astype(np.uint64) * f) >> shift).astype(np.int64) for f in _FACTORS]


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both by place, each key at one of its two; keys that find both taken move others on, in rounds."""
    n = 1 << max(4, int(len(keys) * 2.5).bit_length())
    while True:
        at, places = np.full(n, -1, np.int64), _places(keys, n)
        todo, turn = np.arange(len(keys)), np.zeros(len(keys), np.int64)
        for _ in range(200):
            place = np.where(turn[todo] == 0, places[0][todo], places[1][todo])
            old = at[place]
            at[place] = todo
            lost = todo[at[place] != todo]
            moved = np.unique(old[(old >= 0) & (at[place] != old)])
            todo = np.concatenate([lost, moved])
            if not len(todo):
                # unused places hold a last, empty entry
                return np.append(keys, -1)[at], np.append(values, -1)[at].astype(np.int32)
            turn[todo] ^= 1
        n *= 2


def automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton of a sequence; state 0 is its root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in codes.tolist():
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def encode(text: str, codes: np.ndarray) -> np.ndarray:
    """One code per character; runs of what is no letter count once."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = codes[np.minimum(points, len(codes) - 1)]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != SPACE) | (out[:-1] != SPACE)
    return out[keep]


def build(texts: dict[str, str]) -> Model:
    """The model of sample texts by language."""
    languages = sorted(texts)
    lowered = {k: texts[k].lower() for k in languages}
    letters = sorted({ch for text in lowered.values() for ch in text if ch.isalpha()})
    codes = np.full(0x110001, SPACE, np.int32)
    for point in range(0x110000):
        if chr(point).isalpha():
            codes[point] = OTHER
    for i, ch in enumerate(letters):
        codes[ord(ch)] = i + 2
    for ch in letters:
        for upper in {ch.upper(), ch.title()}:
            if len(upper) == 1 and codes[ord(upper)] == OTHER:
                codes[ord(upper)] = codes[ord(ch)]
    size = len(letters) + 2
    keys, values, first, start, bits, base = [], [], [], [], [], 0
    for k in languages:
        sample = encode(lowered[k], codes)
        states = automaton(sample)
        stop = base + len(states)
        keys.append(np.array([(base + s) * size + c for s, step in enumerate(states) for c in step], np.int64))
        values.append(np.array([base + t for step in states for t in step.values()], np.int64))
        row = np.full(size, stop, np.int32)
        for c, t in states[0].items():
            row[c] = base + t
        first.append(row)
        start.append(stop)
        bits.append(np.log2(max(2, len(sample))))
        base = stop + 1
    none = np.empty(0, np.int64)
    table = _table(np.concatenate([none, *keys]), np.concatenate([none, *values]))
    return Model(
        languages, codes, size, *table, np.array(first, np.int32).reshape(len(languages), size), np.array(start, np.int32), np.array(bits)
    )


def fit(docs: DataFrame, modulus: int = 4, held_out: int = 2, chars: int = SAMPLE_CHARS, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from ``rows`` distinct texts a language at most, drawn by their hash, a slice of each at a hashed place.

    ``chars`` bounds what a language may learn from, ``ALL_CHARS`` what all languages may together.
    """
    keyed = docs.select(
        docs["doc_id"].cast("long").alias("doc"), docs["lang"].cast("string").alias("lang"), docs["text"], F.xxhash64(docs["text"]).alias("id")
    )
    known = keyed.where("doc IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(crc_remainder(F.col("doc"), modulus) != held_out)
    # of equal texts one id; the least hashes of each language are found on ids alone
    ids = known.select("lang", "id").distinct().withColumn("h", F.xxhash64("id", F.lit("order")))
    # however many languages there are, all slices together have about twice ALL_CHARS characters at most
    chars = min(chars, ALL_CHARS // max(1, ids.select("lang").distinct().count()))
    if not chars:
        raise ValueError(f"more than {ALL_CHARS} languages cannot be told apart by samples of that size together")
    width = min(SLICE_CHARS, chars)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    least = ids.withColumn("nth", nth).where(F.col("nth") <= min(rows, max(1, 2 * chars // width))).drop("nth")
    place = F.pmod(F.xxhash64("id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - width + 1)).cast("int") + 1
    # at most two rows for each of ALL_CHARS characters, far fewer with usual numbers of languages
    sliced = known.join(F.broadcast(least), ["lang", "id"]).select("lang", "h", F.substr("text", place, F.lit(width)).alias("text"))
    drawn = sliced.groupBy("lang", "h").agg(F.min("text").alias("text")).toPandas()
    texts: dict[str, str] = {}
    for lang, part in drawn.sort_values(["lang", "h"]).groupby("lang"):
        text = "\n".join(part["text"])[:chars]
        if any(ch.isalpha() for ch in text):
            texts[lang] = text
    return build(texts)


def phrases(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(counts[language, text], characters, letters)`` of greedy cross-parsing."""
    out = np.zeros((len(model.languages), len(texts)), np.int64)
    sizes, letters, again = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool), []
    for a, b in slices(texts):
        coded = [encode(t or "", model.codes) for t in texts[a:b]]
        sizes[a:b] = [len(c) for c in coded]
        letters[a:b] = [bool((c != SPACE).any()) for c in coded]
        out[:, a:b], sure = _parsed(coded, model, LANE)
        again += [(a + i, coded[i]) for i in np.flatnonzero(~sure).tolist()]
    # the texts whose lanes differ from a parse of the whole, many at once and each in one lane
    again.sort(key=lambda x: -len(x[1]))
    while again:
        longest = len(again[0][1])
        some, again = again[: max(1, CELLS // longest)], again[max(1, CELLS // longest) :]
        out[:, [i for i, _ in some]] = _parsed([c for _, c in some], model, longest)[0]
    return out, sizes, letters


def _parsed(coded: list[np.ndarray], model: Model, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by language and text, and whether the lanes of each text certainly follow the parse of the whole."""
    n, k = len(coded), len(model.languages)
    sizes = np.array([len(c) for c in coded])
    per = np.maximum(1, -(-sizes // lane)) if n else sizes
    lanes = int(per.sum())
    ahead = EARLY if n and per.max() > 1 else 0
    owner = np.repeat(np.arange(n), per)
    at = np.arange(lanes) - np.repeat(np.cumsum(per) - per, per)
    early = np.where(at > 0, ahead, 0)
    length = np.clip(np.repeat(sizes, per) - at * lane, 0, lane) + early
    order = np.argsort(-length, kind="stable")
    widest = int(length.max()) if lanes else 0
    grid = np.full((lanes, widest), PAD, np.int32)
    row = 0
    for c, m in zip(coded, per.tolist()):
        for i in range(m):
            piece = c[max(0, i * lane - ahead) : (i + 1) * lane]
            grid[row + i, : len(piece)] = piece
        row += m
    steps, early = np.ascontiguousarray(grid[order].T), early[order]
    active = np.searchsorted(-length[order], -np.arange(1, widest + 1), "right")
    state = np.repeat(model.start[:, None], lanes, axis=1).astype(np.int64)
    count = np.zeros((k, lanes), np.int32)
    # where in its lane the phrase in progress started: at the end, and where a lane that began early starts to count
    began, entered = np.zeros((k, lanes), np.int32), np.zeros((k, lanes), np.int32)
    for i in range(widest):
        if i == ahead:
            entered[:] = began
        m = active[i]
        code = steps[i, :m]
        now = state[:, :m]
        following = model.following(now, code)
        miss = following < 0
        count[:, :m] += miss & (early[:m] <= i) if i < ahead else miss
        np.copyto(began[:, :m], i, where=miss)
        np.copyto(now, following)
        np.copyto(now, model.first[:, code], where=miss)
    out, sure = np.zeros((k, n), np.int64), np.ones(n, bool)
    for j in range(k):
        out[j] = np.bincount(owner[order], count[j], n)
    if ahead:
        first = (at * lane)[order] - early
        back = np.argsort(order)
        end, enter = (began + first)[:, back], (entered + first)[:, back]
        later = np.flatnonzero(at > 0)
        sure[owner[later[(enter[:, later] != end[:, later - 1]).any(axis=0)]]] = False
    return out, sure


def predictions(texts: list[str | None], model: Model) -> pd.DataFrame:
    n, k = len(texts), len(model.languages)
    if not k:
        return pd.DataFrame({"lang_pred": ["und"] * n, "score": np.zeros(n)})
    count, size, letters = phrases(texts, model)
    entropy = count * model.bits[:, None] / np.maximum(size, 1)
    best = entropy.argmin(axis=0)
    low = entropy.min(axis=0)
    # how far the runner-up is behind: 0.5 for a tie, towards 1 for a clear case
    second = np.partition(entropy, 1, axis=0)[1] if k > 1 else np.full(n, np.inf)
    score = np.ones(n) if k == 1 else second / np.maximum(low + second, 1e-12)
    names = np.array(model.languages, object)[best]
    names[~letters] = "und"
    return pd.DataFrame({"lang_pred": names, "score": np.where(letters, score, 0.0)})


def predict(text: Column, model: Model, df: DataFrame) -> Column:
    """``struct<lang_pred, score>`` as a column over ``text``."""
    if model.keys.nbytes + model.values.nbytes > TABLE_BYTES:
        raise ValueError("the table of transitions is too large to be broadcast")
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield predictions(texts.tolist(), shared.value)

    return run(text)
