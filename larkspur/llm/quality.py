"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its words, of the character n-grams inside its
words and of marks for words that return within a few words, all hashed into one table; a softmax layer on that average gives the class. Vectors
and output layer are trained together by stochastic gradient descent in numpy on a bounded
sample of labelled rows. Since a softmax of two classes over an average is linear in the
vectors, scoring reads one number per feature: the product of its vector and the output layer.

Defined cases: null text is scored as empty; an empty text has the score of the bias alone; without
labelled rows, as in empty tables, the score is 0.5; of labels that share a doc_id the largest counts; repeated rows are
scored alike; extra columns are not read. Whole texts of any length are read, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.hashing import SPACE, Bytes, blocks, slices
from larkspur.llm.samples import collected, labelled

#: Rows that training reads at most, and bytes of their features that the driver holds at most.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 64 << 20
BUCKETS = 1 << 16
NGRAMS = (2, 3)
#: A word that stands again within so many words is a feature of its own, one for each distance.
LAGS = 8
DIM, EPOCHS, RATE = 8, 8, 1.0


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: which text each piece is of, the pieces' bounds in bytes, and ``(position, bucket)`` of all features."""
    for data, own, ends in blocks(texts):
        b = Bytes(data)
        start, end = b.runs(~SPACE)
        words = b.ranges(start, end)
        places, hashes = [start], [words]
        piece = np.searchsorted(ends, start, "right")
        for lag in range(1, LAGS + 1):
            again = np.flatnonzero((words[lag:] == words[:-lag]) & (piece[lag:] == piece[:-lag])) + lag
            places.append(start[again])
            hashes.append(np.full(len(again), lag, np.uint64))
        gaps = np.concatenate(([0], np.cumsum(SPACE[b.bytes])))
        for n in NGRAMS:
            h = b.windows(n)
            # white space may only be the first or last byte: there it marks a word's edge
            whole = gaps[n - 1 : n - 1 + len(h)] == gaps[1 : 1 + len(h)] if len(h) else np.empty(0, bool)
            at = np.flatnonzero(whole)
            places.append(at)
            hashes.append(h[at] + np.uint64(n))
        yield own, ends, np.concatenate(places), (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their shares."""
    counts: np.ndarray | int = np.zeros(BUCKETS, np.int64)
    for _, _, _, bucket in features([text]):
        counts += np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used.astype(np.int32), (counts[used] / max(1, counts.sum())).astype(np.float32)


def _bags(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in rows:
        bags = [bag(t) for t in part["text"]]
        yield pd.DataFrame(
            {"h": part["h"], "label": part["label"], "used": [u.tobytes() for u, _ in bags], "share": [s.tobytes() for _, s in bags]}
        )


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, sample: int = SAMPLE_ROWS) -> Model:
    """Trains on at most ``sample`` labelled rows; executors reduce each text to its bag of buckets."""
    rows = labelled(docs, labels, "quality", modulus, held_out, sample)
    bags = rows.select("h", "label", "text").mapInPandas(_bags, "h long, label int, used binary, share binary")
    got = collected(bags, ["used", "share"], SAMPLE_BYTES)
    return train([(int(y), np.frombuffer(u, np.int32), np.frombuffer(s, np.float32)) for y, u, s in zip(got["label"], got["used"], got["share"])])


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 3) -> Model:
    if not bags:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            y, used, share = bags[i]
            rate = RATE * (1 - done / steps)
            rows = vectors[used]
            doc = share @ rows
            z = out @ doc + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(y)] -= 1
            back = p @ out
            out -= rate * np.outer(p, doc)
            bias -= rate * p
            # an average spreads the gradient thinly; fewer, larger steps go to the words that are there
            vectors[used] = rows - rate * np.outer(share * np.float32(len(used) ** 0.5), back)
            done += 1
    return Model(vectors @ (out[1] - out[0]), float(bias[1] - bias[0]))


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for own, ends, at, bucket in features(texts):
        piece = np.searchsorted(ends, at, "right")
        np.add.at(total, own, np.bincount(piece, model.weights[bucket], len(own)))
        np.add.at(count, own, np.bincount(piece, minlength=len(own)))
    return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + model.bias)))


def score(text: Column, model: Model, df: DataFrame) -> Column:
    """The probability of label 1, as a column over ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = texts.tolist()
            yield pd.Series(
                np.concatenate([np.empty(0), *(scores(values[a:b], shared.value) for a, b in slices(values))])
            )

    return run(text)
