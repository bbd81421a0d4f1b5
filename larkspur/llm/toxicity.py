"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct lower-case words, word pairs and pairs around one skipped word of a
text, hashed. FTRL-proximal keeps a learning rate per coordinate and leaves coordinates whose
evidence stays within the L1 bound at zero, so the model is a short list of buckets and
weights, small enough to broadcast whatever the corpus. It is fitted on a bounded sample, in a
task of its own: the driver gets the sizes of the examples and the model, never the examples.

Defined cases: null text is scored as empty; an empty text has the score of the bias alone; without
labelled rows, as in empty tables, every score is 0; of labels that share a doc_id the largest counts; repeated rows are
scored alike; a text of any length is scored as a whole, a slice of texts at a time; extra columns are
not read and pass through ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.hashing import mix, slices, word_hashes
from larkspur.llm.samples import bounded, labelled

#: Rows that training reads at most, and bytes of their features that the training task holds at most.
SAMPLE_ROWS, SAMPLE_BYTES = 12_000, 64 << 20
BUCKETS = 1 << 20
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 4.0, 0.1, 3
#: Scores from here on are toxic.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, bucket)`` of all features, repeats included."""
    h, own = word_hashes([(t or "").lower() for t in texts])
    owners, hashes = [own], [h]
    with np.errstate(over="ignore"):
        for gap, salt in ((1, 0x2545F4914F6CDD1D), (2, 0x5851F42D4C957F2D)):
            same = own[:-gap] == own[gap:]
            owners.append(own[:-gap][same])
            hashes.append(mix(h[:-gap][same] * np.uint64(salt) + h[gap:][same]))
    return np.concatenate(owners), (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)


def _bags(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in rows:
        used = [np.unique(features([t])[1]).astype(np.int32).tobytes() for t in part["text"]]
        yield pd.DataFrame({"h": part["h"], "label": part["label"], "used": used})


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, sample: int = SAMPLE_ROWS) -> Model:
    """Trains on at most ``sample`` labelled rows; executors reduce each text to its buckets, and one of them trains on those."""
    rows = labelled(docs, labels, "toxic", modulus, held_out, sample)
    bags = rows.select("h", "label", "text").mapInPandas(_bags, "h long, label int, used binary")
    examples = bounded(bags, ["used"], SAMPLE_BYTES).coalesce(1).sortWithinPartitions("h", "label", "used")
    got = examples.select("label", "used").mapInArrow(_trained, "buckets binary, weights binary, bias double").first()
    if got is None:
        return train([])
    return Model(np.frombuffer(got["buckets"], np.int64), np.frombuffer(got["weights"]), got["bias"])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows ``label, used``, in their order, as one row; the arrays are views of the batches."""
    examples = [(y.as_py(), np.frombuffer(u.as_buffer(), np.int32)) for batch in batches for y, u in zip(*batch.columns)]
    model = train(examples)
    row = {"buckets": model.buckets.tobytes(), "weights": model.weights.tobytes(), "bias": model.bias}
    yield pa.RecordBatch.from_pylist([row])


def train(examples: list[tuple[int, np.ndarray]], seed: int = 5) -> Model:
    """FTRL-proximal; the bias is a coordinate without L1."""
    none = np.empty(0, np.int64)
    if not examples:
        return Model(none, np.empty(0), -np.inf)
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias_z, bias_n = 0.0, 0.0
    rng = np.random.default_rng(seed)

    def weight(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            y, used = examples[i]
            w = weight(z[used], n[used], L1)
            bias = float(weight(np.float64(bias_z), np.float64(bias_n), 0.0))
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - y
            rate = (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / ALPHA
            z[used] += g - rate * w
            n[used] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    w = weight(z, n, L1)
    kept = np.flatnonzero(w)
    return Model(kept, w[kept], float(weight(np.float64(bias_z), np.float64(bias_n), 0.0)))


def scores(texts: list[str | None], dense: np.ndarray, bias: float) -> np.ndarray:
    owner, bucket = features(texts)
    hit = dense[bucket] != 0
    pairs = np.unique(owner[hit] * BUCKETS + bucket[hit])
    total = np.bincount(pairs // BUCKETS, dense[pairs % BUCKETS], len(texts)) + bias
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def score(text: Column, model: Model, df: DataFrame) -> Column:
    """The probability of label 1, as a column over ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        dense = np.zeros(BUCKETS)
        dense[model.buckets] = model.weights
        for texts in batches:
            values = texts.tolist()
            yield pd.Series(
                np.concatenate([np.empty(0), *(scores(values[a:b], dense, model.bias) for a, b in slices(values))])
            )

    return run(text)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score stays under the threshold, with all their columns."""
    return docs.withColumn("__toxic", score(docs["text"], model, docs)).where(F.col("__toxic") < THRESHOLD).drop("__toxic")
