"""Packing documents into token windows by non-negative least squares.

A document is its token ids and one end id. Whole windows are cut off first; what remains of
each document is a length below the window. Combinations of at most three lengths that fill a
window exactly are enumerated over the histogram of all remaining lengths, and projected gradient steps solve
for non-negative repeat counts that use the histogram up. Every batch of documents then takes its
rounded share of those combinations, and packs the residuals greedily: longest first, end to
end, cut at window ends. A batch's last tokens form sequences of power-of-two lengths, which
need no padding.

Ids are computed once and written; the histogram has fewer rows than the window has tokens;
packing is one more pass without a shuffle, so a lost task repeats only its own batch.

Defined cases: null text is empty and is its end id alone; repeated rows are packed as often
as they occur; a document longer than a window fills whole windows of its own.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.hashing import slices
from larkspur.llm.shared import new_path

WINDOW, END_ID = 2048, 1
#: Most frequent lengths from which triples are built (pairs use all lengths).
TRIPLE_LENGTHS = 160
STEPS = 400
#: Fixed value: the special token of the vocabulary and its id; text that spells it is that token.
SPECIAL = {"<|endoftext|>": 50256}
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ENCODERS: dict = {}


def encoder(ranks_path: str, pattern: str):
    """The byte-level BPE of a ranks file; it gives the ids of the ``tokenizers`` file of the same vocabulary."""
    import tiktoken

    if ranks_path not in _ENCODERS:
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[ranks_path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[ranks_path]


def token_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 16-bit, end id included) ``, n`` of every row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, 1 << 22):
                ids = [np.array([*enc.encode(t or "", allowed_special="all"), END_ID], "<u2") for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())],
                    ["doc_id", "ids", "n"],
                )

    spark, path, kind = docs.sparkSession, new_path(docs.sparkSession, "ids"), "doc_id long, ids binary, n long"
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    rows.mapInArrow(run, kind).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(kind).parquet(path)


def combinations(histogram: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of three lengths (zero for none), descending, that fill the window or are a power of two alone."""
    there = np.flatnonzero(histogram[1:]) + 1
    singles = [(p, 0, 0) for p in there if p & (p - 1) == 0]
    pairs = [(window - a, a, 0) for a in there if a <= window - a and histogram[window - a]]
    top = np.sort(there[np.argsort(-histogram[there], kind="stable")[:TRIPLE_LENGTHS]])
    a, b = (x.ravel() for x in np.meshgrid(top, top, indexing="ij"))
    c = window - a - b
    ok = (a >= b) & (c >= 1) & (c < window)
    a, b, c = a[ok], b[ok], c[ok]
    ok = histogram[c] > 0
    triples = -np.sort(-np.stack([a[ok], b[ok], c[ok]], 1), axis=1)
    every = np.concatenate([np.array(singles + pairs, np.int64).reshape(-1, 3), triples.reshape(-1, 3)])
    return np.unique(every, axis=0)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative x that minimises ``|A x - histogram|^2``; a column of A counts a combination's lengths."""
    if not len(combos):
        return np.zeros(0)
    h = histogram.astype(float).copy()
    h[0] = 0
    size = len(h)

    def apply(x):
        y = np.bincount(combos.ravel(), np.repeat(x, 3), size)
        y[0] = 0
        return y

    def back(r):
        return np.where(combos > 0, r[combos], 0.0).sum(1)

    # the largest eigenvalue of A'A, by power iteration
    v = np.ones(len(combos))
    for _ in range(20):
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= max(norm, 1e-12)
    step = 1 / max(norm * 1.05, 1e-9)
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(STEPS):
        following = np.maximum(0, y - step * back(apply(y) - h))
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = following + (t - 1) / grown * (following - x), following, grown
    return x


def pack(lengths: np.ndarray, combos: np.ndarray, shares: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one batch.

    ``shares`` are the solved repeat counts per document of the whole input; combinations come
    in descending order of their counts.
    """
    pieces, sequence = [], 0
    rest = lengths % window
    for d in np.flatnonzero(lengths >= window).tolist():
        for k in range(int(lengths[d]) // window):
            pieces.append((d, k * window, window, sequence, 0))
            sequence += 1
    order = np.argsort(rest, kind="stable")
    bounds = np.searchsorted(rest[order], np.arange(window + 1))
    waiting = {r: order[bounds[r] : bounds[r + 1]].tolist() for r in range(1, window) if bounds[r + 1] > bounds[r]}
    for combo, share in zip(combos.tolist(), shares.tolist()):
        parts = [r for r in combo if r]
        need = {r: parts.count(r) for r in parts}
        times = min(int(np.ceil(share * len(lengths))), *(len(waiting.get(r, ())) // m for r, m in need.items()))
        for _ in range(times):
            offset = 0
            for r in parts:
                d = waiting[r].pop()
                pieces.append((d, int(lengths[d]) - r, r, sequence, offset))
                offset += r
            sequence += 1
    left = [(d, r) for r in sorted(waiting, reverse=True) for d in waiting[r]]
    total = sum(r for _, r in left)
    ends = list(range(window, total + 1, window))
    at, bit = len(ends) * window, window // 2
    while at < total:
        if total - at >= bit:
            at += bit
            ends.append(at)
        bit //= 2
    position, k = 0, 0
    for d, r in left:
        start = int(lengths[d]) - r
        while r:
            begin = ends[k - 1] if k else 0
            take = min(r, ends[k] - position)
            pieces.append((d, start, take, sequence + k, position - begin))
            position, start, r = position + take, start + take, r - take
            k += position == ends[k]
    return pieces


def packed(docs: DataFrame, ranks_path: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    ids = token_ids(docs, ranks_path, pattern)
    counts = ids.groupBy((F.col("n") % window).alias("rest")).agg(F.count("*").alias("n")).collect()
    histogram = np.zeros(window, np.int64)
    for row in counts:
        histogram[row["rest"]] = row["n"]
    total = int(histogram.sum())
    combos = combinations(histogram, window)
    solved = repeat_counts(combos, histogram)
    used = np.flatnonzero(solved > 0.01)
    used = used[np.argsort(-solved[used], kind="stable")]
    plan = docs.sparkSession.sparkContext.broadcast((combos[used], solved[used] / max(1, total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combos, shares = plan.value
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            doc_ids, data = batch.column("doc_id").to_pylist(), batch.column("ids")
            lengths = batch.column("n").to_numpy()
            pieces = pack(lengths, combos, shares, window)
            base_next = base + max(p[3] for p in pieces) + 1
            out = [[] for _ in range(7)]
            for d, start, length, sequence, offset in pieces:
                raw = np.frombuffer(data[d].as_buffer(), "<u2", length, 2 * start).astype("<u4")
                row = (doc_ids[d], start, length, zlib.crc32(raw.tobytes()), int(lengths[d]), base + sequence, offset)
                for column, value in zip(out, row):
                    column.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
            base = base_next

    return ids.mapInArrow(run, SCHEMA)
