"""SimHash near-duplicates by segment bit counts.

A text's fingerprint has the bits that are set in over half of the hashes of its word shingles. Two fingerprints link
where at most two bits differ. The 64 bits are cut into 16 segments of four, and a fingerprint is mapped to the point of its 16
bit counts: flipping a bit moves the point by one step along one axis, so the Manhattan distance of two points is at
most the number of differing bits. Points within two steps of each other have a grid place within one step of both, so every
fingerprint registers at its own place and at the 32 places one step away, and partners meet by equality of places (a range
join on the grid without pairs of cells). A place with two fingerprints is a candidate pair, verified by its differing bits.

A place with more than two is crowded. Its fingerprints are mapped again with segments of one bit, where the Manhattan distance
is the number of differing bits itself: those that register at one place are within one bit of it, hence all linked, and at most 65 in
number. So no place ever yields more than one link for each registration, however many fingerprints crowd there, and none is lost.

Defined cases: null text is empty; a text without words has fingerprint zero, which links like any other; a text of fewer than
three words is one shingle; repeated rows each get their row; a component is named by its smallest doc_id (null if it has none); no rows
give no rows; other columns are not read; texts of any length are read whole, in blocks of shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.near_dup import components
from larkspur.llm.shared import joined_by_key, text_or_empty, written

WORDS = 3
#: Seed of the shingle hashes (fixed value).
SEED = 42
#: Differing bits up to which two fingerprints link; the registrations one step away are right for two.
DISTANCE = 2
#: Shingles that are hashed before their bits are added up.
BLOCK = 1 << 16
#: A-Z to a-z, white space to a blank.
_PLAIN = bytes(32 if c in b"\t\n\v\f\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of one text, as an unsigned number."""
    data = re.sub(rb" {2,}", b" ", text.translate(_PLAIN)).strip(b" ")
    if not data:
        return 0
    blank = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    n = max(1, len(blank) + 2 - words)
    starts = np.concatenate(([0], blank[: n - 1] + 1))
    ends = np.concatenate((blank[words - 1 :], [len(data)]))
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(data[s:e], SEED) for s, e in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, bits`` of every row; ``bits`` is the fingerprint as a signed long."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs["text"]).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "bits"])

    return rows.mapInArrow(run, "doc_id long, bits long")


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def segment_counts(bits: Column) -> Column:
    """The grid place of a fingerprint: 16 bit counts, each plus one, in four bits each, so that one step fits on both sides."""
    ones = (F.shiftrightunsigned(bits, k).bitwiseAND(_signed(0x1111111111111111)) for k in range(4))
    return sum(ones, _signed(0x1111111111111111))


def registrations(nodes: DataFrame) -> DataFrame:
    """``bits, place``: each fingerprint at its place and at those one step away."""
    steps = F.array(_signed(0), *(F.lit(sign << (4 * i)).cast("long") for i in range(16) for sign in (1, -1)))
    placed = nodes.select("bits", segment_counts(F.col("bits")).alias("own"), F.explode(steps).alias("step"))
    return placed.select("bits", (F.col("own") + F.col("step")).alias("place"))


def links(nodes: DataFrame) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``bits`` of ``nodes``; every two that differ in at most two bits are connected by them."""
    placed = registrations(nodes)
    met = placed.groupBy("place").agg(F.count("*").alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b")).where("n > 1")
    met = written(met, "places")
    pairs = met.where("n = 2").select("a", "b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    crowded = placed.join(met.where("n > 2").select("place"), "place").select("bits").distinct()
    flips = F.array(_signed(0), *(_signed(1 << i) for i in range(64)))
    exact = crowded.select("bits", F.explode(flips).alias("flip")).select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("place"))
    # at most 65 fingerprints are within one bit of a place
    near = exact.groupBy("place").agg(F.collect_set("bits").alias("all")).where(F.size("all") > 1)
    starred = near.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b").distinct()
    return pairs.unionByName(starred)


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    rows = written(fingerprints(docs, words), "simhash")
    nodes = written(rows.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "simhash-texts")
    comps = components(links(nodes.select("bits")), "simhash-components")
    of = nodes.join(comps.withColumnRenamed("node", "bits"), "bits", "left").withColumn("comp", F.coalesce("comp", "bits"))
    names = of.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = of.join(names, "comp").select("bits", "component_id", "copies")
    full = joined_by_key(rows, written(named, "simhash-named"), "bits", "copies")
    return full.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
