"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles; two texts are linked where their Jaccard coefficient is
at least the threshold. Exact copies are collapsed first. MinHash bands put texts into buckets;
each text is tied to its buckets' first ones, never to all of them. MinHash values of a tie are compared a few at a time; it is
dropped as soon as the posterior probability (uniform prior) that its similarity reaches seven eighths of the threshold
falls below the tolerance; ties that stay in doubt are verified on the texts. The texts that stay connected form
work groups, so texts that share a template but little else do not meet. Inside a group all pairs are pruned in the same way,
and what is left is verified on the whole shingle sets.

Texts that are not very close to the first texts of all their buckets may have partners whose ties were dropped; they are joined once more
by their rarest shingles, across the groups, and what they share there is pruned and verified at the threshold itself. So a similar pair
is missed only if it shares no bucket or by the tolerances of the pruning.

Large groups are cut into chunks, and pairs of chunks are compared in separate tasks, so no task
ever holds more than two chunks and no stage emits a row per pair: blocks return each text's
number of links and the text that its links lead to, from which classes follow.

Defined cases: null text is empty; a text of fewer than five words is one shingle; a text without words has
no links but to its exact copies; documents are counted as often as they occur; classes are
the connected texts, named by their smallest doc_id (null if none has one); no rows give no rows; texts of any length are read as a
whole, of which a task holds two chunks; extra columns are not read, and pass through ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.exact_dedup import digest
from larkspur.llm.hashing import SPACE, mix, slices, word_hashes
from larkspur.llm.shared import shielded, text_or_empty, written

#: MinHash values of a text, and those compared at once.
HASHES, STEP = 128, 16
#: 25 bands of 5 values miss a pair of similarity 0.8 with probability 5e-5, one of 0.9 with 4e-10.
BANDS, ROWS = 25, 5
#: Pairs are dropped below, and ties kept without a look at the texts above one minus, these posterior probabilities.
TOLERANCE, SURE = 1e-5, 1e-2
#: Ties are kept from this share of the threshold on: two similar texts may each be less similar to the first text of their buckets.
TIE = 0.875
#: Texts of a chunk, and characters of its texts, on average; ties that a task compares at most for one first text.
CHUNK, CHUNK_CHARS, TIES = 512, 1 << 24, 8192
#: Bits of the filter that keeps most texts without partners out of the shuffle; a power of two, four megabytes.
FILTER_BITS = 1 << 25
_FACTORS = np.random.default_rng(11).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The shingle hashes of each text, repeats included."""
    h, own = word_hashes([(t or "").lower() for t in texts], ~SPACE)
    bounds = np.searchsorted(own, np.arange(len(texts) + 1))
    with np.errstate(over="ignore"):
        grown = np.zeros(len(h), np.uint64)
        for k in range(words):
            grown[: len(h) - k] += mix(h[k:] + np.uint64(k + 1)) * np.uint64(2 * k + 3)
        grown = mix(grown)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= words:
                out.append(grown[a : b - words + 1])
            else:
                short = sum((mix(h[i : i + 1] + np.uint64(i - a + 1)) for i in range(a, b)), np.zeros(1, np.uint64))
                out.append(mix(short + np.uint64(b - a)) if b > a else h[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of each set; all ones for an empty set."""
    out = np.full((len(sets), HASHES), 0xFFFFFFFF, np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):
        stop, total = at, 0
        while stop < len(full) and (total == 0 or total + len(sets[full[stop]]) <= 1 << 16):
            total += len(sets[full[stop]])
            stop += 1
        rows = full[at:stop]
        joined = np.concatenate([sets[i] for i in rows])
        starts = np.cumsum([0] + [len(sets[i]) for i in rows[:-1]])
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                out[rows, k] = np.minimum.reduceat(((joined * _FACTORS[k]) >> np.uint64(32)).astype(np.uint32), starts)
        at = stop
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    """One bucket per band of each signature."""
    parts = sig[:, : BANDS * ROWS].reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.zeros(parts.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return h.astype(np.int64)


def needed_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values, the fewest matches that keep P(similarity >= threshold) at the tolerance.

    With a uniform prior the posterior is a Beta distribution, whose upper tail is the
    probability of at most m successes in n + 1 trials.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def linked(
    sig_a: np.ndarray, sets_a: list[np.ndarray], sig_b: np.ndarray, sets_b: list[np.ndarray], same: bool, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose Jaccard coefficient reaches the threshold (``same``: within one list, i < j)."""
    need = needed_matches(threshold)
    size_a, size_b = (np.array([len(s) for s in sets]) for sets in (sets_a, sets_b))
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(sets_a), 64):
        block = sig_a[start : start + 64, None, :STEP] == sig_b[None, :, :STEP]
        matches = block.sum(2)
        sizes = size_a[start : start + 64, None], size_b[None, :]
        fit = (np.minimum(*sizes) >= threshold * np.maximum(*sizes)) & (np.minimum(*sizes) > 0)
        i, j = np.nonzero((matches >= need[STEP]) & fit)
        m = matches[i, j]
        i = i + start
        if same:
            keep = i < j
            i, j, m = i[keep], j[keep], m[keep]
        for n in range(2 * STEP, HASHES + 1, STEP):
            m = m + (sig_a[i, n - STEP : n] == sig_b[j, n - STEP : n]).sum(1)
            keep = m >= need[n]
            i, j, m = i[keep], j[keep], m[keep]
        for row in np.unique(i):
            others = j[i == row]
            joined = np.concatenate([sets_b[k] for k in others])
            own = sets_a[row]
            place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
            common = np.add.reduceat((own[place] == joined).astype(np.int64), np.cumsum(np.concatenate(([0], size_b[others][:-1]))))
            hit = others[common >= threshold * (size_a[row] + size_b[others] - common) - 1e-9]
            found_a.append(np.full(len(hit), row))
            found_b.append(hit)
    return np.concatenate(found_a), np.concatenate(found_b)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index connected with each of n items."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _compare(threshold: float, words: int):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node").sort_values(["comp", "node"], kind="stable").reset_index(drop=True)
        sets = [np.unique(s) for a, b in slices(part["text"].tolist()) for s in shingles(part["text"].tolist()[a:b], words)]
        sig = np.frombuffer(b"".join(part["sig"]), np.uint32).reshape(len(part), HASHES)
        node, copies, chunk = (part[c].to_numpy() for c in ("node", "copies", "chunk"))
        links, root = np.zeros(len(part), np.int64), node.copy()
        edges = np.flatnonzero(np.diff(part["comp"].to_numpy())) + 1
        for at, end in zip([0, *edges], [*edges, len(part)]):
            rows = np.arange(at, end)
            left = rows[chunk[rows] == key[1]] if key[1] != key[2] else rows
            right = rows[chunk[rows] == key[2]] if key[1] != key[2] else rows
            a, b = linked(
                sig[left], [sets[i] for i in left], sig[right], [sets[i] for i in right], key[1] == key[2], threshold
            )
            a, b = left[a], right[b]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root[rows] = node[at + _roots(end - at, a - at, b - at)]
        return pd.DataFrame({"node": node, "root": root, "links": links, "chunks": part["chunks"]})

    return run


def sure_matches(threshold: float, tolerance: float) -> int:
    """The matches among all values from which on P(similarity < threshold) is under the tolerance."""
    tail, m = 0.0, 0
    while m < HASHES:
        tail += comb(HASHES + 1, m) * threshold**m * (1 - threshold) ** (HASHES + 1 - m)
        if tail > 1 - tolerance:
            break
        m += 1
    return m


def _firsts(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a group that are not their own first text, and for each row that of its first text, which is in the group too."""
    node, head = part["node"].to_numpy(), part["head"].to_numpy()
    own = np.flatnonzero(node == head)
    own = own[np.argsort(head[own], kind="stable")]
    return np.flatnonzero(node != head), own[np.searchsorted(head[own], head)]


def _pruned_ties(threshold: float, close: float = 1.0):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(part["payload"]), np.uint32).reshape(len(part), HASHES)
        rows, first = _firsts(part)
        same = sig[rows] == sig[first[rows]]
        need, kept = needed_matches(threshold), np.ones(len(rows), bool)
        for n in range(STEP, HASHES + 1, STEP):
            kept[kept] = same[kept, :n].sum(1) >= need[n]
        matches = same.sum(1)
        # sure: null for those that are dropped
        sure = pd.array(matches >= sure_matches(threshold, SURE), "boolean")
        sure[~kept] = pd.NA
        return pd.DataFrame({"a": part["head"].to_numpy()[rows], "b": part["node"].to_numpy()[rows], "sure": sure, "close": kept & (matches >= sure_matches(close, TOLERANCE))})

    return run


def _verified_ties(threshold: float, words: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        texts = part["payload"].tolist()
        sets = [np.unique(s) for a, b in slices(texts) for s in shingles(texts[a:b], words)]
        rows, first = _firsts(part)
        hit = []
        for i in rows:
            common = len(np.intersect1d(sets[i], sets[first[i]], assume_unique=True))
            hit.append(common >= threshold * (len(sets[i]) + len(sets[first[i]]) - common) - 1e-9)
        rows = rows[np.array(hit, bool)]
        return pd.DataFrame({"a": part["head"].to_numpy()[rows], "b": part["node"].to_numpy()[rows]})

    return run


def _by_first(ties: DataFrame):
    """``ties`` (``node, head, payload, size``, each head its own node too) grouped for comparison with the head; many texts of one
    head are compared in parts, each of which has the head."""
    sizes = ties.groupBy("head").agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum("chars").alias("chars")).first()
    n_groups = 1 + (total["n"] or 0) // TIES + (total["chars"] or 0) // CHUNK_CHARS
    parts = F.ceil(F.greatest(F.col("n") / TIES, F.col("chars") / CHUNK_CHARS)).cast("int")
    part = F.when(F.col("node") == F.col("head"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    work = F.when(F.col("parts") == 1, -1 - F.pmod(F.xxhash64("head"), F.lit(n_groups))).otherwise(F.col("head"))
    placed = ties.join(sizes.select("head", parts.alias("parts")), "head").select("node", "head", "payload", work.alias("work"), F.explode(part).alias("part"))
    return placed.groupBy("work", "part")


def _checked(ties: DataFrame, nodes: DataFrame, rows: DataFrame, threshold: float, words: int, close: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Of ``ties`` (``node, head``, each head its own node too): those whose similarity reaches ``threshold`` as ``a, b``, and all with what their
    MinHash values say.

    These decide most ties either way; the rest is verified on the texts.
    """
    ties = ties.join(nodes.select("node", F.col("sig").alias("payload")), "node")
    ties = written(ties.withColumn("size", F.lit(4 * HASHES).cast("long")), "ties")
    pruned = written(_by_first(ties).applyInPandas(_pruned_ties(threshold, close), "a long, b long, sure boolean, close boolean"), "pruned")
    unsure = pruned.where("NOT sure")
    pairs = unsure.select(F.col("b").alias("node"), F.col("a").alias("head")).unionByName(unsure.select(F.col("a").alias("node"), F.col("a").alias("head")).distinct())
    ends = pairs.select("node").distinct().join(nodes.select("node", "digest", "rep"), "node")
    texts = pairs.join(_with_texts(ends, rows), "node").select("node", "head", F.col("text").alias("payload"), F.length("text").cast("long").alias("size"))
    verified = _by_first(written(texts, "unsure")).applyInPandas(_verified_ties(threshold, words), "a long, b long")
    return written(pruned.where("sure").select("a", "b").unionByName(verified), "tied"), pruned


def _ties(nodes: DataFrame, rows: DataFrame, threshold: float, words: int) -> tuple[DataFrame, DataFrame]:
    """``a, b``: each text with those first texts of its buckets whose similarity reaches ``TIE`` of the threshold; ``node``: the texts with a bucket
    whose first text is not so close to them that it is tied to all texts that reach the threshold with them."""
    bucket = nodes.select("node", F.explode("bands").alias("band"))
    heads = bucket.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head")
    own = bucket.join(heads, "band").groupBy("node").agg(F.collect_set("head").alias("heads"))
    # 1 - similarity is a metric: what is further than this from the first text may have partners whose ties are dropped
    close = 1 - (threshold - TIE * threshold)
    edges, pruned = _checked(own.select("node", F.explode("heads").alias("head")), nodes, rows, TIE * threshold, words, close)
    return edges, pruned.where("NOT close").select(F.col("b").alias("node")).distinct()


def _missed(loose: DataFrame, comps: DataFrame, nodes: DataFrame, rows: DataFrame, threshold: float, words: int) -> DataFrame | None:
    """``a, b``: ties between ``loose`` texts of different components that reach the threshold, whatever the first texts of their buckets.

    Texts that reach it share one of their rarest shingles: in the order by frequency, all but the last ``threshold`` of each set are compared, and
    a first common one too far behind leaves too few to follow. None if there are no candidates.
    """
    own = loose.join(nodes.select("node", "digest", "rep"), "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                found = [np.unique(x).view(np.int64) for x in shingles(texts[a:b], words)]
                columns = [batch.column(c).slice(a, b - a) for c in ("node", "comp")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(x) for x in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["node", "comp", "n", "set"])

    each = written(_with_texts(own, rows).select("node", "comp", "text").mapInArrow(sets, "node long, comp long, n long, set array<bigint>"), "shingles")
    each = each.select("node", "comp", "n", F.explode("set").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count("*").alias("f"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("f > 1")
    ordered = Window.partitionBy("node").orderBy("f", "shingle")
    # shingles of one text only come first
    at = F.col("n") - F.count("*").over(Window.partitionBy("node")) + F.row_number().over(ordered) - 1
    placed = each.join(shared, "shingle").withColumn("at", at)
    first = written(placed.where((F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9)) & (F.col("low") < F.col("high"))).select("node", "comp", "n", "shingle", "at"), "first")
    a, b = first.alias("a"), first.alias("b")
    left = lambda x: F.col(f"{x}.n") - F.col(f"{x}.at")
    fit = (
        (F.col("a.node") < F.col("b.node")) & (F.col("a.comp") != F.col("b.comp"))
        & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * threshold - 1e-9)
        & (F.least(left("a"), left("b")) >= (F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold)) - 1e-9)
    )
    pairs = written(a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & fit).select(F.col("b.node").alias("node"), F.col("a.node").alias("head")).distinct(), "candidates")
    if pairs.isEmpty():
        return None
    return _checked(pairs.unionByName(pairs.select(F.col("head").alias("node"), "head").distinct()), nodes, rows, threshold, words)[0]


def _with_texts(members: DataFrame, rows: DataFrame) -> DataFrame:
    """``members`` with the ``text`` of their ``digest, rep``; of the other texts only few are shuffled.

    A representative's text is found by digest and id, so that copies of a hot text do not meet.
    """
    members = written(members, "members")
    near = _marked(rows, members, [F.col("digest"), F.col("doc_id")], [F.col("digest"), F.col("rep")])
    near = near.select(F.col("digest").alias("of_digest"), "doc_id", "text")
    return members.join(near, (F.col("digest") == F.col("of_digest")) & F.col("rep").eqNullSafe(F.col("doc_id"))).select(*members.columns, "text")


def _marked(rows: DataFrame, members: DataFrame, key: list[Column], of: list[Column]) -> DataFrame:
    """``rows`` without most of those whose ``key`` is no ``of`` of the members: a bitmap of fixed size is broadcast, so nothing is shuffled."""
    position = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS)) + 1
    maps = members.select(position(of).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("__bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    asked = rows.withColumn("__p", position(key))
    hits = asked.join(F.broadcast(maps), F.bitmap_bucket_number("__p") == F.col("__bucket"))
    at = F.bitmap_bit_position("__p")
    byte = F.conv(F.hex(F.substr("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return hits.where(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1).select(*rows.columns)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, comp`` of all ends of ``edges(a, b)``; ``comp`` is the smallest connected node.

    Labels spread to neighbours and then jump to their label's own label, each round written
    to the shared folder.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), name)
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("comp")), name)
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("low"))
        spread = labels.join(near, labels["node"] == near["a"]).select("node", F.least("comp", "low").alias("comp"), F.col("comp").alias("old"))
        spread = written(spread, name)
        of = spread.select(F.col("node").alias("of"), F.col("comp").alias("next"))
        jumped = written(spread.join(of, spread["comp"] == of["of"]).select("node", F.col("next").alias("comp"), "old"), name)
        labels = jumped.select("node", "comp")
        if jumped.where("comp <> old").isEmpty():
            return labels


def _classes(docs: DataFrame, threshold: float, words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' digests; each distinct text with its class; each linked text's number of links."""
    text = text_or_empty(docs["text"])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), digest(docs["text"]).alias("digest"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                sets = shingles(texts[a:b], words)
                sig = signatures(sets)
                own = [x.tolist() if len(s) else [] for x, s in zip(bands(sig), sets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("digest").slice(a, b - a),
                        pa.array([x.tobytes() for x in sig], pa.binary()),
                        pa.array(own, pa.list_(pa.int64())),
                        pa.array([len(t) for t in texts[a:b]], pa.int64()),
                    ],
                    ["doc_id", "digest", "sig", "bands", "chars"],
                )

    signed = written(rows.mapInArrow(sign, "doc_id long, digest binary, sig binary, bands array<bigint>, chars long"), "signatures")
    nodes = written(
        signed.groupBy("digest")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("copies"),
            *(F.any_value(c).alias(c) for c in ("sig", "bands", "chars")),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "texts",
    )
    ties, loose = _ties(nodes, rows, threshold, words)
    comps = written(components(ties), "connected")
    missed = _missed(loose, comps, nodes, rows, threshold, words)
    if missed is not None:
        comps = components(ties.unionByName(missed))
    found = comps.join(nodes.select("node", "digest", "rep", "copies", "sig", "chars"), "node")
    sizes = found.groupBy("comp").agg(F.count("*").alias("size"), F.sum("chars").alias("all_chars"))
    sizes = written(sizes, "sizes")
    total = sizes.agg(F.sum("size").alias("n"), F.sum("all_chars").alias("chars")).first()
    n_groups = 1 + (total["n"] or 0) // (2 * CHUNK) + (total["chars"] or 0) // (2 * CHUNK_CHARS)
    chunks = F.ceil(F.greatest(F.col("size") / CHUNK, F.col("all_chars") / CHUNK_CHARS, F.lit(1.0)))
    members = (
        found.join(sizes, "comp")
        .withColumn("chunks", chunks.cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    )
    full = _with_texts(members, rows)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    placed = full.withColumn("other", other).select(
        "node",
        "comp",
        "chunk",
        "chunks",
        "copies",
        "sig",
        "text",
        F.when(F.col("chunks") == 1, -1 - F.pmod(F.xxhash64("comp"), F.lit(n_groups))).otherwise(F.col("comp")).alias("work"),
        F.least("chunk", "other").alias("i"),
        F.greatest("chunk", "other").alias("j"),
    )
    blocks = written(
        placed.groupBy("work", "i", "j").applyInPandas(
            _compare(threshold, words), "node long, root long, links long, chunks int"
        ),
        "links",
    )
    linked_to = blocks.where("root <> node AND chunks > 1").select(F.col("root").alias("a"), F.col("node").alias("b"))
    alone = blocks.where("chunks = 1").select("node", F.col("root").alias("class"))
    across = components(linked_to, "classes").select("node", F.col("comp").alias("class"))
    classes = alone.unionByName(across)
    named = nodes.select("node", "digest", "rep", "copies").join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    return signed, named, blocks.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, words: int = 5) -> DataFrame:
    """``doc_id, class_id, n_links, copies`` for every row of ``docs``."""
    signed, named, links = _classes(docs, threshold, words)
    names = named.groupBy("class").agg(F.min("rep").alias("class_id"))
    result = (
        named.join(names, "class")
        .join(links, "node", "left")
        .select("digest", "class_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return signed.select("doc_id", "digest").join(result, "digest").select("doc_id", "class_id", "n_links", "copies")


@shielded("__digest", "__id", "__n", "__keep_id", "__keep_digest", "__p", "__bucket", "__bits")
def one_of_each(docs: DataFrame, threshold: float = 0.8, words: int = 5) -> DataFrame:
    """One row of each class, with all columns of ``docs``: the one with the smallest doc_id (null last)."""
    _, named, _ = _classes(docs, threshold, words)
    first = F.struct(F.col("rep").isNull(), F.col("rep"), F.col("digest"))
    keep = named.groupBy("class").agg(
        F.min_by("digest", first).alias("__keep_digest"), F.min("rep").alias("__keep_id")
    )
    rows = docs.withColumn("__digest", digest(docs["text"])).withColumn("__id", docs["doc_id"].cast("long"))
    hits = rows.join(
        keep, (F.col("__digest") == F.col("__keep_digest")) & F.col("__id").eqNullSafe(F.col("__keep_id")), "left_semi"
    )
    one = Window.partitionBy("__digest", "__id").orderBy(F.lit(1))
    return hits.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns)
