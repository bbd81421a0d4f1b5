"""SimHash links, collocations and whitening against brute-force versions, with nulls, empties, repeats, ties and clashing columns."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from larkspur.llm import collocations, queries, simhash, whitening
from larkspur.llm.shared import joined_by_key

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
DOCS = "doc_id long, text string, lang string, source string, bits long, place int, component_id int, phrase string, n int, rank int, head string"


def documents(spark, texts, langs=None):
    rows = [(None if t == "no id" else i, t, (langs or ["en"])[i % len(langs or ["en"])], "a", 1, 2, 3, "x", 4, 5, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The smallest id reachable by steps of at most two bits; prints: id to number."""
    ids, out = sorted(prints), {}
    for i in ids:
        if i in out:
            continue
        out[i], todo = i, [i]
        while todo:
            at = todo.pop()
            for j in ids:
                if j not in out and (prints[at] ^ prints[j]).bit_count() <= 2:
                    out[j] = i
                    todo.append(j)
    return out


@here
def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    got = {r.doc_id: r for r in queries.op11_simhash(spark, SF).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints and all(len(r.fingerprint) == 16 for r in got.values())
    assert {i: r.component_id for i, r in got.items()} == plain_components(prints)


def test_simhash_of_odd_texts(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(150_000))
    texts = [None, "", " \t\n", "One", "one", "one two", "a b", "A\tb", "a b c", "É é x", long, long + " z", "no id", "x y z w", "x  y\x0bz w"]
    got = simhash.near_duplicates(documents(spark, texts)).collect()
    assert len(got) == len(texts)
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got if r.doc_id is not None}
    assert prints == {i: plain_fingerprint(t) for i, t in enumerate(texts) if t != "no id"}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == plain_components(prints)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert simhash.near_duplicates(documents(spark, ["a b c"]).limit(0)).count() == 0


def test_simhash_links_of_crowded_places(spark):
    """Chains, balls of two bits around one centre, and fingerprints of one place that are far apart."""
    rng = random.Random(5)
    numbers = {0, (1 << 64) - 1, 1 << 63}
    centre = rng.getrandbits(64)
    numbers |= {centre ^ 1 << i for i in range(64)} | {centre ^ 1 << i ^ 1 << j for i in range(0, 64, 5) for j in range(1, 64, 7)}
    numbers |= {0x1111111111111111 << rng.randint(0, 3) & (1 << 64) - 1 ^ 3 << 4 * i for i in range(16) for _ in range(3)}
    at = rng.getrandbits(64)
    for i in range(0, 40, 2):
        at ^= 3 << i
        numbers.add(at)
    numbers |= {rng.getrandbits(64) for _ in range(200)} | {rng.getrandbits(4) for _ in range(30)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(x),) for x in numbers], "bits long")
    links = [(r.a, r.b) for r in simhash.links(nodes).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links) and len(links) <= 65 * len(numbers)
    reach = {signed(x): signed(x) for x in numbers}

    def root(x):
        while reach[x] != x:
            x = reach[x]
        return x

    for a, b in links:
        reach[root(a)] = root(b)
    want = plain_components({x: x for x in numbers})
    assert len({(root(signed(x)), want[x]) for x in numbers}) == len(set(want.values())) == len({root(signed(x)) for x in numbers})


def test_frequent_keys_are_joined_without_a_shuffle(spark):
    rows = spark.createDataFrame([(i, 7 if i % 3 else i) for i in range(300)], "i long, k long")
    lookup = rows.groupBy("k").count().selectExpr("k", "count AS n", "k * 2 AS v")
    got = joined_by_key(rows, lookup, "k", "n", least_share=50).select("i", "v").collect()
    assert sorted((r.i, r.v) for r in got) == [(i, 14 if i % 3 else 2 * i) for i in range(300)]


# collocations


def plain_mined(rows, least, top, most=5):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, most + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = []
    for lang in totals:
        found = {p: a for (g, p), a in counts.items() if g == lang and a >= least and len(p) > 1}
        best = []
        for p, a in found.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in found.items()):
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def odd_prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "élan", "vital", "x", "y"]
    return "".join(rng.choices(words, [9, 3, 8, 4, 4, 2, 1, 1, 1, 1])[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " ! ", "\r\n"]) for _ in range(n))


@pytest.mark.parametrize("width", [1 << 20, 64])
def test_collocations_against_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(collocations, "BLOCK", 400)
    monkeypatch.setattr(collocations, "KEPT", 40)
    texts = [None, "", " .,\n", "new york", "new york city " * 60, "a a a a a a a " * 9, *(odd_prose(i, 150) for i in range(40)), odd_prose(99, 3000), odd_prose(1, 150)]
    langs = ["en", "fr", None, "und", "en"]
    docs = documents(spark, texts, langs)
    got = collocations.mined(docs, least=12, top=25, width=width)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_mined([(r.text, r.lang) for r in docs.collect()], 12, 25)
    assert collocations.mined(docs.limit(0), width=width).count() == 0
    with pytest.raises(ValueError):
        collocations.counted(docs, least=300)


def test_blocks_give_each_phrase_once(monkeypatch):
    text = odd_prose(4, 2000).encode()
    whole = Counter()
    for size in (1 << 21, 300, 40):
        monkeypatch.setattr(collocations, "BLOCK", size)
        found = Counter()
        for b in collocations.blocks([b"", text, b" a b. c"], np.array([0, 1, 0])):
            p = collocations.Phrases(b, ["en", "fr"])
            for k in range(1, 6):
                found.update((int(b.lang[i]), b.data[b.starts[i] : b.ends[i + k - 1]]) for i in p.starts(k).tolist())
        whole = whole or found
        assert found == whole


def test_scores_beyond_64_bits(spark):
    n = 10**15
    rows = [("en", None, n), ("en", "a", 2 * 10**13), ("en", "b", 3 * 10**13), ("en", "a b", 10**13)]
    r = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, a long")).first()
    assert r.score == 1000 * 10**13 * n // (2 * 10**13 * 3 * 10**13) and (r.l, r.r) == (2 * 10**13, 3 * 10**13)


# whitening


def plain_whitened(vectors, k):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fit), fit.sum(0)
    centred = np.array((fit * n - s), float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    w = (np.array(np.array(x, object) * n - s, float) / n) @ axes[:, order] / np.sqrt(values[order])
    return n, deviation, w, values[order] / values.sum()


def near(got, vectors, k):
    """got: rows by id and component; vectors: by id."""
    ids = sorted(vectors)
    n, deviation, w, explained = plain_whitened([vectors[i] for i in ids], k)
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got) == len(ids) * w.shape[1]
    mine = np.array([[by[i, c + 1]["whitened"] for c in range(w.shape[1])] for i in ids])
    sign = np.sign((mine * w).sum(0))
    assert np.allclose(mine, w * sign, rtol=1e-6, atol=1e-7)
    for row, i in enumerate(ids):
        for c in range(w.shape[1]):
            r = by[i, c + 1]
            assert r["n"] == n and r["deviation"] == deviation[row] and math.isclose(r["explained"], explained[c], rel_tol=1e-7) and r["identity_error"] < 1e-9


@here
def test_whitening_query_against_numpy(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    near([r.asDict() for r in queries.op13_whitening(spark, SF).collect()], vectors, 16)


def test_whitening_of_odd_rows(spark):
    rng = random.Random(8)
    good = [[rng.gauss(0, 2), rng.gauss(1, 1), rng.gauss(-3, 0.5), 7.0] for _ in range(60)]
    good += [good[0]] * 30 + [[-1e3, 2.0, 3.0, 7.0]]
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [float("inf"), 1.0, 2.0, 3.0], [float("-inf"), 1.0, 2.0, 3.0], [1.0, 2.0]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good + bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, i int")
    got = whitening.whitened(table, components=16).withColumnRenamed("id", "vec_id").collect()
    # the last dimension is constant, so three components can be scaled
    near([r.asDict() for r in got], dict(enumerate(good)), 3)
    assert whitening.whitened(table.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id int, embedding array<float>")
    assert whitening.whitened(same).columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened(same).count() == 0
    null_id = spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 5.0])], "vec_id string, embedding array<float>")
    assert {r.id for r in whitening.whitened(null_id).collect()} == {"1", None}
