"""Each operator against a brute-force version on small rows with nulls, ties, repeats, empties and long texts."""

import hashlib
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm import (
    chat_format,
    exact_dedup,
    fingerprints,
    hashing,
    language_id,
    mixing,
    near_dup,
    packing,
    quality,
    toxicity,
    url_filter,
)
from larkspur.llm.queries import byte_bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept int, row string"
WORDS = [a + b for a in "ka lo mi ne ru so ta vi".split() for b in "bar den fol gim hut".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "."]) for _ in range(n))


def rows(texts, source="a"):
    return [(i, t, "en", source, len(t or ""), "x", 1, "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, repeated, tied and very long texts, null ids, and clashing extra columns."""
    rng = random.Random(1)
    base = prose(rng, 120)
    texts = [None, "", " ", "one", base, base, base + " end", "\n".join([base] * 30), prose(rng, 20000), "é" * 50, "a\\b</s>"]
    data = rows(texts)
    data.append(data[4])
    data.append((None, base, None, None, None, None, None, None))
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# exact dedup


def test_exact_dedup_keeps_the_largest_id(spark, odd):
    got = exact_dedup.DigestIndex(spark, buckets=4).ingest(odd).toPandas()
    want = {}
    for r in odd.collect():
        want.setdefault(hashlib.sha256((r.text or "").encode()).hexdigest(), []).append(r.doc_id)
    assert len(got) == odd.count()
    for h, part in got.groupby(got["digest"].map(lambda b: bytes(b).hex())):
        ids = [i for i in want[h] if i is not None]
        assert set(part["keep_id"]) == {max(ids)} and set(part["group_size"]) == {len(want[h])}
        assert part["kept"].sum() == 1 and part.loc[part["kept"], "doc_id"].tolist() == [max(ids)]


def test_exact_dedup_against_an_index(spark, odd, empty):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    first = index.ingest(odd, batch="one")
    again = index.ingest(odd, batch="one")
    assert first.where("kept").count() == again.where("kept").count() == index.rows().count()
    later = index.ingest(spark.createDataFrame(rows(["one", "new"]), DOCS), batch="two").orderBy("doc_id").collect()
    assert [r.kept for r in later] == [False, True] and later[0].keep_id == 3 and later[0].group_size == 2
    assert index.ingest(empty).count() == 0
    # a batch that is sent again under another partitioning, also after a failure behind the append
    wide = spark.createDataFrame(rows([f"t{i % 37}" for i in range(200)]), DOCS)
    plain = lambda df: sorted(df.select("doc_id", "keep_id", "group_size", "kept").collect())
    sent = [plain(index.ingest(wide.repartition(n), batch="three")) for n in (3, 5, 1)]
    assert sent[0] == sent[1] == sent[2] and sum(r.kept for r in sent[0]) == 37
    small = index.compacted()
    assert sorted(small.rows().collect()) == sorted(index.rows().collect())
    assert plain(small.ingest(wide, batch="three")) == sent[0] and not any(r.kept for r in small.ingest(wide, batch="four").collect())
    reopened = exact_dedup.DigestIndex(spark, index.path, buckets=4)
    assert reopened.rows().count() == index.rows().count()


def test_exact_dedup_rows(odd, empty):
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert exact_dedup.deduplicate(empty).count() == 0


# URL filter


def test_url_filter_matches_plain_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http://COM/", "http://a.com", "http://a.com/x", "http://example.com/en/1",
        "https://WWW.Example.com/en/?q", "http://x.net/es/", "http://net/fr/1#a", "http://notexample.com/en/", "ftp://b.org/EN/",
        "http://b.org/cheap-pills/", "http://spam.org/", "http://spamming.org/", "x://a.net/es", "http://é.com/ü?x", "http:///com/",
    ]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] * 2, "page_id int, url string, rule string")
    got = url_filter.judge(pages, url_filter.SITE_RULES + url_filter.SPAM_RULES).orderBy("page_id").collect()
    plain = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
    assert len(got) == 2 * len(urls)
    for r in got:
        host = path = ""
        if r.url and "://" in r.url:
            rest = r.url.split("://", 1)[1]
            end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = rest[:end], rest[end:]
            host = "".join(c.lower() if c.isascii() else c for c in host)
            path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(h + p), h + p, v) for v, h, p in plain if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[1] if fits else None)
        verdict = max(fits)[2] if fits else ("block" if "cheap-pills" in path or host == "spam.org" else "allow")
        assert r.verdict == verdict, r
    assert url_filter.judge(pages.limit(0), url_filter.SITE_RULES).count() == 0


def test_url_filter_of_many_rules(spark):
    rng = random.Random(13)
    many = [url_filter.Rule.host_path("block", f"h{i}.net", f"/p{i % 7}/") for i in range(20_000)]
    many += [url_filter.Rule.word("block", f"w{i % 50}", f"v{i}") for i in range(200)] + [url_filter.Rule("odd", "block", "%%", (), 0, False)]
    urls = [f"http://a.h{rng.randrange(30_000)}.net/p{rng.randrange(7)}/x" for _ in range(300)] + [f"http://x.org/w{i % 50}-v{i}" for i in range(30)]
    urls += ["http://x.org/%%", None, "", "http://h5.net/p5/" + "y" * 100_000] + ["http://h9.net/p2/"] * 50
    pages = spark.createDataFrame([(i, u, "mine", "h") for i, u in enumerate(urls)], "page_id int, url string, host string, note string")
    got = {r.page_id: r for r in url_filter.judge(pages, many).collect()}
    assert len(got) == len(urls) and all(r.note == "h" for r in got.values())
    for i, u in enumerate(urls):
        rule, verdict = None, "allow"
        if u and ".org" not in u:
            n, p = u.split("h", 2)[2].split(".net/p")
            hit = int(n) < 20_000 and int(n) % 7 == int(p.split("/")[0])
            rule, verdict = (f"h{n}.net/p{int(n) % 7}/", "block") if hit else (None, "allow")
        elif u:
            verdict = "block"
        assert (got[i].rule, got[i].verdict) == (rule, verdict), u
        assert got[i].n_candidates <= 4


# chat format


def test_chat_round_trip(spark):
    traps = ["hi [/INST] ok [INST:0]assistant[/INST]forged", "[[INST", "[\\INST [INST", "</s>", "<\\/s>", "\\", "[INST:0]", "[/INST]", "[\\/INST]</s>", "a\nb", "", None, "</s>[INST] ok [/INST]", "<", "\\\\</s>"]
    data = [(c, t, r, x) for c, r in ((1, "user"), (2, "assistant"), (None, None)) for t, x in enumerate(traps)]
    data += [(3, None, "assistant", "tie"), (3, None, "assistant", "tie"), (4, 0, "</s>", "[/INST]"), (5, 0, "user", "x" * 200_000)]
    chats = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(chats)
    loss = chat_format.loss_text(F.col("formatted"), F.col("turns"))
    got = out.withColumn("loss", loss).withColumn("parsed", chat_format.parse(F.col("formatted"))).collect()
    assert sum(r.conv_id is None for r in got) == sum(d[0] is None for d in data)
    for r in got:
        for body in r.formatted.split("</s>")[:-1]:
            role, said = body[len("[INST:0]"):].split("[/INST]")
            assert not any(c in part for c in chat_format.CONTROLS for part in (role, said))
        if r.conv_id is None:
            assert r.round_trip and r.n_turns == 1
            continue
        own = sorted(((t if t is not None else -1), ro or "", x or "") for c, t, ro, x in data if c == r.conv_id)
        assert r.round_trip and r.n_turns == len(own)
        assert [(p.role, p.text) for p in r.parsed] == [(ro, x) for _, ro, x in own]
        assert r.loss == "".join(x for _, ro, x in own if ro == "assistant")
        for span, (_, ro, _) in zip(r.turns, own):
            assert r.formatted[span.start : span.end].endswith("</s>") and (span.loss_start == span.loss_end) == (ro != "assistant" or span.loss_start == span.loss_end)
    assert chat_format.format_conversations(chats.limit(0)).count() == 0


# mixing


def test_mixing_reaches_targets(spark, odd, empty):
    rng = random.Random(2)
    data = [(i, prose(rng, rng.randint(1, 60)), "en", s, 0, "", 0, "") for i, s in enumerate(["a"] * 60 + ["b"] * 900 + ["c"] * 300 + [None] * 50)]
    docs = spark.createDataFrame(data, DOCS)
    got = mixing.mix(docs).toPandas()
    size = {s: sum(len(t.split()) for _, t, _, x, *_ in data if x == s) for s in ("a", "b", "c", None)}
    total, weights, capped = sum(size.values()), {"a": 5, "b": 2, "c": 1, None: 5}, {}
    while True:
        free = {s: w for s, w in weights.items() if s not in capped}
        level = (total - sum(capped.values())) / sum(free.values())
        over = {s: 3.0 * size[s] for s, w in free.items() if w * level > 3 * size[s]}
        if not over:
            break
        capped |= over
    want = {s: capped.get(s, weights[s] * level) for s in size}
    for s in size:
        part = got[got["source"].isna()] if s is None else got[got["source"] == s]
        assert abs(part["target"].iloc[0] - want[s]) < 1e-6 * total and abs(part["taken"].sum() - want[s]) <= 1
    assert (got["taken"] <= 3 * got["size"]).all() and len(got) == len(data)
    assert mixing.mix(docs).exceptAll(mixing.mix(docs.repartition(7))).count() == 0
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(empty).count() == 0
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixing.mixed_rows(empty).count() == 0
    assert mixing.mixed_rows(odd).count() > 0


def test_mixing_selects_by_key_and_copies_rows(spark, monkeypatch):
    """The order of selection against a plain version, with one weight for all rows and with many."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)
    rng = random.Random(14)
    data = [(i, prose(rng, rng.randint(1, 30)), "en", "ab"[i % 5 > 1], 0, "", 0, "") for i in range(3000)]
    docs = spark.createDataFrame(data, DOCS).withColumn("w", F.lit(0.1))
    for weight in (F.col("w"), None):
        got = {r.doc_id: r for r in mixing.mix(docs, weights=(1, 3), max_epochs=9, weight=weight).collect()}
        w = mixing.quality_weight(docs["text"]) if weight is None else weight
        keys = {r.doc_id: -math.log(((r.h % 2**64 >> 11) + 0.5) / 2.0**53) / r.w for r in docs.select("doc_id", F.xxhash64("doc_id", "text", F.lit(17)).alias("h"), w.alias("w")).collect()}
        for source in "ab":
            own = sorted((r for r in got.values() if r.source == source), key=lambda r: keys[r.doc_id])
            epochs, left = divmod(round(own[0].target), own[0].source_size)
            for r in own:
                assert r.taken == epochs * r["size"] + min(r["size"], left)
                left -= min(r["size"], left)
    rows_in = spark.createDataFrame([(1, "a b", "", "s", 0, "", 0, "")] * 3 + [(None, "c d", "", "s", 0, "", 0, "")] * 2 + [(2, None, "", "s", 0, "", 0, ""), (3, "", "", "t", 0, "", 0, "")], DOCS)
    out = mixing.mixed_rows(rows_in, weights=(1, 1), max_epochs=3).collect()
    assert sum(len((r.text or "").split()) for r in out) == 10 and {2, 3} <= {r.doc_id for r in out}


# fingerprints


def test_fingerprints_recover_differences(spark, odd, empty):
    rng = random.Random(3)
    lines = [prose(rng, 6) for _ in range(400)]
    pairs = [(0, lines[:50], lines[10:60]), (1, lines[:3], lines[:3]), (2, lines, lines[:200]), (3, [], []), (4, [], lines[:1]), (5, lines[:200], lines[200:])]
    df = spark.createDataFrame([(p, "\n".join(a), "\n".join(b)) for p, a, b in pairs], "pair long, ta string, tb string")
    df = df.withColumns({"a": fingerprints.digests(F.col("ta")), "b": fingerprints.digests(F.col("tb"))})
    want = {r.pair: (set(r.a) - set(r.b), set(r.b) - set(r.a)) for r in df.collect()}
    got = {r.pair: (set(r.a_only), set(r.b_only)) for r in fingerprints.differences(df).collect()}
    assert got == want
    prints = fingerprints.fingerprint(odd).toPandas()
    assert prints.groupby(prints["text"].fillna(""))["fingerprint"].nunique().max() == 1
    assert fingerprints.fingerprint(empty).count() == 0 and fingerprints.differences(df.limit(0)).count() == 0


def test_next_document_order(spark, monkeypatch, odd):
    monkeypatch.setattr(fingerprints, "PART_ROWS", 2)
    monkeypatch.setattr(fingerprints, "TASK_BYTES", 64)
    rng = random.Random(12)
    ids = [5, 3, 1200, 10**10, 10**10 - 1, -4, 513, 512, None] + [rng.getrandbits(62) for _ in range(40)] + [77] * 60 + [None] * 30
    docs = spark.createDataFrame([(i, f"t{n}", "", "", 0, "", 0, "") for n, i in enumerate(ids)], DOCS)
    hashed = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(docs.collect(), key=lambda r: (-(r.doc_id if r.doc_id is not None else -(2**63)), hashed[r.text]))
    got = {r.text: r.next_text for r in fingerprints.with_next(docs).collect()}
    assert got == {r.text: order[(k + 1) % len(order)].text for k, r in enumerate(order)}
    one = spark.createDataFrame([(None, "", "", "", 0, "", 0, "")], DOCS)
    assert [(r.doc_id, r.text, r.next_text) for r in fingerprints.with_next(one).collect()] == [(None, "", "")]
    assert fingerprints.with_next(odd).count() == odd.count() and fingerprints.with_next(odd.limit(0)).count() == 0


# near duplicates


def brute_links(texts, words=5, threshold=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    n = len(texts)
    links, root = [0] * n, list(range(n))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(n):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    return links, [find(i) for i in range(n)]


def varied(rng):
    texts = [None, "", "one", "one", "Two words", "two words"]
    for _ in range(12):
        base = prose(rng, 150).split()
        for k in range(7):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
        texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("chunk", [512, 4])
def test_near_duplicates_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    texts = varied(random.Random(4))
    got = near_dup.near_duplicates(spark.createDataFrame(rows(texts), DOCS)).orderBy("doc_id").toPandas()
    links, root = brute_links(texts)
    low = {}
    for i, r in enumerate(root):
        low.setdefault(r, i)
    assert got["n_links"].tolist() == links
    assert got["class_id"].tolist() == [low[r] for r in root]


def test_texts_of_one_template_do_not_meet(spark, monkeypatch):
    """Templated texts without similar pairs stay out of the work groups, and the similar pairs among them are found."""
    rng = random.Random(15)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts, pairs = [], []
    for share in (140, 150, 160):
        template = words(share)
        for i in range(2000):
            texts.append(template + words(200 - share))
            if i % 20 == 0:
                copy = list(texts[-1])
                for _ in range(rng.randrange(1, 4)):
                    copy[rng.randrange(200)] = "changed"
                pairs.append((len(texts) - 1, len(texts)))
                texts.append(copy)
    sizes = []
    whole = near_dup.components
    monkeypatch.setattr(near_dup, "components", lambda edges, name="components": sizes.append(whole(edges, name).groupBy("comp").count().agg({"count": "max"}).first()[0] or 0) or whole(edges, name))
    docs = spark.createDataFrame([(i, " ".join(t), "", "", 0, "", 0, "") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
    sets = {i: {tuple(t[k : k + 5]) for k in range(196)} for i, t in enumerate(texts)}
    true = [p for p in pairs if len(sets[p[0]] & sets[p[1]]) >= 0.8 * len(sets[p[0]] | sets[p[1]])]
    assert len(true) > 200 and sum(got[a].class_id == got[b].class_id for a, b in true) >= 0.99 * len(true)
    assert all(got[i].n_links == 0 for i in set(range(len(texts))) - {x for p in true for x in p})
    # work groups hold a small part of the six thousand texts
    assert sizes[0] < 50


def test_near_duplicate_rows(spark, odd, empty):
    kept = near_dup.one_of_each(odd)
    assert kept.columns == odd.columns and kept.where("text = 'one'").count() == 1
    assert kept.count() == near_dup.near_duplicates(odd).select("class_id").distinct().count()
    assert near_dup.one_of_each(empty).count() == 0 and near_dup.near_duplicates(empty).count() == 0


def test_bayesian_bounds_keep_similar_pairs():
    need = near_dup.needed_matches(0.8)
    assert all(m < 0.8 * n for n, m in need.items()) and need[128] > 70


# packing


def test_packing_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    import public_tokenizers

    rng = random.Random(5)
    texts = [r.text for r in odd.collect()] + [prose(rng, rng.randint(1, 3000)) for _ in range(120)] + ["x <|endoftext|> y", "  a\t\n b ", "日本 🎉"]
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = packing.packed(docs, *byte_bpe()).toPandas()
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [np.array([*e.ids, 1], "<u4") for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for d, part in got.sort_values("start").groupby("doc_id"):
        assert (part["doc_tokens"] == len(ids[d])).all()
        assert part["start"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() == len(ids[d])
        for p in part.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[d][p.start : p.start + p.length].tobytes())
    padding = 0
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]]
        n = part["length"].sum()
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding == 0 and got["doc_id"].nunique() == len(texts)
    assert packing.packed(empty, *byte_bpe()).count() == 0


def test_combinations_fill_the_window():
    rng = np.random.default_rng(6)
    histogram = np.bincount(rng.integers(1, 2048, 20000), minlength=2048)
    combos = packing.combinations(histogram)
    x = packing.repeat_counts(combos, histogram)
    total = combos.sum(1)
    assert ((total == 2048) | ((combos[:, 1] == 0) & (total & (total - 1) == 0))).all() and (x >= 0).all()
    # at the optimum no column's gradient is negative, and those in use have none
    used = np.bincount(combos.ravel(), np.repeat(x, 3), 2048) - histogram
    used[0] = 0
    gradient = used[combos].sum(1)
    assert gradient.min() > -0.5 and abs(gradient @ x) < 0.01 * (histogram @ histogram)


# models


def test_quality_toxicity_language(spark, odd, empty):
    rng = random.Random(7)
    texts, labels, langs = [], [], []
    for i in range(600):
        bad, rude, lang = i % 4 == 0, i % 5 == 0, "en" if i % 2 else "xx"
        words = prose(rng, 60).split()
        if lang == "xx":
            words = [w[::-1] + "zq" for w in words]
        if rude:
            words[5:5] = ["vile", "brute"]
        if bad:
            words = [w + "%%%" for w in words]
        texts.append(" ".join(words))
        labels.append((i, int(not bad), int(rude)))
        langs.append(lang)
    docs = spark.createDataFrame([(i, t, k, "s", 0, "", 0, "") for i, (t, k) in enumerate(zip(texts, langs))], DOCS)
    marks = spark.createDataFrame([*labels, (None, None, None), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    q, t, m = quality.fit(docs, marks), toxicity.fit(docs, marks), language_id.fit(docs)
    out = docs.select(
        "doc_id", quality.score(docs["text"], q, docs).alias("q"), toxicity.score(docs["text"], t, docs).alias("t"),
        language_id.predict(docs["text"], m, docs).alias("l"),
    ).toPandas()
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 12 in (10,)] or list(range(0, 600, 7))
    by = out.set_index("doc_id")
    assert np.mean([(by.q[i] >= 0.5) == bool(labels[i][1]) for i in held]) > 0.95
    assert np.mean([(by.t[i] >= 0.3) == bool(labels[i][2]) for i in held]) > 0.95
    assert np.mean([by.l[i]["lang_pred"] == langs[i] for i in held]) > 0.95
    assert set(toxicity.without_toxic(docs, t).columns) == set(docs.columns)
    for frame in (odd, empty):
        for model, column in ((q, quality.score), (t, toxicity.score)):
            got = frame.select(column(frame["text"], model, frame).alias("s")).toPandas()
            assert len(got) == frame.count() and got["s"].between(0, 1).all()
        got = frame.select(language_id.predict(frame["text"], m, frame).alias("p")).select("p.*").toPandas()
        assert len(got) == frame.count()
    blank = quality.fit(empty, marks.limit(0)), toxicity.fit(empty, marks.limit(0)), language_id.fit(empty)
    assert quality.scores(["x", None], blank[0]).tolist() == [0.5, 0.5] and len(blank[1].buckets) == 0
    assert language_id.predictions(["abc", None], blank[2])["lang_pred"].tolist() == ["und", "und"]
    assert language_id.predictions(["123", None, ""], m)["lang_pred"].tolist() == ["und"] * 3


@pytest.mark.parametrize("wide", [False, True])
def test_language_phrases_against_substring_search(wide):
    rng = random.Random(8)
    sample = {"a": prose(rng, 60), "b": prose(rng, 60)[::-1]}
    text = prose(rng, 3000)
    if wide:  # an alphabet of thousands of letters
        han = [chr(c) for c in range(0x4E00, 0x5E00)]
        sample["c"] = "".join(rng.choice(han) for _ in range(3000))
        text = sample["c"][500:900] + text + "".join(rng.choice(han) for _ in range(500)) + sample["c"][:300]
    model = language_id.build(sample)
    counts, _, _ = language_id.phrases([text, "", "ka"], model)
    for k, lang in enumerate(model.languages):
        codes = lambda s: tuple(language_id.encode(s.lower(), model.codes).tolist())
        whole, left = codes(sample[lang]), codes(text)
        known = {whole[i : i + m] for m in range(1, 60) for i in range(len(whole) - m + 1)} | {whole[i : i + m] for m in range(60, 410) for i in (0, 500)}
        at = n = 0
        while at < len(left):
            size = 1
            while at + size < len(left) and left[at : at + size + 1] in known:
                size += 1
            at, n = at + size, n + 1
        assert counts[k, 0] == n, lang


def test_hashes_do_not_depend_on_the_batch():
    texts = ["a b c", None, "", "ü b", "a b c", "long " * 500_000]
    h, own = hashing.word_hashes(texts)
    alone = [hashing.word_hashes([t])[0] for t in texts]
    assert all((h[own == i] == a).all() and (own == i).sum() == len(a) for i, a in enumerate(alone))
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS).astype(np.float32), 0.1)
    assert np.allclose(quality.scores(texts, model), [quality.scores([t], model)[0] for t in texts])


# pipeline


def test_pipeline_stages_keep_columns_and_clean_documents(spark, tmp_path):
    rng = random.Random(9)
    texts = [prose(rng, 80) for _ in range(150)]
    texts += [texts[0], texts[1] + " end", "vile brute " + prose(rng, 60)]
    docs = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    train = [(1000 + i, ("vile brute " if i % 2 else "") + prose(rng, 60), "en", "s0", 9) for i in range(200)]
    path = str(tmp_path)
    spark.createDataFrame(docs + train, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1000 + i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    frame, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, path)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        kept.append({r.doc_id for r in frame.select("doc_id").collect()})
    assert 152 not in kept[0] and not {i for i in kept[0] if i >= 1000 and i % 2} and set(range(150)) <= kept[0]
    assert 150 in kept[1] and 0 not in kept[1] and kept[1] == kept[0] - {0}
    assert kept[2] == kept[1] - {151}
    assert corpus_pipeline.run(spark, path).count() > 0
    assert pd.Series(list(kept[3])).isin(kept[2]).all()
