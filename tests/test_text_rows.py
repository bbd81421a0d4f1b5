"""Tokens, repeated blocks and loops against plain Python."""

from pyspark.sql import functions as F

from larkspur.functions import scalars as C
from larkspur.operators import text as X

TEXTS = [
    None, "", " \n ", "one", "a b c d e f g h", "x " * 12, "a b c d e f g h i. A b c d e f g h i j; a b c d e f g h",
    "[00:01] Ann Lee: Hello, World!\nhello hello\nhello hello hello end", "---\nkey: v\n---\nbody body",
]


def _tokens(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {}
    for r in X.tokens(docs, "id", "text").orderBy("id", "pos").collect():
        got.setdefault(r.id, []).append(r.token)
        assert r.pos == len(got[r.id]) - 1
    return docs, got


def test_counts_and_lines(spark):
    docs, got = _tokens(spark)
    assert got[7] == ["ann", "lee", "hello", "world", *["hello"] * 5, "end"] and got[8] == ["body", "body"] and not {0, 1, 2} & set(got)
    rows = {r.id: (r.n, r.kinds, r.last) for r in X.token_counts(docs, "id", "text").collect()}
    assert rows == {i: (len(t), len(set(t)), len(t) - 1) for i, t in got.items()}
    lines = [r.line_no for r in X.tokens(docs.where("id = 7"), "id", "text").orderBy("pos").collect()]
    assert lines == [0, 0, 0, 0, 1, 1, 2, 2, 2, 2]


def test_blocks(spark):
    docs, got = _tokens(spark)
    want = set()
    for i, t in got.items():
        first, hits = {}, {}
        for p in range(len(t) - 7):
            q = first.setdefault(tuple(t[p : p + 8]), p)
            if q < p:
                hits.setdefault(p - q, []).append(p)
        for gap, at in hits.items():
            for p in at:
                if p - 1 not in at:
                    n = next(n for n in range(len(at) + 1) if p + n not in at)
                    want.add((i, p - gap, p, n + 7))
    assert {(r.id, r.first, r.second, r.tokens) for r in X.block_repeats(docs, "id", "text", 8).collect()} == want and len(want) > 2


def test_loops(spark):
    docs = _tokens(spark)[0]
    rows = {r.id: (r.words, r.removed) for r in X.collapse_loops(docs, "id", "text", 5).collect()}
    plain = {i: t.split() for i, t in enumerate(TEXTS) if t and t.split()}
    # "World!" parts the first of six
    assert rows == {i: (len(t), 0) for i, t in plain.items()} | {5: (1, 11), 7: (len(plain[7]) - 4, 4)}


def test_tokens_of_stamped_lines(spark):
    """A mark takes the space behind it, so the next one on a line is none. Signs part words, ``_`` does not; only numbered speakers are marks, wherever they stand; text before a colon is content."""
    text = "---\nhead: x\n---\n[12:34] Today: well-known don't stop. Speaker 3] foo_bar\n[1.05] Speaker 1: Speaker 2: Ünï 5%\rlast"
    rows = X.tokens(spark.createDataFrame([(1, text), (2, "a---b"), (3, "x [12:34] y"), (4, None)], "k int, t string"), "k", "t").orderBy("k", "pos").collect()
    words = {k: [r.token for r in rows if r.k == k] for k in (1, 2, 3, 4)}
    assert words == {1: ["today", "well", "known", "don", "t", "stop", "foo_bar", "speaker", "2", "ünï", "5", "last"], 2: ["b"], 3: ["x", "12", "34", "y"], 4: []}
    assert [r.line_no for r in rows if r.k == 1] == [1] * 7 + [2, 2, 2, 2, 3]


def test_stamps_become_seconds(spark):
    rows = [("[12:34] a", 754), ("[1.05]", 65), ("[1:00:05] b", 3605), (" [12:34]", None), ("none", None), (None, None)]
    got = spark.createDataFrame(rows, "t string, want int").select(C.stamp_seconds(F.col("t")).alias("s"), "want").collect()
    assert [r.s for r in got] == [r.want for r in got]


def test_loops_are_white_space_tokens(spark):
    texts = ["I " * 19 + "x", "I " * 20 + "It", "no, No,\tNO,\n" * 7, "a. a, a " * 30, "", "[0:01] Ann: go\n[00:02] go " + "go " * 25]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r.k: (r.words, r.removed) for r in X.collapse_loops(docs, "k", "t").collect()}
    assert got == {0: (20, 0), 1: (2, 19), 2: (1, 20), 3: (90, 0), 5: (5, 25)}
    said = {r.k: (r.words, r.removed) for r in X.spoken_words(docs, "k", "t").collect()}
    assert said[5] == (1, 26) and said[1] == (2, 19)


def test_furniture_has_single_spaces(spark):
    pages = [(1, i, f"Broker{' ' * (i + 1)}Name\n\nbody {i}\nmore {i}\nx{i}xx\ny{i}yy\nz{i}zz") for i in range(3)] + [(1, 9, " \n\n"), (1, 10, None)]
    got = X.page_furniture(spark.createDataFrame(pages, "d int, p int, t string"), "d", "p", "t").collect()
    assert [(r.line, r.pages) for r in got] == [("Broker Name", 3)]


def test_rounding_of_the_binary_value(spark):
    import random

    rng = random.Random(4)
    numbers = [2.675, 2.665, 1.005, 0.125, 0.375, -2.675, -0.125, 0.0, 5e-324, 1e15 + 0.5, 4503599627370497.5, 1e300, 0.285, 1.115, 545.4445]
    numbers += [rng.randint(-(10**7), 10**7) / 1000 for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(500)] + [rng.getrandbits(20) / 8 for _ in range(200)]
    for digits in (0, 1, 2, 4):
        got = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", C.round_binary(F.col("x"), digits).alias("r")).collect()
        assert [r.r for r in got] == [round(r.x, digits) for r in got]


def test_label_checks(spark):
    long = "\n".join(f"[{m}:00] Ann: x" for m in (0, 5, 14)) + "\n[15:00] Bo Li: y\n[15:30] Ann: z"
    texts = {
        "long": long, "none": "nothing here", "one": "[00:01] Ann: a\n[00:02] Ann: b", "bare": "[00:01] Ann: a\n[00:02] b\n[00:03] c",
        "mixed": "[00:01] Speaker 1: a\n[1:00:02] Ann: b", "bad": "[00:01] *Bo: a\n[00:02] And so we went on: b\n[00:03] Agent 7: c\n[00:04] Jo [x]: d\n[00:05] Ann: e",
    }
    docs = spark.createDataFrame([(k, t, 2) for k, t in texts.items()], "k string, t string, hosts int")
    got = {r.k: r for r in X.label_checks(docs, "k", "t", "hosts").collect()}
    assert (got["long"].turns, got["long"].speakers, got["long"].longest, got["long"].alone) == (5, 2, 900, True)
    assert got["none"].unlabelled and got["none"].turns == 0 and got["one"].merged and not got["one"].alone and got["bare"].unlabelled
    assert got["mixed"].mixed and got["mixed"].longest == 3601 and got["bad"].malformed == 4 and not got["bad"].mixed


def test_stamps_of_parts(spark):
    rows = [("[00:10] a\nb\n [105:30] c", 1200, "[20:10] a\nb\n [2:05:30] c"), ("[19:00] a\n[21:00] b", 1200, "[19:00] a\n[21:00] b"), ("[00:10] a", 0, "[00:10] a"), ("no stamp", 60, "no stamp"), ("[00:10] a", 100, "[00:10] a")]
    got = spark.createDataFrame(rows, "t string, o int, want string").select(C.offset_stamps(F.col("t"), F.col("o")).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_duplicate_map(spark):
    words = " ".join(f"w{i}" for i in range(30))
    text = f"[00:10] {words}\nfree line here\n[01:30] some more\n[00:05] start again\n{words}\n[00:40] end"
    docs = spark.createDataFrame([("a", text), ("b", "no stamps " + words + " and " + words)], "k string, t string")
    got = {r.k: r for r in X.duplicate_map(docs, X.block_repeats(docs, "k", "t", 8), "k", "t").collect()}
    a, b = got["a"], got["b"]
    assert (a.first, a.second, a.tokens, a.first_seg, a.first_from, a.first_to, a.dup_seg, a.dup_from, a.dup_to) == (0, 37, 30, 1, 10, 10, 2, 5, 5)
    assert a.snippet == " ".join(f"w{i}" for i in range(14)) and (b.first_seg, b.dup_seg, b.first_from) == (1, 1, None)
