"""Pairs with too many differences are peeled with the others, and what is found in their larger sketches is counted."""

import re
import unicodedata

from pyspark.sql import functions as F

from larkspur.llm import fingerprints


def test_full_pairs_are_solved_in_the_same_steps_by_two_rows(spark):
    numbers = lambda a, b: F.transform(F.sequence(F.lit(a), F.lit(b)), lambda i: F.shiftrightunsigned(F.xxhash64(F.col("row"), i), 24))
    keys = lambda a, b: F.transform(numbers(a, b), lambda s: F.shiftleft(s, 24).bitwiseOR(fingerprints._check(s)))
    doc = F.struct(keys(1, 100).alias("own"), keys(6, 105).alias("changed"), keys(91, 240).alias("following"))
    rows = spark.range(200).withColumnRenamed("id", "row").select("row", doc.alias("doc")).repartition(4, "row")
    sketched = fingerprints.sketches(rows, ["row"], ["own", "changed", "following"])
    cells = fingerprints.subtracted(sketched, ["row"], [(0, 1), (0, 2)], [("own", "changed"), ("own", "following")])
    state = fingerprints.peeled(cells, ["row"], 0, 6, fingerprints.ROW_CELLS)
    # 90 digests of one side and 140 of the other are two rows, so they do not go through every step
    assert state.where("pair = 1").count() <= 2 * 200 + 20
    got = fingerprints.tallies(state, ["row"], 2).collect()
    assert len(got) == 200 and sum(r.o0.ok for r in got) > 190 and sum(r.o1.ok for r in got) >= 199
    assert all((r.o0.a_only, r.o0.b_only) == (5, 5) for r in got if r.o0.ok)
    assert all((r.o1.a_only, r.o1.b_only) == (90, 140) for r in got if r.o1.ok)


def test_the_pattern_cuts_where_the_plain_list_of_letters_does(spark):
    """Classes that are asked of most words hold no long list of letters beyond U+00FF, which Java tries one by one."""
    plain = rf"""{fingerprints._RUN}{{0,15}}?(?=\s|\Z)(?:(?=[^\S\n]*(?:\n|\Z))|(?<=[.!?])|(?<=[.!?]["'”»)])|(?<=[{fingerprints._LAST}]))|{fingerprints._RUN}{{0,15}}+"""
    letters = [chr(c) for c in [*range(0x21, 0x720), 0x201D, 0x4E00, 0x1F600] if unicodedata.category(chr(c)) not in ("Cc", "Cn")]
    texts = ["", " \n", "a\r\n b", " ".join(f"ab{c} {c} .{c} xy" for c in letters), "\n".join(f"one two{c}\t three" for c in letters), 'He said "no." Then ("yes!") »so?» end.\n' * 9, "x" * 95 + " y " * 40]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fingerprints.passages(F.col("text")).alias("new"), F.regexp_extract_all("text", F.lit(plain), F.lit(0)).alias("old"))
    assert all(r.new == r.old and (r.new or not r.text.strip()) for r in got.collect())
    behind = re.findall(r"\(\?<=\[(.*?)\]\)", fingerprints.PASSAGE)
    assert sum(c > "\xff" for c in behind[0]) == 0
