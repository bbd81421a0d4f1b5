"""Texts without sentence ends or of one line."""

import random
import re

from larkspur.llm import fingerprints, queries


def test_texts_of_one_line_keep_their_likeness(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdefghiklmnoprstuw") for _ in range(rng.randint(2, 8)))
    plain = [" ".join(word() for _ in range(80)) for _ in range(4)]
    sentences = [" ".join("The " + " ".join(word() for _ in range(9)) + rng.choice(".!?") for _ in range(8)) for _ in range(4)]
    accented = [" ".join("École " + " ".join(word() for _ in range(9)) + "." for _ in range(8)) for _ in range(3)]
    same = ["no" + "x" * 7 + " " + "xx " * 200, "q" * 900, "", "  \n ", "one\n\n two words\t three"]
    texts = plain + sentences + accented + same
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_fingerprints(spark, str(tmp_path)).collect()}
    passages = lambda t: set(re.findall(fingerprints.PASSAGE, t, re.ASCII))
    for d, own in enumerate(texts):
        following = texts[d - 1]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert "".join(re.findall(fingerprints.PASSAGE, own, re.ASCII)).split() == [] or re.sub(r"\s", "", "".join(re.findall(fingerprints.PASSAGE, own, re.ASCII))) == re.sub(r"\s", "", own)
        for column, other in (("near_edited", edited), ("near_next", following)):
            a, b = passages(own), passages(other)
            assert abs(got[d][column] - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
    # half of the text is kept, so some of its passages are
    assert all(got[d].near_edited > 0 for d in range(len(plain + sentences + accented)))
