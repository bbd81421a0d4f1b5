"""Links between texts whose common buckets all have first texts that are like neither of them."""

import random

from larkspur.llm import near_dup


def test_links_are_found_behind_unlike_first_texts(spark):
    rng = random.Random(21)
    words = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    texts, pairs = [], []
    for _ in range(30):
        # the two share the template and nothing else; all others of the template have as much text of their own again
        template = words(104)
        pairs.append((len(texts), len(texts) + 1))
        texts += [template + words(11), template + words(11)]
        texts += [template + words(60) for _ in range(120)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in pairs)
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
    linked = {x for p in pairs for x in p}
    assert all(got[a].class_id == got[b].class_id == a for a, b in pairs)
    assert all(r.n_links == (d in linked) for d, r in got.items())
