"""The registered queries on the smallest tables: against SQL where there is some, else against brute force."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from larkspur.llm import fingerprints, queries
from larkspur.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, text, source, lang FROM documents ORDER BY doc_id").df()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    plain = lambda f: sorted(tuple(map(str, r)) for r in f[sorted(f.columns)].fillna("null").itertuples(index=False))
    assert plain(got) == plain(want)


def test_packing_has_each_id_once(spark, docs):
    from tokenizers import Tokenizer

    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = queries.op2_packing(spark, SF).toPandas()
    for d, part in got.sort_values("start").groupby("doc_id"):
        ids = np.array([*tok.encode(docs.text[d], add_special_tokens=False).ids, 1], "<u4")
        assert part["length"].sum() == len(ids) == part["doc_tokens"].iloc[0]
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(part["start"], part["length"])] == part["ids_crc32"].tolist()
    assert len(got["doc_id"].unique()) == len(docs)


def test_near_duplicates_are_those_of_brute_force(spark, docs):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in docs.text)]
    links = [0] * len(docs)
    for i in range(len(docs)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
    got = queries.op4_near_dup(spark, SF).toPandas().set_index("doc_id")["n_links"]
    assert got.sort_index().tolist() == links


def test_mixing_takes_the_targets(spark, docs):
    got = queries.op7_mixing(spark, SF).toPandas()
    size = docs.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert got.set_index("doc_id")["size"].sort_index().tolist() == size.tolist()
    assert (got["taken"] <= 3 * got["size"]).all()
    for _, part in got.groupby("source"):
        assert part["source_size"].iloc[0] == part["size"].sum() and abs(part["taken"].sum() - part["target"].iloc[0]) <= 1
    assert abs(got.groupby("source")["target"].first().sum() - size.sum()) < 1e-6 * size.sum()


def test_fingerprints_give_the_likeness_of_passage_sets(spark, docs):
    # Java's classes of white space are ASCII ones
    passages = lambda t: set(re.findall(fingerprints.PASSAGE, t, re.ASCII))
    got = queries.op8_fingerprints(spark, SF).toPandas().set_index("doc_id")
    order = docs.doc_id.sort_values(ascending=False).tolist()
    text = dict(zip(docs.doc_id, docs.text))
    for k, d in enumerate(order):
        own, following = text[d], text[order[(k + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        row = got.loc[d]
        assert row.n_chars == len(own) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for column, other in (("near_edited", edited), ("near_next", following)):
            a, b = passages(own), passages(other)
            assert abs(row[column] - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
    assert got.groupby(docs.set_index("doc_id").text.reindex(got.index))["fingerprint"].nunique().max() == 1


@pytest.mark.parametrize("name,modulus,rest", [("op1_quality", 3, 1), ("op9_toxicity", 4, 2), ("op10_language_id", 4, 2)])
def test_scores_cover_all_documents(spark, docs, name, modulus, rest):
    got = queries.QUERIES[name](spark, SF).toPandas().sort_values("doc_id")
    assert got["doc_id"].tolist() == docs.doc_id.tolist() and got["score"].between(0, 1).all()
    assert got["held_out"].tolist() == [zlib.crc32(str(d).encode()) % modulus == rest for d in docs.doc_id]
    if name == "op10_language_id":
        assert (got["lang_pred"].to_numpy() == docs.lang.to_numpy()).mean() > 0.95


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert isinstance(got, pd.DataFrame) and len(got) and (got["length"] > 0).all()
