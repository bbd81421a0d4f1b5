"""The toxicity model is trained in a task: the driver holds neither the examples nor the tables of the training."""

import random
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from larkspur.llm import toxicity


def test_the_driver_holds_the_model_only(spark):
    rng = random.Random(3)
    texts = ["", *(" ".join(["vile"] * (i % 3 == 0) + rng.choices([f"w{j}" for j in range(5000)], k=4000)) for i in range(1, 200))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    tracemalloc.start()
    model = toxicity.fit(docs, labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6 << 20
    # the same examples in the same order, trained here
    hashes = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64("doc_id", F.lit("toxic")).alias("h")).collect()}
    ids = sorted((i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2), key=hashes.get)
    want = toxicity.train([(int(i % 3 == 0), np.unique(toxicity.features([texts[i]])[1]).astype(np.int32)) for i in ids])
    assert len(want.buckets) and model.bias == want.bias
    assert np.array_equal(model.buckets, want.buckets) and np.array_equal(model.weights, want.weights)


def test_without_examples_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, None), (3, "")], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(None, 1)], [(3, None)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert len(model.buckets) == 0 and toxicity.without_toxic(docs, model).count() == 2
    model = toxicity.fit(docs, spark.createDataFrame([(3, 0), (1, 1)], "doc_id long, toxic int"))
    assert len(model.buckets) == 0 and -np.inf < model.bias < 0
