"""Bounded samples of labelled documents for fitting models."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.shared import crc_remainder, written


def least_hashes(rows: DataFrame, n: int, seed: str) -> DataFrame:
    """The ``n`` rows whose ``id`` has the least hashes ``h``; all rows where there are fewer.

    A bound on the hash that leaves a little more than ``n`` of a larger table comes first, so few rows are sorted.
    """
    hashed = rows.withColumn("h", F.xxhash64("id", F.lit(seed)))
    total = rows.count()
    share = (n + 6 * n**0.5 + 20) / max(1, total)
    if share < 1:
        hashed = hashed.where(F.col("h") <= F.lit(int((share - 0.5) * 2**64)))
    return hashed.orderBy("h").limit(n)


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, bound: int) -> DataFrame:
    """At most ``bound`` rows ``h, label, text`` that are not held out, drawn by a hash ``h`` of doc_id.

    Unlabelled rows and null ids are left out; of rows that share a doc_id the largest label and one text count. The
    drawn ids have that proven bound, so they are broadcast to the scan of the texts.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (crc_remainder(F.col("id"), modulus) != held_out))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    ids = least_hashes(known, bound, label)
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"])
    hits = rows.join(F.broadcast(ids), "id").where(F.col("text").isNotNull())
    return hits.groupBy("id", "h", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).drop("id")


def bounded(bags: DataFrame, columns: list[str], n_bytes: int) -> DataFrame:
    """The examples ``h, label`` and binary ``columns`` of least hashes that have at most ``n_bytes`` together.

    The examples are written first; only their sizes come to the driver.
    """
    bags = written(bags, "examples")
    size = sum((F.octet_length(c) for c in columns), F.lit(64))
    sizes = bags.select("h", "label", size.alias("size")).toPandas().sort_values(["h", "label", "size"])
    fit = sizes["h"][(sizes["size"].cumsum() <= n_bytes)]
    return bags.where(F.col("h") <= F.lit(int(fit.iloc[-1]))) if len(fit) else bags.limit(0)


def collected(bags: DataFrame, columns: list[str], n_bytes: int) -> pd.DataFrame:
    """The ``bounded`` examples on the driver, ordered by ``h, label`` and the first column."""
    return bounded(bags, columns, n_bytes).toPandas().sort_values(["h", "label", columns[0]], ignore_index=True)
