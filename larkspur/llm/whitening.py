"""Whitening of embeddings by the eigenvectors of their exactly centred covariance.

Entries become integers ``floor(64 * c) + 1000000``. The fit list is each distinct integer vector once. With its length n and the
sums S of each dimension, a vector is centred as the integer ``n * x - S`` before anything is multiplied; MLlib's ``RowMatrix`` gives the
Gramian of the centred rows, which divided by n is the covariance. Only that matrix (dimensions squared) reaches the driver, where ``eigh``
gives the components; the means and the scaled components are broadcast, and every row is projected in ``mapInPandas``.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped; of several lengths the most frequent one
(ties: the longest) is used and the other rows are dropped, since they lie in another space; repeated vectors count once in the fit and each get
their rows; components whose eigenvalue is under ``NOISE`` of the total variance cannot be scaled and are not returned, so a table of one distinct
vector, like an empty one, gives no rows; a null id passes through, and other columns are not read. Entries must be under 2**46 in size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.shared import written

COMPONENTS = 16
#: How an entry becomes an integer.
SCALE, SHIFT = 64, 1_000_000
#: Least share of the total variance of a component that is returned; the covariance is known to about 1e-15 of it.
NOISE = 1e-13


class Model(NamedTuple):
    n: int
    sums: list[int]
    #: Dimensions x components, each unit eigenvector divided by the root of its eigenvalue.
    projection: np.ndarray
    explained: list[float]


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)


def usable(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, x`` of the rows that can be whitened."""
    vector, infinite = F.col(column), F.lit(float("inf"))
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    good = rows.where(vector.isNotNull() & (F.size(vector) > 0)).where(finite)
    lengths = good.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return good.where(F.size(vector) == (most[0]["d"] if most else 0)).select(F.col(id_column).alias("id"), integers(vector).alias("x"))


def gramian(rows: DataFrame, column: str) -> np.ndarray:
    """Sum of the outer products of the array column."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(column).alias("v")), "v")
    return RowMatrix(vectors).computeGramianMatrix().toArray()


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of the distinct vectors ``x``; None where nothing varies."""
    n = distinct.count()
    by_place = distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"))
    sums = [r["s"] for r in by_place.orderBy("i").collect()]
    if n < 2:
        return None
    covariance = gramian(distinct.select(centred(n, sums).alias("v")), "v") / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > NOISE * np.trace(covariance)]
    if not len(order):
        return None
    axes = axes[:, order]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(len(order))])
    return Model(n, sums, axes / np.sqrt(values[order]), (values[order] / np.trace(covariance)).tolist())


def centred(n: int, sums: list[int]) -> Column:
    """``x`` less the mean, rounded once."""
    return F.transform("x", lambda c, i: (c * n - F.get(F.lit(sums), i)).cast("double") / n)


def projector(model: Model, spark) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For ``mapInPandas``: adds the array ``w`` of whitened values."""
    shared = spark.sparkContext.broadcast((model.n, np.array(model.sums), model.projection))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums, projection = shared.value
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                yield batch.assign(w=list(((n * x - sums) / n) @ projection))

    return run


def whitened(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each usable row and component.

    ``deviation`` is the exact sum of the squares of ``n * x - S``, as a decimal.
    """
    spark = rows.sparkSession
    vectors = usable(rows, id_column, column)
    kind = dict(vectors.dtypes)["id"]
    distinct = written(vectors.select("x").distinct(), "vectors")
    model = fit(distinct, components)
    if model is None:
        schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"id {kind}, {schema}")
    run = projector(model, spark)
    covariance = gramian(distinct.mapInPandas(run, "x array<long>, w array<double>"), "w") / model.n
    error = float(np.abs(covariance - np.eye(len(covariance))).max())
    zero = F.lit(0).cast("decimal(38,0)")
    square = F.transform("x", lambda c, i: (c * model.n - F.get(F.lit(model.sums), i)).cast("decimal(19,0)"))
    deviation = F.aggregate(square, zero, lambda total, y: (total + (y * y).cast("decimal(38,0)")).cast("decimal(38,0)"))
    rows = vectors.mapInPandas(run, f"id {kind}, x array<long>, w array<double>")
    return rows.select("id", deviation.alias("deviation"), F.posexplode("w").alias("i", "whitened")).select(
        "id",
        (F.col("i") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(model.explained), F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
