"""Incremental ingestion as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_stream(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A stream of the files of one table in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def discover(stream: DataFrame, keys: list[str], time: str, horizon: str = "72 hours") -> DataFrame:
    """Rows whose keys were not seen within the horizon; state older than that is dropped."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, key: str, size: str, late: str) -> DataFrame:
    """Counts per key and tumbling window, late rows within the watermark included."""
    return (
        stream.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key)
        .agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
    )


def breaker(stream: DataFrame, key: str, order: list[str], bad: str, limit: int = 3) -> DataFrame:
    """Per key how many rows came while its breaker was open: ``limit`` bad rows in a row open it, a good one closes it.

    The run of bad rows is kept between micro-batches; rows of one batch are taken in order.
    """

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, skipped = state.get if state.exists else (0, 0)
        rows = pd.concat(list(parts)).sort_values(order)
        for is_bad in rows[bad]:
            run = run + 1 if is_bad else 0
            skipped += run >= limit
        state.update((run, int(skipped)))
        yield pd.DataFrame({key: [k[0]], "skipped": [int(skipped)], "open": [run >= limit]})

    return stream.groupBy(key).applyInPandasWithState(
        step, f"{key} long, skipped long, open boolean", "run long, skipped long", "update", GroupStateTimeout.NoTimeout
    )


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> None:
    """Processes what is there. Offsets advance only after the sink returned, so a failed round is repeated as a whole."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def replacing(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its own number: a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def result(spark: SparkSession, path: str, schema, mode: str, keys: list[str] = ()) -> DataFrame:
    """What the batches of ``replacing`` say together: all rows (``append``), the newest row of each key (``update``), or the
    newest batch, which holds everything (``complete``)."""
    batches = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, batch long").parquet(path)
    if mode == "complete":
        batches = batches.join(F.broadcast(batches.agg(F.max("batch").alias("batch"))), "batch", "left_semi")
    elif mode == "update":
        newest = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
        batches = batches.withColumn("nth", F.row_number().over(newest)).where("nth = 1").drop("nth")
    return batches.drop("batch")
