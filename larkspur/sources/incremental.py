"""A cache that asks only for days it has not asked for yet, in portions that are committed one by one.

A calendar minus the manifest gives the days to ask; they go out in portions of twenty. An answer is written first and then enters the
manifest, one entry a day: with a value, or without one, which says that the day was asked and has none. A day whose answer failed enters
nothing, so the next run asks it again. A manifest file is written under a hidden name and then renamed, so a run that stops anywhere leaves
committed portions or nothing of one; data files that no manifest names are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PORTION = 20
_MANIFEST = "name string, day date, portion string, has_value boolean"


class Progress(NamedTuple):
    tried: int
    with_value: int
    failed: int

    def suspicious(self, least: int = 60, share: float = 0.05) -> bool:
        """Many answers and hardly any value: the columns were probably not found."""
        return self.tried >= least and self.with_value < share * self.tried


class Cache:
    """Below ``path``: ``data/<portion>/`` holds ``name, day, v`` and ``manifest/<portion>.json`` the days that portion answered."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> DataFrame:
        """``name, day, portion, has_value`` of all committed answers; the first of a day counts."""
        folder = self._hadoop(f"{self.path}/manifest")
        # hidden files are those of portions in the making, which the reader leaves out
        if not self._fs.exists(folder) or not any(not f.getPath().getName().startswith(".") for f in self._fs.listStatus(folder)):
            return self.spark.createDataFrame([], _MANIFEST)
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest")
        return rows.groupBy("name", "day").agg(F.min_by("portion", F.struct(~F.col("has_value"), "portion")).alias("portion"), F.max("has_value").alias("has_value"))

    def missing(self, name: str, first: str, last: str, weekdays: bool = True) -> DataFrame:
        """``day``: the days of the calendar that were never answered."""
        days = self.spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
        days = days.where(F.weekday("day") < 5) if weekdays else days
        return days.join(self.manifest().where(F.col("name") == name).select("day"), "day", "left_anti")

    def plan(self, name: str, first: str, last: str, weekdays: bool = True, size: int = PORTION) -> Iterator[list]:
        """The missing days in order, in portions. A calendar has few days, so they are listed by the driver."""
        days = [r["day"] for r in self.missing(name, first, last, weekdays).orderBy("day").collect()]
        for at in range(0, len(days), size):
            yield days[at : at + size]

    def update(self, name: str, first: str, last: str, ask: Callable[[DataFrame], DataFrame], weekdays: bool = True, size: int = PORTION) -> Progress:
        """Asks for what is missing. ``ask`` gets the days of a portion and returns ``day, ok, v``: ``ok`` false is a failure, a null ``v`` no value."""
        tried = found = failed = 0
        for days in self.plan(name, first, last, weekdays, size):
            asked = self.spark.createDataFrame([(d,) for d in days], "day date")
            portion = uuid.uuid4().hex
            answers = ask(asked).select(F.lit(name).alias("name"), F.col("day").cast("date").alias("day"), F.col("ok").cast("boolean").alias("ok"), F.col("v").cast("double").alias("v"))
            answers.where("ok").select("name", "day", "v").write.parquet(f"{self.path}/data/{portion}")
            rows = self.spark.read.parquet(f"{self.path}/data/{portion}").select("day", F.col("v").isNotNull().alias("has_value")).distinct().collect()
            self._commit(name, portion, {r["day"]: r["has_value"] for r in rows})
            tried, found, failed = tried + len(days), found + sum(r["has_value"] for r in rows), failed + len(days) - len({r["day"] for r in rows})
        return Progress(tried, found, failed)

    def _commit(self, name: str, portion: str, days: dict) -> None:
        lines = "\n".join(json.dumps({"name": name, "day": str(d), "portion": portion, "has_value": bool(v)}) for d, v in sorted(days.items()))
        hidden, final = self._hadoop(f"{self.path}/manifest/.{portion}.json"), self._hadoop(f"{self.path}/manifest/{portion}.json")
        stream = self._fs.create(hidden)
        stream.write(bytearray(lines, "utf-8"))
        stream.close()
        if not self._fs.rename(hidden, final):
            raise OSError(f"portion {portion} could not be committed")

    def read(self, name: str) -> DataFrame:
        """``day, v`` of all answered days that have a value."""
        portions = [r["portion"] for r in self.manifest().where((F.col("name") == name) & F.col("has_value")).select("portion").distinct().collect()]
        if not portions:
            return self.spark.createDataFrame([], "day date, v double")
        rows = self.spark.read.parquet(*(f"{self.path}/data/{p}" for p in portions)).where((F.col("name") == name) & F.col("v").isNotNull())
        return rows.groupBy("day").agg(F.min("v").alias("v"))
