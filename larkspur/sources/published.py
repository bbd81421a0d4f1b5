"""Published documents in versions, and identifiers that may only grow.

A system is registered once, with the rule of its documents: ``frozen`` (a published day never changes) or ``append_only`` (items of a day may
be added, those that were published stay as they are). Publishing joins the new items with the version in place, refuses what the rule
forbids, writes the whole next version beside it, and then swaps a small pointer file by a rename. Readers follow the pointer, so they see the
old version or the new one; a refused or interrupted publication leaves the old one in place.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "day date, item string, content string"
RULES = ("frozen", "append_only")


class Refused(ValueError):
    """What was about to change although it was published; ``gone`` and ``changed`` list some of it."""

    def __init__(self, what: str, gone: list, changed: list):
        super().__init__(f"{what}: gone {gone}, changed {changed}")
        self.gone, self.changed = gone, changed


@dataclass(frozen=True)
class System:
    id: str
    suite: str
    rule: str

    def __post_init__(self):
        if not self.suite:
            raise ValueError(f"system {self.id} names no suite of checks")
        if self.rule not in RULES:
            raise ValueError(f"system {self.id} has no rule {self.rule!r}")


class Store:
    """Versions below ``path``: ``pointer.json`` names the folder of the current one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self) -> dict:
        at = self._hadoop(f"{self.path}/pointer.json")
        if not self._fs.exists(at):
            return {"systems": {}, "ids": {}}
        return json.loads(self.spark.read.text(f"{self.path}/pointer.json", wholetext=True).first()["value"])

    def _swap(self, pointer: dict) -> None:
        """A rename over an old file is one step only where the file system has it; else the old pointer stays until the new one is whole."""
        hidden, final = self._hadoop(f"{self.path}/.pointer-{uuid.uuid4().hex}.json"), self._hadoop(f"{self.path}/pointer.json")
        stream = self._fs.create(hidden)
        stream.write(bytearray(json.dumps(pointer, sort_keys=True), "utf-8"))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(hidden, final, options)

    def register(self, system: System) -> None:
        pointer = self._pointer()
        if system.id in pointer["systems"]:
            raise ValueError(f"system {system.id} is registered already")
        pointer["systems"][system.id] = {"suite": system.suite, "rule": system.rule, "version": None, "number": 0}
        self._swap(pointer)

    def systems(self) -> dict[str, System]:
        return {k: System(k, v["suite"], v["rule"]) for k, v in self._pointer()["systems"].items()}

    def current(self, system: str) -> DataFrame:
        """``day, item, content`` as published."""
        version = self._pointer()["systems"][system]["version"]
        return self.spark.read.schema(COLUMNS).parquet(f"{self.path}/{version}") if version else self.spark.createDataFrame([], COLUMNS)

    def publish(self, system: str, items: DataFrame) -> int:
        """Publishes the whole days in ``items`` (``day, item, content``) and returns the number of the version."""
        pointer = self._pointer()
        entry = pointer["systems"][system]
        new = items.select(F.col("day").cast("date").alias("day"), "item", "content")
        old = self.current(system)
        days = new.select("day").distinct()
        touched = old.join(days, "day", "left_semi").withColumnRenamed("content", "was")
        both = touched.join(new.withColumn("kept", F.lit(True)), ["day", "item"], "full_outer")
        lost = F.when(F.col("kept").isNull(), "gone").when(F.col("was").isNotNull() & (F.col("was") != F.col("content")), "changed")
        added = F.col("was").isNull() & F.col("kept")
        if entry["rule"] == "frozen":
            # a day that is there may not even grow
            there = touched.select("day").distinct().withColumn("old_day", F.lit(True))
            both = both.join(there, "day", "left")
            lost = F.coalesce(lost, F.when(added & F.coalesce("old_day", F.lit(False)), "changed"))
        bad = both.withColumn("why", lost).where("why IS NOT NULL")
        some = bad.groupBy("why").agg(F.slice(F.array_sort(F.collect_set(F.concat_ws(" ", "day", "item"))), 1, 5).alias("names")).collect() if not bad.isEmpty() else []
        if some:
            names = {r["why"]: r["names"] for r in some}
            raise Refused(f"{system} is {entry['rule']}", names.get("gone", []), names.get("changed", []))
        version = f"versions/{system}-{entry['number'] + 1}-{uuid.uuid4().hex}"
        old.join(days, "day", "left_anti").unionByName(new.dropDuplicates(["day", "item"])).write.parquet(f"{self.path}/{version}")
        pointer = self._pointer()
        if pointer["systems"][system]["number"] != entry["number"]:
            raise RuntimeError(f"{system} was published by someone else meanwhile")
        pointer["systems"][system] |= {"version": version, "number": entry["number"] + 1}
        self._swap(pointer)
        return entry["number"] + 1

    def lock(self, name: str, ids: set[str]) -> tuple[list[str], list[str]]:
        """``(gone, new)`` against the identifiers locked before; nothing changes if any is gone, else the new ones are locked too."""
        pointer = self._pointer()
        known = set(pointer["ids"].get(name, []))
        gone, new = sorted(known - ids), sorted(ids - known)
        if not gone and new:
            pointer["ids"][name] = sorted(ids)
            self._swap(pointer)
        return gone, new
