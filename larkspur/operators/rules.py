"""Declarative data-quality rules over flat frames.

A rule is a set of SQL conditions over one frame: the first that holds of ``skip, fail, warn`` gives the level of
a row, else it passes; null conditions do not hold. All rules of a frame are evaluated in one pass. What a
rule needs from other rows (counts, predecessors, matches) is a column of its frame, made from
nested documents by the aggregations and joins of ``larkspur.operators.frames``. Thresholds come from a configuration whose
missing keys are errors.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("PASS", "WARN", "FAIL", "SKIPPED")
#: What a run of rules exits with.
EXIT = {"PASS": 0, "CONTENT": 10, "IMMUTABLE": 11, "BAD_INPUT": 12, "MISSING": 13, "ENVIRONMENT": 14, "CONFLICT": 15}
#: More skipped rules than this count as a failure.
MOST_SKIPPED = 3


@dataclass(frozen=True)
class Rule:
    id: str
    frame: str
    blind_to: str
    fail: str = "false"
    warn: str = "false"
    skip: str = "false"

    @property
    def suite(self) -> str:
        return self.id.split(".")[0]


class Registry:
    """Rules by id; ids are unique and every rule says what it cannot see."""

    def __init__(self):
        self.rules: dict[str, Rule] = {}

    def add(self, rule: Rule) -> None:
        if rule.id in self.rules:
            raise ValueError(f"rule {rule.id} is there already")
        if not rule.blind_to:
            raise ValueError(f"rule {rule.id} does not say what it cannot see")
        self.rules[rule.id] = rule

    def of(self, frame: str) -> list[Rule]:
        return [r for r in self.rules.values() if r.frame == frame]


def filled(condition: str, config: dict) -> str:
    """The condition with its ``{names}`` replaced by configured values; a missing name is an error."""
    values = {}
    for _, name, _, _ in Formatter().parse(condition):
        if name:
            if name not in config:
                raise KeyError(f"no threshold {name!r} is configured")
            v = config[name]
            values[name] = ", ".join("'" + str(x).replace("'", "\\'") + "'" for x in v) if isinstance(v, (list, tuple)) else v
    return condition.format(**values)


def evaluate(frame: DataFrame, rules: list[Rule], config: dict, key: str = "key") -> DataFrame:
    """``key, check_id, level``: one row per frame row and rule, from one pass over the frame."""
    if not rules:
        raise ValueError("a frame without rules checks nothing")

    def level(r: Rule):
        on = lambda c: F.coalesce(F.expr(filled(c, config)), F.lit(False))
        return F.when(on(r.skip), "SKIPPED").when(on(r.fail), "FAIL").when(on(r.warn), "WARN").otherwise("PASS")

    each = F.array(*(F.struct(F.lit(r.id).alias("check_id"), level(r).alias("level")) for r in rules))
    return frame.select(key, F.inline(each))


def tally(results: DataFrame) -> DataFrame:
    """Per check the number of rows at each level and the worst level: ``check_id, n, n_fail, n_warn, n_skipped, worst``."""
    n = lambda level: F.count_if(F.col("level") == level)
    worst = F.when(n("FAIL") > 0, "FAIL").when(n("WARN") > 0, "WARN").when(n("SKIPPED") == F.count("*"), "SKIPPED").otherwise("PASS")
    return results.groupBy("check_id").agg(
        F.count("*").alias("n"), n("FAIL").alias("n_fail"), n("WARN").alias("n_warn"), n("SKIPPED").alias("n_skipped"), worst.alias("worst")
    )


def gate(tallied: DataFrame) -> DataFrame:
    """One row ``exit_code, n_fail, n_skipped``: content failure if any check fails or too many could not run."""
    s = tallied.agg(F.count_if(F.col("worst") == "FAIL").alias("n_fail"), F.count_if(F.col("worst") == "SKIPPED").alias("n_skipped"))
    bad = (F.col("n_fail") > 0) | (F.col("n_skipped") > MOST_SKIPPED)
    return s.select(F.when(bad, EXIT["CONTENT"]).otherwise(EXIT["PASS"]).alias("exit_code"), "n_fail", "n_skipped")
