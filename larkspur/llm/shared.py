"""Where intermediate tables live, and small column helpers used by several operators."""

from __future__ import annotations

import functools
import itertools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``. Only a purely local session (as in
    tests) may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="larkspur-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/larkspur/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(*own: str) -> Callable:
    """For a function of ``docs`` that uses the column names ``own`` itself: columns of the user with these names are put under free names while it
    runs and back into the result. Expressions that are handed to the function must not name them."""

    def decorate(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(f)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            clashing = [c for c in docs.columns if c.lower() in own]
            if not clashing:
                return f(docs, *args, **kwargs)
            taken = {c.lower() for c in docs.columns}
            free = (n for n in (f"column_{i}" for i in itertools.count()) if n not in taken)
            away = dict(zip(clashing, free))
            return f(docs.withColumnsRenamed(away), *args, **kwargs).withColumnsRenamed({b: a for a, b in away.items()})

        return run

    return decorate


def place_in(bounds: Column, value: Column, strict: bool = False, bits: int = 11) -> Column:
    """How many of the ascending ``bounds`` (fewer than ``2**bits``) are at most ``value`` (``strict``: below it), by bisection."""

    def step(at: Column, width: Column) -> Column:
        bound = F.try_element_at(bounds, at + width)
        return F.when(bound < value if strict else bound <= value, at + width).otherwise(at)

    return F.aggregate(F.array(*(F.lit(1 << b) for b in reversed(range(bits)))), F.lit(0), step)


def joined_by_key(rows: DataFrame, lookup: DataFrame, key: str, n: str, least_share: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``lookup``, which has each ``key`` of them once and the number ``n`` of its rows.

    Keys with at least one in ``least_share`` of the rows are fewer than that number, so they are broadcast; their rows are not
    shuffled. All other rows meet their key by a shuffle. ``lookup`` should be a written table.
    """
    total = lookup.agg(F.sum(n).alias("n")).first()["n"] or 0
    frequent = F.col(n) * least_share >= F.lit(max(total, 1))
    found = rows.join(F.broadcast(lookup.where(frequent)), key)
    rest = rows.join(F.broadcast(lookup.where(frequent).select(key)), key, "left_anti")
    return found.unionByName(rest.join(lookup.where(~frequent), key))
