"""A folder for intermediate results that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only a local session may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="larkspur-"))
    return f"{base.rstrip('/')}/larkspur/{name}-{uuid.uuid4().hex}"
