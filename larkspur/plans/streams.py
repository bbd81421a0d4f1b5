"""Queries of the streaming twins, run to completion over a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.plans.inputs import PANEL, panel, table
from larkspur.sources import connector
from larkspur.sources.scratch import scratch
from larkspur.streaming import ingest

QUERIES, ORACLES = {}, {}


def _finished(spark, d, build, mode, keys=()):
    events = table(spark, d, "events")
    stream = build(ingest.file_stream(spark, d, "events.parquet", events.schema).withColumn("ts", F.col("ts").cast("timestamp")))
    path = scratch(spark, "stream")
    ingest.run_once(stream, ingest.replacing(f"{path}/out"), f"{path}/state", mode)
    return ingest.result(spark, f"{path}/out", stream.schema, mode, keys)


def stream_discovery(spark, d):
    found = _finished(spark, d, lambda s: ingest.discover(s, ["user_id", "event_type"], "ts"), "append")
    return found.select("user_id", "event_type")


def stream_windows(spark, d):
    return _finished(spark, d, lambda s: ingest.windowed_counts(s, "ts", "event_type", "1 day", "2 days"), "complete")


def stream_breaker(spark, d):
    bad = lambda s: s.withColumn("bad", F.col("event_type") == "error")
    return _finished(spark, d, lambda s: ingest.breaker(bad(s), "user_id", ["ts", "event_id"], "bad"), "update", ["user_id"])


def connector_series(spark, d):
    """Order totals as recorded answers of an endpoint, a file for each series and month; of every fifth month the endpoint fails and its fallback
    answers. Read back through the connector from a date on."""
    panel_rows = panel(spark, d).select(F.concat(F.lit("S"), F.left("series_id", F.lit(1))).alias("ident"), F.date_format("d", "yyyy-MM").alias("month"), "d", "v")
    months = panel_rows.groupBy("ident", "month").agg(F.array_sort(F.collect_list(F.struct("d", "v"))).alias("rows"))
    failed = F.substring("month", 6, 2).cast("int") % 5 == 0
    values = F.transform("rows", lambda r: F.struct(r["d"].cast("string").alias("date"), F.format_string("%.2f", r["v"]).alias("value")))
    answer = F.when(failed, F.lit('{"status": 503}')).otherwise(F.to_json(F.struct(values.alias("observations"))))
    lines = F.transform("rows", lambda r: F.concat(r["d"].cast("string"), F.lit(","), F.format_string("%.2f", r["v"])))
    sheet = F.concat(F.lit("observation_date,"), "ident", F.lit("\n"), F.array_join(lines, "\n"))
    both = months.select("ident", "month", F.lit("observations").alias("route"), answer.alias("value")).unionByName(months.where(failed).select("ident", "month", F.lit("graph").alias("route"), sheet.alias("value")))
    path = scratch(spark, "answers")
    both.write.partitionBy("route", "ident", "month").text(path)
    connector.register(spark)
    return spark.read.format("recorded_series").load(path).where("d >= DATE '1995-06-15'")


QUERIES.update(connector_series=connector_series)
ORACLES.update(
    connector_series=f"WITH {PANEL} SELECT 'S' || left(series_id, 1) AS series_id, d, v, 'as published' AS unit, CASE WHEN month(d) % 5 = 0 THEN 'graph' ELSE 'observations' END AS route FROM panel WHERE d >= DATE '1995-06-15'"
)
QUERIES.update(stream_discovery=stream_discovery, stream_windows=stream_windows, stream_breaker=stream_breaker)
ORACLES.update(
    stream_discovery="SELECT DISTINCT user_id, event_type FROM events",
    stream_windows="SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    stream_breaker="""WITH s AS (SELECT user_id, event_id, ts, event_type = 'error' AS bad, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER w AS grp FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(CAST(bad AS INT)) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id) AS run FROM s)
SELECT user_id, count(*) FILTER (WHERE run >= 3 AND bad) AS skipped, arg_max(bad AND run >= 3, (ts, event_id)) AS open FROM r GROUP BY 1""",
)
