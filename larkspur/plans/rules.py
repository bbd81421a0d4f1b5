"""Queries of the validation rules over stand-in documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import checks, rules
from larkspur.plans.inputs import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def frame(df, name: str):
    """``df`` brought to a frame's columns; those it lacks are null."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([], checks.FRAMES[name]).schema
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted))


def run(df, name: str, ids: list[str]):
    wanted = [r for r in checks.REGISTRY.of(name) if r.id in ids]
    return rules.evaluate(frame(df, name), wanted, checks.CONFIG)


def reports(spark, d):
    """Documents as extracted reports."""
    docs = table(spark, d, "documents")
    same = Window.partitionBy(F.sha2("text", 256))
    return docs.select(
        F.col("doc_id").cast("string").alias("key"),
        F.regexp_count("text", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")).alias("n_private"),
        F.count("*").over(same).alias("n_same_sha"),
        F.lit(1).alias("n_same_slug"),
        F.col("n_chars").alias("page_one_chars"),
        F.length("text").alias("summary_chars"),
        F.lit(500).alias("low_chars"),
        F.lit(5000).alias("high_chars"),
    )


@query(
    "rules_reports",
    r"""WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS key, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS pii,
count(*) OVER (PARTITION BY sha256(text)) AS same, n_chars, len(text) AS n FROM documents)
SELECT key, 'research.no_pii' AS check_id, CASE WHEN pii > 0 THEN 'FAIL' ELSE 'PASS' END AS level FROM r
UNION ALL SELECT key, 'research.no_duplicates', CASE WHEN same > 1 THEN 'FAIL' ELSE 'PASS' END FROM r
UNION ALL SELECT key, 'research.page_one_substantial', CASE WHEN n_chars < 200 THEN 'FAIL' ELSE 'PASS' END FROM r
UNION ALL SELECT key, 'research.summary_length', CASE WHEN n < 500 THEN 'FAIL' WHEN n > 5000 THEN 'WARN' ELSE 'PASS' END FROM r""",
)
def _(spark, d):
    return run(reports(spark, d), "reports", ["research.no_pii", "research.no_duplicates", "research.page_one_substantial", "research.summary_length"])


def fetched(spark, d):
    """Events as fetched episodes: value as completeness, type as status."""
    e = table(spark, d, "events")
    same = Window.partitionBy("user_id", "event_type", F.date_trunc("day", "ts"))
    return e.select(
        F.col("event_id").cast("string").alias("key"),
        (F.col("value") / 100).alias("completeness"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "click", "other").otherwise("OK").alias("status"),
        F.col("ts").cast("timestamp").alias("release_ts"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("start_ts"),
        F.lit("2024-01-28 00:00:00").cast("timestamp").alias("end_ts"),
        F.count("*").over(same).alias("n_same"),
    )


_FETCHED = """e AS (SELECT CAST(event_id AS VARCHAR) AS key, value / 100 AS c, event_type AS t, ts, count(*) OVER (PARTITION BY user_id, event_type, date_trunc('day', ts)) AS same FROM events),
r AS (SELECT key, 'podcast.completeness_band' AS check_id, CASE WHEN c < 0.55 THEN 'FAIL' WHEN c > 1.35 THEN 'WARN' ELSE 'PASS' END AS level FROM e
UNION ALL SELECT key, 'podcast.status_vocabulary', CASE WHEN t = 'click' THEN 'FAIL' ELSE 'PASS' END FROM e
UNION ALL SELECT key, 'podcast.no_failed_episodes', CASE WHEN t = 'error' THEN 'FAIL' ELSE 'PASS' END FROM e
UNION ALL SELECT key, 'podcast.release_in_window', CASE WHEN ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-28' THEN 'PASS' ELSE 'FAIL' END FROM e
UNION ALL SELECT key, 'podcast.no_duplicate_episodes', CASE WHEN same > 1 THEN 'FAIL' ELSE 'PASS' END FROM e)"""
_FETCHED_IDS = ["podcast.completeness_band", "podcast.status_vocabulary", "podcast.no_failed_episodes", "podcast.release_in_window", "podcast.no_duplicate_episodes"]


@query("rules_fetched", f"WITH {_FETCHED} SELECT * FROM r")
def _(spark, d):
    return run(fetched(spark, d), "fetched", _FETCHED_IDS)


@query(
    "rules_tally",
    f"""WITH {_FETCHED} SELECT check_id, count(*) AS n, count(*) FILTER (WHERE level = 'FAIL') AS n_fail, count(*) FILTER (WHERE level = 'WARN') AS n_warn, count(*) FILTER (WHERE level = 'SKIPPED') AS n_skipped,
CASE WHEN bool_or(level = 'FAIL') THEN 'FAIL' WHEN bool_or(level = 'WARN') THEN 'WARN' ELSE 'PASS' END AS worst FROM r GROUP BY 1""",
)
def _(spark, d):
    return rules.tally(run(fetched(spark, d), "fetched", _FETCHED_IDS))


@query(
    "rules_gate",
    f"""WITH {_FETCHED}, w AS (SELECT check_id, count(*) FILTER (WHERE level = 'FAIL') AS bad, count(*) FILTER (WHERE level <> 'SKIPPED') AS ran FROM r GROUP BY 1),
s AS (SELECT count(*) FILTER (WHERE bad > 0) AS n_fail, count(*) FILTER (WHERE ran = 0) AS n_skipped FROM w)
SELECT CASE WHEN n_fail > 0 OR n_skipped > 3 THEN 10 ELSE 0 END AS exit_code, n_fail, n_skipped FROM s""",
)
def _(spark, d):
    return rules.gate(rules.tally(run(fetched(spark, d), "fetched", _FETCHED_IDS)))


@query(
    "rules_groups",
    """WITH p AS (SELECT * FROM (VALUES ('view', 10), ('click', 2000), ('missing', 1)) t(label, floor)), n AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1),
b AS (SELECT coalesce(p.label, n.label) AS key, p.label IS NOT NULL AS in_plan, n.label IS NOT NULL AS in_doc, coalesce(n, 0) AS n, floor FROM p FULL JOIN n USING (label))
SELECT key, 'advisory.group_names' AS check_id, CASE WHEN NOT in_plan OR NOT in_doc THEN 'FAIL' ELSE 'PASS' END AS level FROM b
UNION ALL SELECT key, 'advisory.group_floors', CASE WHEN in_plan AND n < floor THEN 'FAIL' ELSE 'PASS' END FROM b""",
)
def _(spark, d):
    plan = spark.createDataFrame([("view", 10), ("click", 2000), ("missing", 1)], "label string, floor long").withColumn("in_plan", F.lit(True))
    n = table(spark, d, "events").groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("n_cards")).withColumn("in_doc", F.lit(True))
    both = plan.join(n, "label", "full_outer").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_plan", "in_doc")})
    return run(both.withColumn("key", F.col("label")), "groups", ["advisory.group_names", "advisory.group_floors"])


@query(
    "rules_ledger",
    """WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE o_orderstatus WHEN 'O' THEN 'watching' WHEN 'F' THEN 'hit' ELSE 'odd' END AS status, CAST(o_orderdate AS DATE) AS due FROM orders)
SELECT key, 'podcast.ledger_no_overdue' AS check_id, CASE WHEN status = 'watching' AND date_diff('day', due, DATE '2001-07-20') > 7 THEN 'FAIL' WHEN status = 'watching' AND due < DATE '2001-07-20' THEN 'WARN' ELSE 'PASS' END AS level FROM l
UNION ALL SELECT key, 'research.ledger_no_overdue', CASE WHEN status = 'odd' OR (status = 'watching' AND date_diff('day', due, DATE '2001-07-20') > 14) THEN 'FAIL' ELSE 'PASS' END FROM l""",
)
def _(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", "watching").when(F.col("o_orderstatus") == "F", "hit").otherwise("odd")
    ledger = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), status.alias("status"), F.to_date("o_orderdate").alias("due"),
        F.lit("2001-07-20").cast("date").alias("today"), F.lit(7).alias("grace_days"),
    )
    return run(ledger, "ledger", ["podcast.ledger_no_overdue", "research.ledger_no_overdue"])


@query(
    "rules_charts",
    """WITH m AS (SELECT o_orderpriority AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders GROUP BY 1, 2),
s AS (SELECT k AS key, count(*) AS n, date_diff('day', max(d), DATE '2001-10-15') AS age FROM m GROUP BY 1)
SELECT key, 'chart.series_freshness' AS check_id, CASE WHEN age // 30 >= 3 THEN 'FAIL' WHEN age // 30 >= 2 THEN 'WARN' ELSE 'PASS' END AS level FROM s
UNION ALL SELECT key, 'chart.series_wellformed', CASE WHEN n < 20 THEN 'FAIL' ELSE 'PASS' END FROM s""",
)
def _(spark, d):
    m = table(spark, d, "orders").select(F.col("o_orderpriority").alias("key"), F.date_trunc("month", "o_orderdate").cast("date").alias("d")).distinct()
    s = m.groupBy("key").agg(F.count("*").alias("n_dates"), F.count("*").alias("n_values"), F.datediff(F.lit("2001-10-15").cast("date"), F.max("d")).alias("age_days"))
    return run(s.withColumn("cadence", F.lit("monthly")), "chart_series", ["chart.series_freshness", "chart.series_wellformed"])
