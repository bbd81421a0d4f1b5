"""Queries of aggregations, keyed joins, set operations and upserts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import joins as J
from larkspur.operators import upserts as U
from larkspur.plans.inputs import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query(
    "basic_aggregates",
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high,
round(median(value), 6) AS mid, round(stddev_samp(value), 6) AS sd, round(stddev_pop(value), 6) AS psd FROM events GROUP BY 1""",
)
def _(spark, d):
    v = F.col("value")
    return table(spark, d, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum(v), 2).alias("total"), F.round(F.avg(v), 6).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.round(F.median(v), 6).alias("mid"), F.round(F.stddev_samp(v), 6).alias("sd"), F.round(F.stddev_pop(v), 6).alias("psd"),
    )


@query("lower_median", "SELECT user_id, list_sort(list(value))[count(*) // 2 + 1] AS mid FROM events GROUP BY 1")
def _(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(
        F.element_at(F.array_sort(F.collect_list("value")), (F.floor(F.count("*") / 2) + 1).cast("int")).alias("mid")
    )


@query(
    "percentiles_linear",
    "SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {q / 100}), 6) AS p{q}" for q in (10, 25, 50, 75, 90)) + " FROM events GROUP BY 1",
)
def _(spark, d):
    qs = (10, 25, 50, 75, 90)
    p = F.percentile("value", F.array(*(F.lit(q / 100) for q in qs)))
    got = table(spark, d, "events").groupBy("event_type").agg(p.alias("p"))
    return got.select("event_type", *(F.round(F.col("p")[i], 6).alias(f"p{q}") for i, q in enumerate(qs)))


@query("percentile_lower", "SELECT user_id, list_sort(list(value))[least(count(*) - 1, CAST(floor(count(*) * 0.9) AS BIGINT)) + 1] AS p90 FROM events GROUP BY 1")
def _(spark, d):
    n = F.count("*")
    at = F.least(n - 1, F.floor(n * F.lit(0.9))) + 1
    return table(spark, d, "events").groupBy("user_id").agg(
        F.element_at(F.array_sort(F.collect_list("value")), at.cast("int")).alias("p90")
    )


@query("histogram_by_value", "SELECT event_type, CAST(floor(value / 50) AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    return table(spark, d, "events").groupBy("event_type", F.floor(F.col("value") / 50).alias("bin")).agg(F.count("*").alias("n"))


@query(
    "rollup_reconcile",
    """WITH l AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS parts FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(parts, 2) AS parts, round(o_totalprice, 2) AS stated, abs(parts - o_totalprice) <= 0.5 AS ok FROM orders JOIN l ON o_orderkey = l_orderkey""",
)
def _(spark, d):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    parts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(price).alias("parts"))
    both = table(spark, d, "orders").join(parts, "o_orderkey")
    return both.select(
        "o_orderkey", F.round("parts", 2).alias("parts"), F.round("o_totalprice", 2).alias("stated"),
        (F.abs(F.col("parts") - F.col("o_totalprice")) <= 0.5).alias("ok"),
    )


@query(
    "conditional_rollup",
    """SELECT l_orderkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 2) AS returned, round(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END), 2) AS kept FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    q = lambda on: F.round(F.sum(F.when(on, F.col("l_quantity")).otherwise(0.0)), 2)
    back = F.col("l_returnflag") == "R"
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(q(back).alias("returned"), q(~back).alias("kept"))


@query(
    "distinct_in_order",
    """WITH f AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS types, count(*) AS n FROM f GROUP BY 1""",
)
def _(spark, d):
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))
    order = F.array_sort(F.collect_list(F.struct("first", "event_type")))
    return first.groupBy("user_id").agg(F.array_join(order["event_type"], ",").alias("types"), F.count("*").alias("n"))


@query("argmax_first", "SELECT user_id, arg_max(event_id, (value, -event_id)) AS top, arg_min(event_id, (value, event_id)) AS bottom FROM events GROUP BY 1")
def _(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(
        F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("top"),
        F.min_by("event_id", F.struct("value", "event_id")).alias("bottom"),
    )


@query(
    "weighted_cost",
    """SELECT user_id, round(sum(value * CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 5 WHEN 'signup' THEN 2 ELSE 0.1 END), 4) AS cost FROM events GROUP BY 1""",
)
def _(spark, d):
    t = F.col("event_type")
    w = F.when(t == "view", 1.0).when(t == "purchase", 5.0).when(t == "signup", 2.0).otherwise(0.1)
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.sum(F.col("value") * w), 4).alias("cost"))


@query(
    "tag_inverted_index",
    """WITH t AS (SELECT o_custkey, o_orderpriority AS tag FROM orders UNION ALL SELECT o_custkey, o_orderstatus FROM orders)
SELECT tag, count(DISTINCT o_custkey) AS n, min(o_custkey) AS first_key, row_number() OVER (ORDER BY count(DISTINCT o_custkey) DESC, tag) AS place FROM t GROUP BY tag""",
)
def _(spark, d):
    tags = table(spark, d, "orders").select("o_custkey", F.explode(F.array("o_orderpriority", "o_orderstatus")).alias("tag"))
    n = tags.groupBy("tag").agg(F.count_distinct("o_custkey").alias("n"), F.min("o_custkey").alias("first_key"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "tag")))


@query(
    "cadence_stats",
    """WITH n AS (SELECT max(ts) AS now FROM events) SELECT user_id, count(*) FILTER (WHERE date_diff('day', CAST(ts AS DATE), CAST(now AS DATE)) <= 7) AS last7,
round(count(*) / 30.0::DOUBLE * 7, 6) AS per_week, min(value) AS low, round(median(value), 6) AS mid, max(value) AS high, count(*) >= 80 AS capped FROM events, n GROUP BY 1""",
)
def _(spark, d):
    e = table(spark, d, "events")
    age = F.datediff(F.col("now").cast("date"), F.col("ts").cast("date"))
    return e.join(F.broadcast(e.agg(F.max("ts").alias("now")))).groupBy("user_id").agg(
        F.count_if(age <= 7).alias("last7"), F.round(F.count("*") / F.lit(30.0) * 7, 6).alias("per_week"), F.min("value").alias("low"),
        F.round(F.median("value"), 6).alias("mid"), F.max("value").alias("high"), (F.count("*") >= 80).alias("capped"),
    )


@query(
    "best_with_margin",
    """WITH h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM h)
SELECT user_id, max(CASE WHEN k = 1 THEN event_type END) AS best, max(CASE WHEN k = 1 THEN n END) AS hits,
max(CASE WHEN k = 1 THEN n END) >= 3 AND max(CASE WHEN k = 1 THEN n END) >= 1.2 * coalesce(max(CASE WHEN k = 2 THEN n END), 0) AS sure FROM r GROUP BY 1""",
)
def _(spark, d):
    h = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "event_type")))
    top = h.groupBy("user_id").agg(order.alias("o"))
    hits, second = -F.col("o")[0]["m"], -F.coalesce(F.try_element_at("o", F.lit(2))["m"], F.lit(0))
    return top.select(
        "user_id", F.col("o")[0]["event_type"].alias("best"), hits.alias("hits"), ((hits >= 3) & (hits >= F.lit(1.2) * second)).alias("sure")
    )


@query("top3_preview", "SELECT user_id, array_to_string(list(event_id ORDER BY value DESC, event_id)[1:3], ',') AS top FROM events GROUP BY 1")
def _(spark, d):
    order = F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "event_id")))
    return table(spark, d, "events").groupBy("user_id").agg(
        F.array_join(F.transform(F.slice(order, 1, 3), lambda x: x["event_id"].cast("string")), ",").alias("top")
    )


@query(
    "newest_before",
    """WITH days AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day, max(o_orderstatus) AS path FROM orders GROUP BY 1, 2)
SELECT p, day, array_to_string(list(strftime(day, '%m%d') || path) OVER (PARTITION BY p ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), ',') AS before FROM days""",
)
def _(spark, d):
    """For each day what the newest 14 days before it had, oldest first."""
    days = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_orderstatus").alias("path"))
    before = Window.partitionBy("p").orderBy("day").rowsBetween(-14, -1)
    listed = F.array_join(F.collect_list(F.concat(F.date_format("day", "MMdd"), "path")).over(before), ",")
    return days.select("p", "day", F.when(F.size(F.collect_list("path").over(before)) > 0, listed).alias("before"))


@query("multi_key_sort", "SELECT event_id, ts, value, row_number() OVER (ORDER BY CAST(ts AS DATE) DESC, value DESC, event_id) AS place FROM events ORDER BY place LIMIT 14")
def _(spark, d):
    e = table(spark, d, "events").orderBy(F.col("ts").cast("date").desc(), F.col("value").desc(), "event_id").limit(14)
    w = Window.orderBy(F.col("ts").cast("date").desc(), F.col("value").desc(), "event_id")
    return e.select("event_id", "ts", "value", F.row_number().over(w).alias("place"))


@query(
    "priority_order",
    """SELECT event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(list_position(['purchase', 'signup'], event_type), 9), ts, event_id) AS place FROM events""",
)
def _(spark, d):
    place = F.array_position(F.array(F.lit("purchase"), F.lit("signup")), F.col("event_type"))
    w = Window.partitionBy("user_id").orderBy(F.when(place > 0, place).otherwise(9), "ts", "event_id")
    return table(spark, d, "events").select("event_id", "event_type", F.row_number().over(w).alias("place"))


# keyed joins and sets


def _halves(spark, d):
    """Two versions of a customer table: the second drops, adds and changes keys."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    new = c.where("c_custkey % 7 <> 0").withColumn("nation", F.when(F.col("c_custkey") % 11 == 0, "x").otherwise(F.col("nation")))
    return c.where("c_custkey % 5 <> 0"), new


_HALVES = """c AS (SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer),
a AS (SELECT * FROM c WHERE c_custkey % 5 <> 0), b AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE nation END AS nation FROM c WHERE c_custkey % 7 <> 0)"""


@query("cross_version_dedup", f"WITH {_HALVES} SELECT c_custkey FROM b WHERE c_custkey IN (SELECT c_custkey FROM a) AND c_custkey % 13 <> 0")
def _(spark, d):
    a, b = _halves(spark, d)
    exempt = b.where("c_custkey % 13 = 0")
    return J.shared_keys(b, a, "c_custkey", exempt).select("c_custkey")


@query(
    "keyed_merge",
    f"WITH {_HALVES} SELECT c_custkey, coalesce(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment, coalesce(b.nation, a.nation) AS nation FROM a FULL JOIN b USING (c_custkey)",
)
def _(spark, d):
    return J.keyed_merge(*_halves(spark, d), "c_custkey", ["c_mktsegment"], ["c_mktsegment", "nation"])


@query(
    "drift_diff",
    f"""WITH {_HALVES} SELECT * FROM (SELECT c_custkey, CASE WHEN b.nation IS NULL THEN 'only_left' WHEN a.nation IS NULL THEN 'only_right' WHEN a.nation <> b.nation THEN 'differs' END AS state
FROM a FULL JOIN b USING (c_custkey)) WHERE state IS NOT NULL""",
)
def _(spark, d):
    return J.drift(*_halves(spark, d), "c_custkey", "nation")


@query(
    "rollup_dictionary",
    """SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'slow' END AS band, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
)
def _(spark, d):
    bands = spark.createDataFrame([("1-URGENT", "fast"), ("2-HIGH", "fast")], "o_orderpriority string, band string")
    both = table(spark, d, "orders").join(F.broadcast(bands), "o_orderpriority", "left")
    return both.groupBy(F.coalesce("band", F.lit("slow")).alias("band")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("union_first", f"WITH {_HALVES} SELECT * FROM a UNION ALL SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a)")
def _(spark, d):
    return U.union_first(list(_halves(spark, d)), "c_custkey")


@query("intersect_keys", f"WITH {_HALVES} SELECT c_custkey FROM a INTERSECT SELECT c_custkey FROM b")
def _(spark, d):
    a, b = _halves(spark, d)
    return a.select("c_custkey").intersect(b.select("c_custkey"))


@query("except_keys", f"WITH {_HALVES} SELECT c_custkey FROM a EXCEPT SELECT c_custkey FROM b")
def _(spark, d):
    a, b = _halves(spark, d)
    return a.select("c_custkey").exceptAll(b.select("c_custkey"))


@query("index_upsert", f"WITH {_HALVES} SELECT * FROM b UNION ALL SELECT * FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM b)")
def _(spark, d):
    return U.upsert(*_halves(spark, d), "c_custkey")


@query(
    "append_only_violations",
    f"""WITH {_HALVES} SELECT c_custkey, CASE WHEN b.nation IS NULL THEN 'gone' ELSE 'changed' END AS reason FROM a LEFT JOIN b USING (c_custkey)
WHERE b.nation IS NULL OR a.nation <> b.nation OR a.c_mktsegment <> b.c_mktsegment""",
)
def _(spark, d):
    return U.changed_keys(*_halves(spark, d), "c_custkey")


@query(
    "frozen_violations",
    f"""WITH {_HALVES} SELECT c_custkey, CASE WHEN b.nation IS NULL THEN 'gone' WHEN a.nation IS NULL THEN 'added' ELSE 'changed' END AS reason FROM a FULL JOIN b USING (c_custkey)
WHERE b.nation IS NULL OR a.nation IS NULL OR a.nation <> b.nation""",
)
def _(spark, d):
    return U.frozen(*_halves(spark, d), "c_custkey")


@query("ledger_preserve", f"WITH {_HALVES} SELECT b.c_custkey, b.c_mktsegment, coalesce(a.nation, 'open') AS nation FROM b LEFT JOIN a USING (c_custkey)")
def _(spark, d):
    return U.preserving(*_halves(spark, d), "c_custkey", {"nation": "open"})


@query(
    "first_write_wins",
    f"""WITH {_HALVES} SELECT c_custkey, coalesce(a.nation, b.nation) AS nation, CASE WHEN a.nation <> b.nation THEN b.nation ELSE '' END AS revised FROM a FULL JOIN b USING (c_custkey)""",
)
def _(spark, d):
    out = U.first_write_wins(*_halves(spark, d), "c_custkey", "nation")
    return out.select("c_custkey", "nation", F.array_join("revisions", ",").alias("revised"))


@query(
    "seen_prune",
    """SELECT user_id, max(ts) AS at FROM events WHERE event_type IN ('view', 'click') GROUP BY 1 HAVING max(ts) >= TIMESTAMP '2024-01-29 00:00:00'""",
)
def _(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("ts").alias("at"), "event_type")
    cut = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    return U.prune_seen(e.where("event_type = 'view'"), e.where("event_type = 'click'"), "user_id", "at", cut)


# runs over events


@query(
    "ledger_overdue",
    """SELECT o_orderkey, CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-07-20') > 14 THEN 'FAIL' ELSE 'WARN' END AS level
FROM orders WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) < DATE '2001-07-20'""",
)
def _(spark, d):
    due = F.to_date("o_orderdate")
    now = F.lit("2001-07-20").cast("date")
    late = table(spark, d, "orders").where((F.col("o_orderstatus") == "O") & (due < now))
    return late.select("o_orderkey", F.when(F.datediff(now, due) > 14, "FAIL").otherwise("WARN").alias("level"))


@query(
    "session_segments",
    """WITH s AS (SELECT *, CASE WHEN value < lag(value) OVER w - 300 THEN 1 ELSE 0 END AS cut FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, CAST(sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM s""",
)
def _(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    cut = F.coalesce(F.col("value") < F.lag("value").over(w) - 300, F.lit(False)).cast("int")
    marked = table(spark, d, "events").withColumn("cut", cut)
    return marked.select("event_id", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("segment"))


@query(
    "dark_time",
    """WITH g AS (SELECT user_id, date_diff('second', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM (SELECT DISTINCT user_id, ts FROM events))
SELECT user_id, CAST(coalesce(sum(gap - 7200) FILTER (WHERE gap > 7200), 0) AS BIGINT) AS dark FROM g GROUP BY 1""",
)
def _(spark, d):
    times = table(spark, d, "events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), "ts").distinct()
    gap = F.lead("at").over(Window.partitionBy("user_id").orderBy("ts")) - F.col("at")
    return times.withColumn("gap", gap).groupBy("user_id").agg(
        F.coalesce(F.sum(F.when(F.col("gap") > 7200, F.col("gap") - 7200)), F.lit(0)).alias("dark")
    )


@query(
    "circuit_breaker",
    """WITH s AS (SELECT user_id, event_id, ts, event_type = 'error' AS bad, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER w AS grp FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(CAST(bad AS INT)) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id) AS run FROM s)
SELECT user_id, count(*) FILTER (WHERE run >= 3 AND bad) AS skipped, min(ts) FILTER (WHERE run = 3 AND bad) AS opened FROM r GROUP BY 1""",
)
def _(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    bad = F.col("event_type") == "error"
    grouped = table(spark, d, "events").withColumn("bad", bad).withColumn("grp", F.sum((~bad).cast("int")).over(w))
    run = F.sum(F.col("bad").cast("int")).over(Window.partitionBy("user_id", "grp").orderBy("ts", "event_id"))
    tripped = grouped.withColumn("run", run)
    return tripped.groupBy("user_id").agg(
        F.count_if((F.col("run") >= 3) & F.col("bad")).alias("skipped"),
        F.min(F.when((F.col("run") == 3) & F.col("bad"), F.col("ts"))).alias("opened"),
    )


@query(
    "window_seams",
    """WITH b AS (SELECT CAST(ts AS DATE) AS day, min(ts) AS from_ts, max(ts) AS to_ts FROM events GROUP BY 1)
SELECT day, date_diff('second', lag(to_ts) OVER (ORDER BY day), from_ts) AS seam, coalesce(date_diff('second', lag(to_ts) OVER (ORDER BY day), from_ts) > 600, false) AS gap FROM b""",
)
def _(spark, d):
    days = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.unix_seconds(F.min("ts").cast("timestamp")).alias("a"), F.unix_seconds(F.max("ts").cast("timestamp")).alias("b")
    )
    seam = F.col("a") - F.lag("b").over(Window.orderBy("day"))
    return days.select("day", seam.alias("seam"), F.coalesce(seam > 600, F.lit(False)).alias("gap"))


@query(
    "heartbeat_loss",
    """WITH b AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) SELECT day, n, coalesce(n < lag(n) OVER (ORDER BY day), false) AS lost FROM b""",
)
def _(spark, d):
    days = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return days.withColumn("lost", F.coalesce(F.col("n") < F.lag("n").over(Window.orderBy("day")), F.lit(False)))


@query(
    "windowed_discovery_kinds",
    """WITH n AS (SELECT user_id, event_type, hour(ts) AS hour, ts >= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR AS late FROM events)
SELECT user_id, event_type, CAST(hour AS INT) AS hour FROM n GROUP BY 1, 2, 3 HAVING bool_and(late)""",
)
def _(spark, d):
    """What users did in the last 72 hours and never before at that hour of the day."""
    e = table(spark, d, "events")
    now = F.broadcast(e.agg(F.max("ts").alias("now")))
    aged = e.join(now).withColumn("hour", F.hour("ts")).withColumn("late", F.col("ts") >= F.col("now") - F.expr("INTERVAL 72 HOURS"))
    late, seen = (aged.where(c).select("user_id", "event_type", "hour") for c in ("late", "NOT late"))
    return late.distinct().join(seen, ["user_id", "event_type", "hour"], "left_anti")


@query("anti_missing_urgent", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(spark, d):
    """Customers without an urgent order."""
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(urgent, "c_custkey", "left_anti")


@query("isoweek_last_day", "SELECT isoyear(ts) AS y, week(ts) AS w, max(CAST(ts AS DATE)) AS last_day FROM events GROUP BY 1, 2")
def _(spark, d):
    day = F.to_date("ts")
    return table(spark, d, "events").groupBy(F.extract(F.lit("yearofweek"), day).cast("long").alias("y"), F.weekofyear(day).alias("w")).agg(
        F.max(day).alias("last_day")
    )


@query("weekend_mode", "SELECT event_id, CASE WHEN isodow(ts + INTERVAL 8 HOUR) >= 6 THEN 'weekend' ELSE 'weekday' END AS mode FROM events")
def _(spark, d):
    local = F.col("ts") + F.expr("INTERVAL 8 HOURS")
    return table(spark, d, "events").select(
        "event_id", F.when(F.dayofweek(local).isin(1, 7), "weekend").otherwise("weekday").alias("mode")
    )


@query("json_props", "SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(k).alias("k"), F.count("*").alias("n"))
