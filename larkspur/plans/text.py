"""Queries of scalar functions and text operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.functions import scalars as C
from larkspur.operators import joins as J
from larkspur.operators import text as X
from larkspur.plans.inputs import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("parse_number", "SELECT o_orderkey, TRY_CAST(replace(x, ',', '') AS DOUBLE) AS v FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '--' ELSE format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END AS x FROM orders)")
def _(spark, d):
    x = F.when(F.col("o_orderkey") % 5 == 0, "--").otherwise(F.format_number(F.floor("o_totalprice"), 0))
    return table(spark, d, "orders").select("o_orderkey", C.number(x).alias("v"))


@query("roc_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders")
def _(spark, d):
    day = F.col("o_orderdate")
    text = F.concat_ws("/", (F.year(day) - 1911).cast("string"), F.date_format(day, "MM"), F.when(F.col("o_orderkey") % 4 > 0, F.date_format(day, "dd")).otherwise("99"))
    return table(spark, d, "orders").select("o_orderkey", C.roc_date(text).alias("d"))


@query("visible_width", "SELECT doc_id, len(text) + len(regexp_replace(text, '[^\\x{2E81}-\\x{10FFFF}]', '', 'g')) AS w FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", C.visible_width(F.col("text")).alias("w"))


@query("visible_chars", f"SELECT doc_id, len(regexp_replace(regexp_replace(regexp_replace(text, '{C.HEADING}', '', 'g'), '{C.MARKS}', '', 'g'), '\\s', '', 'g')) AS n FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", C.visible_chars(F.col("text")).alias("n"))


@query("text_sha256", "SELECT doc_id, sha256(text) AS sha FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("slugify", "SELECT p_partkey, left(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-'), 60) AS slug FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", C.slug(F.col("p_name")).alias("slug"))


@query("tier_lookup", "SELECT doc_id, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'medium' ELSE 'long' END AS tier FROM documents")
def _(spark, d):
    tiers = [(500, "short"), (2000, "medium"), (None, "long")]
    return table(spark, d, "documents").select("doc_id", C.tier(F.col("n_chars"), tiers).alias("tier"))


@query("clip_progress", "SELECT event_id, greatest(0, least(100, (value - 20) / 2)) AS p FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", C.clip((F.col("value") - 20) / 2, 0.0, 100.0).alias("p"))


@query(
    "magnitude_format",
    """WITH x AS (SELECT o_orderkey, o_custkey, CASE o_custkey % 3 WHEN 0 THEN o_orderkey % 5000 WHEN 1 THEN (o_orderkey % 97 + 0.3) * 0.01 ELSE (o_orderkey % 97 + 0.3) * 25 END::DOUBLE AS x FROM orders),
f AS (SELECT o_custkey, CASE WHEN bool_and(x = floor(x)) THEN 0 WHEN max(abs(x)) < 2 THEN 2 ELSE 1 END AS digits FROM x GROUP BY 1)
SELECT o_orderkey, CASE digits WHEN 0 THEN format('{:,.0f}', x) WHEN 1 THEN format('{:,.1f}', x) ELSE format('{:,.2f}', x) END AS s FROM x JOIN f USING (o_custkey)""",
)
def _(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 3
    tail = k % 97 + F.lit(0.3)
    x = F.when(c == 0, (k % 5000).cast("double")).when(c == 1, tail * 0.01).otherwise(tail * 25)
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", x.alias("x"))
    digits = rows.groupBy("o_custkey").agg(C.series_digits(F.col("x")).alias("digits"))
    return rows.join(digits, "o_custkey").select("o_orderkey", C.with_digits(F.col("x"), F.col("digits")).alias("s"))


@query("clock_format", "SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS clock, s AS seconds FROM (SELECT o_orderkey, CAST(o_orderkey % 9000 AS INT) AS s FROM orders)")
def _(spark, d):
    clock = C.clock(F.col("o_orderkey") % 9000)
    return table(spark, d, "orders").select("o_orderkey", clock.alias("clock"), C.seconds(clock).alias("seconds"))


@query("redact_urls", "SELECT page_id, regexp_replace(url || '&api_key=abc' || page_id || '&x=1', '(api_?key|token|secret)=[^&\\s]+', '\\1=***', 'gi') AS url FROM pages")
def _(spark, d):
    url = F.concat("url", F.lit("&api_key=abc"), "page_id", F.lit("&x=1"))
    return table(spark, d, "pages").select("page_id", C.redacted(url).alias("url"))


@query(
    "private_counts",
    "SELECT doc_id, "
    + ", ".join(f"len(regexp_extract_all(text, '{p}')) AS {k}" for k, p in C.PRIVATE.items())
    + " FROM documents",
)
def _(spark, d):
    counts = [F.regexp_count("text", F.lit(p)).alias(k) for k, p in C.PRIVATE.items()]
    return table(spark, d, "documents").select("doc_id", *counts)


def _removed(text: str) -> str:
    for k, p in C.PRIVATE.items():
        text = f"regexp_replace({text}, '{p}', '<{k}>', 'g')"
    return text


@query("private_removed", f"SELECT doc_id, sha256({_removed('text')}) AS sha FROM documents")
def _(spark, d):
    text = F.col("text")
    for k, p in C.PRIVATE.items():
        text = F.regexp_replace(text, p, f"<{k}>")
    return table(spark, d, "documents").select("doc_id", F.sha2(text, 256).alias("sha"))


@query("first_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS d FROM orders")
def _(spark, d):
    day, k = F.col("o_orderdate"), F.col("o_orderkey")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit("on "), F.date_format(day, "yyyy-MM-dd"), F.lit(" and 1/1/1999")))
        .when(k % 4 == 1, F.date_format(day, "'as of' d MMM yyyy")).when(k % 4 == 2, F.date_format(day, "d/M/yyyy")).otherwise("n/a")
    )
    return table(spark, d, "orders").select("o_orderkey", C.first_date(text).alias("d"))


@query("timestamp_offset", "SELECT event_id, event_id % 3 > 0 AS ok FROM events")
def _(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.element_at(F.array(F.lit(""), F.lit("Z"), F.lit("+08:00")), (F.col("event_id") % 3 + 1).cast("int")))
    return table(spark, d, "events").select("event_id", C.has_offset(text).alias("ok"))


@query("article_urls", f"SELECT page_id, NOT regexp_matches(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '{C.LISTING}') AS article FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", C.is_article(F.col("url")).alias("article"))


@query("regex_filter", "SELECT page_id, regexp_extract(url, '/(\\d+)', 1) AS id FROM pages WHERE regexp_matches(url, 'utm_|page=')")
def _(spark, d):
    return table(spark, d, "pages").where(F.col("url").rlike("utm_|page=")).select("page_id", F.regexp_extract("url", r"/(\d+)", 1).alias("id"))


@query("due_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS due FROM orders")
def _(spark, d):
    iso, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey")
    return table(spark, d, "orders").select(
        "o_orderkey", C.due_date(F.when(k % 2 == 0, iso), F.concat(F.lit("task due "), iso)).alias("due")
    )


def _form_sql(text):
    folded = f"translate({text}, '{C.VARIANTS}', '{C.PLAIN.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace(regexp_replace(trim(regexp_replace({folded}, '\\s+', ' ', 'g')), '{C.BEFORE}', '\\1', 'g'), '{C.AFTER}', '\\1', 'g')"


@query(
    "match_form",
    f"SELECT doc_id, sha256({_form_sql('text')}) AS sha FROM documents",
)
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(C.match_form(F.col("text")), 256).alias("sha"))


_SPACE = r"[\t-\r\x1C-\x20\x{85}\p{Z}]"
_ENDS = r"\r\n|[\n-\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_WORDS = (
    r"list_filter(string_split(regexp_replace(lower(regexp_replace(regexp_replace(line, '^\[\d{1,2}[:.]\d{2}(?::\d{2})?\]', ' '), "
    rf"'(?:^|{_SPACE})Speaker{_SPACE}*\d+{_SPACE}*[:\]]{_SPACE}*', ' ', 'g')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' '), lambda w: w <> '')"
)
_BODY = "array_to_string(string_split(text, '---')[least(len(string_split(text, '---')), 3):], '---')"
_TOKENS = f"""y AS (SELECT doc_id, string_split_regex({_BODY}, '{_ENDS}') AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM y),
w AS (SELECT doc_id, line_no, {_WORDS} AS t FROM l),
b AS (SELECT *, coalesce(sum(len(t)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM w),
tokens AS (SELECT doc_id, before + unnest(range(len(t))) AS pos, unnest(t) AS token, line_no - 1 AS line_no FROM b)"""


@query("tokens_per_document", f"WITH {_TOKENS} SELECT doc_id, count(*) AS n, count(DISTINCT token) AS kinds, CAST(max(pos) AS BIGINT) AS last, sha256(string_agg(token, ' ' ORDER BY pos)) AS sha FROM tokens GROUP BY 1")
def _(spark, d):
    return X.token_counts(table(spark, d, "documents"), "doc_id", "text")


_BLOCKS = f"""{_TOKENS}, g AS (SELECT doc_id, pos, list(token) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM tokens),
f AS (SELECT doc_id, pos, min(pos) OVER (PARTITION BY doc_id, g) AS first FROM g WHERE len(g) = 8),
r AS (SELECT doc_id, pos, first, pos - first AS diagonal, pos - row_number() OVER (PARTITION BY doc_id, pos - first ORDER BY pos) AS run FROM f WHERE pos > first),
blocks AS (SELECT doc_id, min(first) AS first, min(pos) AS second, count(*) + 7 AS tokens FROM r GROUP BY doc_id, diagonal, run)"""


def blocks(spark, d):
    return X.block_repeats(table(spark, d, "documents"), "doc_id", "text", 8)


@query("block_repeats", f"WITH {_BLOCKS} SELECT * FROM blocks")
def _(spark, d):
    return blocks(spark, d)


_TWICE = "SELECT doc_id, concat(array_to_string(list_transform(range(250), lambda x: 'w' || x), ' '), chr(10), text, chr(10), text) AS text FROM documents"


@query("significant_repeats_150", f"WITH twice AS ({_TWICE}), {_BLOCKS.replace('FROM documents', 'FROM twice')} SELECT * FROM blocks WHERE tokens >= 150 AND first >= 200")
def _(spark, d):
    """The survey's thresholds, on texts that stand twice behind 250 other words."""
    before = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(249)), lambda x: F.concat(F.lit("w"), x.cast("string"))), " ")
    twice = table(spark, d, "documents").select("doc_id", F.concat(before, F.lit("\n"), "text", F.lit("\n"), "text").alias("text"))
    return X.block_repeats(twice, "doc_id", "text", 8).where("tokens >= 150 AND first >= 200")


@query(
    "duplicate_share",
    f"""WITH {_BLOCKS}, c AS (SELECT DISTINCT doc_id, unnest(range(CAST(second AS BIGINT), CAST(second AS BIGINT) + tokens)) AS pos FROM blocks), n AS (SELECT doc_id, count(*) AS total FROM tokens GROUP BY 1),
k AS (SELECT doc_id, count(*) AS covered FROM c GROUP BY 1)
SELECT doc_id, covered, round(covered / total, 6) AS share, CASE WHEN covered / total > 0.25 THEN 'severe' WHEN covered / total > 0.1 THEN 'notable' ELSE 'minor' END AS severity FROM k JOIN n USING (doc_id)""",
)
def _(spark, d):
    totals = table(spark, d, "documents").select("doc_id", F.size(X.token_array("text")).cast("long").alias("total"))
    return X.repeat_share(blocks(spark, d), totals, "doc_id")


def _loops(text):
    return f"""t AS (SELECT doc_id, list_filter(string_split_regex(lower({text}), '{_SPACE}+'), lambda w: w <> '') AS t FROM said),
x AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM t),
r AS (SELECT doc_id, token, pos - row_number() OVER (PARTITION BY doc_id, token ORDER BY pos) AS run FROM x),
n AS (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id, token, run)
SELECT doc_id, CAST(sum(CASE WHEN n >= 20 THEN 1 ELSE n END) AS BIGINT) AS words, CAST(sum(CASE WHEN n >= 20 THEN n - 1 ELSE 0 END) AS BIGINT) AS removed FROM n GROUP BY 1"""


@query("loop_collapse", f"WITH said AS (SELECT doc_id, text FROM documents), {_loops('text')}")
def _(spark, d):
    return X.collapse_loops(table(spark, d, "documents"), "doc_id", "text")


_TURNS_SQL = "SELECT conv_id AS doc_id, string_agg(printf('[%02d:%02d] %s: ', turn // 60, turn % 60, role) || text || repeat(' go' || CASE WHEN turn % 2 = 0 THEN ' ' ELSE chr(9) END || 'Go', CASE WHEN conv_id % 3 = 0 THEN 15 ELSE 4 END), chr(10) ORDER BY turn, role, text) AS text FROM conversations GROUP BY 1"


_TURN = rf"(?m)^{_SPACE}*\[\d{{1,3}}:\d{{2}}(?::\d{{2}})?\]{_SPACE}*(?:[^:\n]{{0,60}}?:{_SPACE}*)?"
_UNTURNED = f"regexp_replace(text, '{_TURN}', '', 'g')"


@query("spoken_words", f"WITH said AS ({_TURNS_SQL}), {_loops(_UNTURNED)}")
def _(spark, d):
    """Conversations as stamped turns, with a stuttered word behind each: words said, loops counted once."""
    turn = F.col("turn")
    go = F.repeat(F.concat(F.lit(" go"), F.when(turn % 2 == 0, " ").otherwise("\t"), F.lit("Go")), F.when(F.col("conv_id") % 3 == 0, 15).otherwise(4))
    line = F.concat(F.format_string("[%02d:%02d] %s: ", F.floor(turn / 60), turn % 60, F.col("role")), "text", go)
    said = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", line.alias("line")))).alias("l"))
    return X.spoken_words(said.select("doc_id", F.array_join("l.line", "\n").alias("text")), "doc_id", "text")


@query(
    "completeness_ratio",
    """WITH n AS (SELECT conv_id, turn, len(string_split_regex(trim(text), '\\s+')) AS words FROM conversations)
SELECT conv_id, turn, words, round(words / nullif(median(words) OVER (PARTITION BY conv_id), 0), 6) AS rate,
CASE WHEN words / nullif(median(words) OVER (PARTITION BY conv_id), 0) < 0.6 THEN 'thin' WHEN words / nullif(median(words) OVER (PARTITION BY conv_id), 0) > 1.6 THEN 'long' ELSE 'ok' END AS state FROM n""",
)
def _(spark, d):
    n = table(spark, d, "conversations").select("conv_id", "turn", F.size(F.split(F.trim("text"), r"\s+")).alias("words"))
    rate = F.col("words") / F.nullif(F.median("words").over(Window.partitionBy("conv_id")), F.lit(0.0))
    state = F.when(F.col("rate") < 0.6, "thin").when(F.col("rate") > 1.6, "long").otherwise("ok")
    return n.withColumn("rate", rate).withColumn("state", state).withColumn("rate", F.round("rate", 6))


@query(
    "speaker_runs",
    """WITH s AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> role THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM
(SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations))
SELECT conv_id, role AS speaker, min(turn) AS start, count(*) AS turns, CAST(sum(len(text)) AS BIGINT) AS size FROM s GROUP BY conv_id, run, role""",
)
def _(spark, d):
    return X.speaker_runs(table(spark, d, "conversations"), "conv_id", "turn", "role", F.length("text"))


@query(
    "speaker_labels",
    """SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE role IS NULL OR role = '') AS missing, round(count(*) FILTER (WHERE role IN ('user', 'assistant')) / count(*), 6) AS generic,
count(DISTINCT role) = 1 AS single FROM conversations GROUP BY 1""",
)
def _(spark, d):
    role = F.col("role")
    return table(spark, d, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.count_if(role.isNull() | (role == "")).alias("missing"),
        F.round(F.count_if(role.isin("user", "assistant")) / F.count("*"), 6).alias("generic"), (F.count_distinct("role") == 1).alias("single"),
    )


def _furniture(text, share):
    return f"""WITH p AS (SELECT source AS doc, doc_id AS page, list_filter(list_transform(string_split_regex({text}, '{_ENDS}'), lambda x: trim(regexp_replace(x, '{_SPACE}+', ' ', 'g'))), lambda x: x <> '') AS s FROM documents),
e AS (SELECT doc, page, unnest(list_distinct(list_concat(s[1:3], s[greatest(len(s) - 2, 1):]))) AS line FROM p), t AS (SELECT doc, count(DISTINCT page) AS total FROM p WHERE len(s) > 0 GROUP BY 1)
SELECT doc, line, count(DISTINCT page) AS pages FROM e JOIN t USING (doc) WHERE len(line) BETWEEN 4 AND 119 GROUP BY doc, line, total HAVING count(DISTINCT page) >= greatest(2, {share} * total)"""


@query(
    "page_furniture",
    _furniture("text", 0.04),
)
def _(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("doc"), F.col("doc_id").alias("page"), "text")
    return X.page_furniture(docs, "doc", "page", "text", 3, 0.04)


@query("page_headers", _furniture("CASE WHEN doc_id % 9 = 4 THEN chr(10) WHEN doc_id % 3 = 0 THEN text ELSE 'Bureau' || repeat(' ', CAST(1 + doc_id % 4 AS INT)) || source || chr(13) || chr(10) || text END", 0.6))
def _(spark, d):
    """Pages of which most bear a heading with uneven spaces, and some are blank; the share is the survey's."""
    n = F.col("doc_id")
    head = F.concat(F.lit("Bureau"), F.repeat(F.lit(" "), (1 + n % 4).cast("int")), "source", F.lit("\r\n"), "text")
    text = F.when(n % 9 == 4, "\n").when(n % 3 == 0, F.col("text")).otherwise(head)
    return X.page_furniture(table(spark, d, "documents").select(F.col("source").alias("doc"), n.alias("page"), text.alias("text")), "doc", "page", "text")


@query(
    "quote_grounding",
    f"""WITH t AS (SELECT doc_id, {_form_sql("text")} AS f FROM documents), q AS (SELECT item_id, {_form_sql("text")} AS f FROM benchmark)
SELECT item_id, count(doc_id) AS documents, count(doc_id) > 0 AS found FROM q LEFT JOIN t ON contains(t.f, q.f) GROUP BY 1""",
)
def _(spark, d):
    """Every item in the match form of every document: in how many it stands."""
    items = table(spark, d, "benchmark").select("item_id", C.match_form(F.col("text")).alias("quote"))
    docs = table(spark, d, "documents").select("doc_id", C.match_form(F.col("text")).alias("text"))
    hits = J.contained(docs, items, "doc_id", "item_id").groupBy("item_id").agg(F.count("doc_id").alias("documents"))
    n = F.coalesce("documents", F.lit(0))
    return items.select("item_id").join(hits, "item_id", "left").select("item_id", n.alias("documents"), (n > 0).alias("found"))


@query("quote_search", "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def _(spark, d):
    """All items in all documents, character by character: the pairs."""
    items = table(spark, d, "benchmark").select("item_id", F.col("text").alias("quote"))
    return J.contained(table(spark, d, "documents"), items, "doc_id", "item_id")


@query(
    "vocabulary_violations",
    "SELECT doc_id, lang FROM documents WHERE lang NOT IN ('en', 'fr', 'de')",
)
def _(spark, d):
    vocab = spark.createDataFrame([("en",), ("fr",), ("de",)], "lang string")
    return table(spark, d, "documents").select("doc_id", "lang").join(F.broadcast(vocab), "lang", "left_anti")


@query("band_predicate", "SELECT doc_id, n_chars BETWEEN 500 AND 2000 AS inside FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("n_chars").between(500, 2000).alias("inside"))


@query(
    "headline",
    f"""WITH h AS (SELECT doc_id, text, string_split(string_split(text, chr(10))[1], '——')[1] AS line FROM documents),
s AS (SELECT doc_id, trim(string_split_regex(regexp_replace(concat('**', line), '\\*\\*|__|`', '', 'g'), '[。；]')[1]) AS s FROM h)
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 'No. ' || doc_id WHEN len(s) <= 40 THEN s ELSE left(s, 40) || '…' END AS headline FROM s""",
)
def _(spark, d):
    """Documents under a numbered question, a claim with a lead-in or an empty heading."""
    top = F.when(F.col("doc_id") % 3 == 0, "1. Which of them?").when(F.col("doc_id") % 3 == 1, F.concat(F.lit("結論：No. "), F.col("doc_id"))).otherwise("")
    text = F.concat(F.lit("intro\n## "), top, F.lit("\n\n# more\n**"), "text")
    return table(spark, d, "documents").select("doc_id", C.headline(text).alias("headline"))


_QUOTA = """CASE event_id % 4 WHEN 0 THEN '{"error": {"message": "m", "details": [{"retryDelay": "' || event_id || '.7s"}, {"violations": [{"quotaId": "PerDayTokens"}, {"quotaMetric": "tokens"}]}]}}'
WHEN 1 THEN '{"error": {"message": "at most 5 per Day"}}' WHEN 2 THEN 'broken: retryDelay: ' || event_id || 's' ELSE NULL END"""


@query(
    "quota_errors",
    f"""WITH q AS (SELECT event_id, {_QUOTA} AS raw FROM events) SELECT event_id, CASE WHEN event_id % 4 IN (0, 2) THEN CAST(event_id + 2 AS INT) END AS delay,
CASE event_id % 4 WHEN 0 THEN 'tokens' WHEN 1 THEN 'at most 5 per Day' ELSE coalesce(raw, '') END AS metric, event_id % 4 IN (0, 1) AS per_day FROM q""",
)
def _(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", C.quota_error(F.expr(_QUOTA)).alias("q")).select("event_id", "q.*")


_STAMPED = """said AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM conversations),
tw AS (SELECT conv_id, i, 0 AS half, text FROM said UNION ALL SELECT conv_id, i, 1, text FROM said),
documents AS (SELECT conv_id AS doc_id, string_agg(CASE WHEN i % 3 = 2 THEN '' ELSE printf('[%02d:%02d] ', (i * 45 + half * 10) // 60, (i * 45 + half * 10) % 60) END || replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' '), chr(10) ORDER BY half, i) AS text FROM tw GROUP BY 1)"""


def _stamped(spark, d):
    """Conversations told twice, two of three turns stamped; the second telling starts again near zero."""
    c = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    flat = lambda x: F.translate(F.coalesce(x, F.lit("")), "\n\r", "  ")
    stamp = lambda i, half: F.when(i % 3 == 2, "").otherwise(F.format_string("[%02d:%02d] ", F.floor((i * 45 + half * 10) / 60), (i * 45 + half * 10) % 60))
    told = lambda half: F.transform("t", lambda x, i: F.concat(stamp(i, half), flat(x["text"])))
    return c.select("doc_id", F.array_join(F.concat(told(0), told(1)), "\n").alias("text"))


@query(
    "duplicate_map",
    f"""WITH {_STAMPED}, {_BLOCKS}, sl AS (SELECT doc_id, line_no - 1 AS line_no, len(t) AS n, CASE WHEN regexp_matches(line, '^\\[\\d{{1,2}}[:.]\\d{{2}}\\]') THEN CAST(regexp_extract(line, '^\\[(\\d+)[:.](\\d+)', 1) AS INT) * 60 + CAST(regexp_extract(line, '^\\[(\\d+)[:.](\\d+)', 2) AS INT) END AS own, b.before FROM b JOIN (SELECT doc_id, line_no AS k, line FROM l) j USING (doc_id) WHERE k = line_no),
st AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS stamp, 1 + sum(CASE WHEN pre - own > 60 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS seg
FROM (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pre FROM sl)),
tk AS (SELECT t.doc_id, CAST(t.pos AS BIGINT) AS pos, token, stamp, CAST(seg AS BIGINT) AS seg FROM tokens t JOIN st USING (doc_id, line_no)),
big AS (SELECT doc_id, CAST(first AS BIGINT) AS first, CAST(second AS BIGINT) AS second, tokens FROM blocks WHERE tokens >= 12)
SELECT g.doc_id, g.first, g.second, g.tokens, a.seg AS first_seg, a.stamp AS first_from, b1.stamp AS first_to, c.seg AS dup_seg, c.stamp AS dup_from, e.stamp AS dup_to,
(SELECT string_agg(token, ' ' ORDER BY pos) FROM tk x WHERE x.doc_id = g.doc_id AND x.pos BETWEEN g.first AND g.first + 13) AS snippet
FROM big g JOIN tk a ON a.doc_id = g.doc_id AND a.pos = g.first JOIN tk b1 ON b1.doc_id = g.doc_id AND b1.pos = g.first + g.tokens - 1 JOIN tk c ON c.doc_id = g.doc_id AND c.pos = g.second JOIN tk e ON e.doc_id = g.doc_id AND e.pos = g.second + g.tokens - 1""",
)
def _(spark, d):
    """Repeated blocks of stamped transcripts, from when to when in which segment both stand."""
    docs = _stamped(spark, d)
    return X.duplicate_map(docs, X.block_repeats(docs, "doc_id", "text", 8).where("tokens >= 12"), "doc_id", "text")


_WORDS_OF = {"de": " (?:der|die|und) ", "en": " (?:the|and|of) ", "es": " (?:el|los|que) ", "fr": " (?:le|la|des) "}


@query(
    "identified_by_hits",
    f"""WITH h AS (SELECT doc_id, n, name FROM (SELECT doc_id, unnest([{', '.join(f"{{'n': len(regexp_extract_all(text, '{p}')), 'name': '{k}'}}" for k, p in _WORDS_OF.items())}], recursive := true) FROM documents)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, name) AS k FROM h), t AS (SELECT doc_id, any_value(name) FILTER (WHERE k = 1) AS best, CAST(max(n) AS INT) AS hits, CAST(max(n) FILTER (WHERE k = 2) AS INT) AS second FROM r GROUP BY 1)
SELECT *, hits >= 3 AND hits >= 3 * second AS sure FROM t""",
)
def _(spark, d):
    """Which language's small words stand in a text at least three times, and three times as often as those of the next."""
    return X.identified(table(spark, d, "documents"), "doc_id", "text", _WORDS_OF)


_PARTS = """pt AS (SELECT conv_id, turn, coalesce(text, '') AS text, role, CAST(conv_id % 7 * 600 AS INT) AS offset_, CASE WHEN conv_id % 3 = 0 THEN CAST(conv_id % 7 * 600 + conv_id % 500 - 250 AS INT) ELSE CAST(conv_id % 90 AS INT) END AS start FROM conversations),
nt AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1 THEN true ELSE false END AS head, greatest(0, start) + 37 * turn AS at_ FROM pt)"""


@query(
    "offset_stamps",
    f"""WITH {_PARTS}, f AS (SELECT conv_id, any_value(offset_) AS o, any_value(at_) FILTER (WHERE head) AS f0 FROM nt GROUP BY 1), s AS (SELECT nt.*, at_ + CASE WHEN o > 0 AND abs(f0 - o) > 180 THEN o ELSE 0 END AS s FROM nt JOIN f USING (conv_id))
SELECT conv_id, sha256(string_agg('  [' || CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END || '] x', chr(10) ORDER BY turn, role, text)) AS sha FROM s GROUP BY 1""",
)
def _(spark, d):
    """Parts of recordings, some of which were stamped in times of the whole already."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    k = F.col("conv_id")
    start = F.greatest(F.lit(0), F.when(k % 3 == 0, k % 7 * 600 + k % 500 - 250).otherwise(k % 90))
    at = lambda x: (start + 37 * x["turn"]).cast("int")
    stamp = lambda x: F.format_string("  [%02d:%02d] x", F.floor(at(x) / 60), at(x) % 60)
    text = F.array_join(F.transform("t", stamp), "\n")
    return c.select("conv_id", F.sha2(C.offset_stamps(text, (k % 7 * 600).cast("int")), 256).alias("sha"))


_NAMES = ["Ann Lee", "Speaker 1", "Bo", "*Bo", "And so we went on there"]


@query(
    "label_checks",
    f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM conversations),
n AS (SELECT conv_id, i, i * (100 + conv_id % 900) AS at_, CASE WHEN conv_id % 6 = 5 AND i % 2 = 1 THEN NULL ELSE ([{', '.join(f"'{x}'" for x in _NAMES)}])[CASE WHEN conv_id % 4 = 0 THEN 0 WHEN i % 3 = 2 THEN 0 ELSE (conv_id + i) % 5 END + 1] END AS name FROM t),
s AS (SELECT * FROM n WHERE name IS NOT NULL), r AS (SELECT *, coalesce(name <> lag(name) OVER w, true) AS new FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
g AS (SELECT *, sum(new::INT) OVER (PARTITION BY conv_id ORDER BY i) AS k FROM r), h AS (SELECT conv_id, k, min(at_) AS a FROM g GROUP BY 1, 2), e AS (SELECT conv_id, max(at_) + 1 AS z FROM g GROUP BY 1),
l AS (SELECT conv_id, max(coalesce(b, z) - a) AS longest FROM (SELECT *, lead(a) OVER (PARTITION BY conv_id ORDER BY k) AS b FROM h) JOIN e USING (conv_id) GROUP BY 1),
c AS (SELECT conv_id, count(*) AS stamped, count(name) AS turns, count(DISTINCT name) AS speakers, count(DISTINCT name) FILTER (WHERE name IN ('*Bo', 'And so we went on there')) AS bad, count(*) FILTER (WHERE name = 'Speaker 1') AS gen, count(*) FILTER (WHERE name <> 'Speaker 1') AS re FROM n GROUP BY 1)
SELECT conv_id, CAST(turns AS INT) AS turns, CAST(speakers AS INT) AS speakers, turns < 0.8 * stamped AS unlabelled, CAST(bad AS INT) AS malformed, speakers = 1 AND conv_id % 3 = 2 AS merged, gen > 0 AND re > 0 AND gen >= 0.4 * turns AS mixed, CAST(longest AS INT) AS longest, longest >= 900 AND speakers > 1 AS alone FROM c JOIN l USING (conv_id)""",
)
def _(spark, d):
    """Conversations as stamped turns under names of persons, stand-ins, no name at all and speech in the place of one."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    k = F.col("conv_id")
    names = F.array(*map(F.lit, _NAMES))
    name = lambda i: F.get(names, F.when((k % 4 == 0) | (i % 3 == 2), 0).otherwise((k + i) % 5).cast("int"))
    at = lambda i: (i * (100 + k % 900)).cast("int")
    stamp = lambda i: F.format_string("[%d:%02d:%02d]", F.floor(at(i) / 3600), F.floor(at(i) / 60) % 60, at(i) % 60)
    line = lambda x, i: F.when((k % 6 == 5) & (i % 2 == 1), F.concat(stamp(i), F.lit(" and on"))).otherwise(F.concat(stamp(i), F.lit(" "), name(i), F.lit(": so")))
    docs = c.select("conv_id", F.array_join(F.transform("t", line), "\n").alias("text"), (k % 3).alias("hosts"))
    return X.label_checks(docs, "conv_id", "text", "hosts")
