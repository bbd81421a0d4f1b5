"""URL filters: pattern rules indexed by their rarest literal token.

Each rule is a regular expression over ``host + path`` together with the literal tokens that
every match must hold. A URL's own tokens fetch candidate rules from the index, and only those
candidates run their regular expression. Rules without any literal token are candidates of
every URL. A short list of rules is a map literal, and all of it is one projection over the scan. A longer list is a table
that the distinct URLs' tokens are joined with; Spark broadcasts it or not by its size. Either way a hot host or URL costs nothing extra.

Defined cases: a null URL or one without ``://`` has empty host and path and no rule; matching
rules are ranked by length, then name; rows repeat as often as they do in the input; no rows give no rows; URLs of any length are
judged as a whole; columns of ``pages`` that clash with the added ones are replaced, others pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Maps A-Z only; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: So many rules are a literal of the plan, more are a table.
LITERAL_RULES = 500


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs against host + path; ``tokens`` are literals (lower-case runs of a-z, 0-9) in every match."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    listed: bool

    @staticmethod
    def host_path(verdict: str, host: str, path: str = "/") -> Rule:
        """Fits ``host`` and its subdomains where the URL's path starts with ``path``; longer rules win."""
        last = re.search(r"[A-Za-z0-9]+$", path)
        text = host + (path[: last.start()] if last else path)
        return Rule(
            host + path,
            verdict,
            rf"^([^/]*\.)?{_quoted(host)}{_quoted(path)}",
            tuple(dict.fromkeys(re.findall(r"[a-z0-9]+", text.lower()))),
            len(host + path),
            True,
        )

    @staticmethod
    def word(verdict: str, *words: str) -> Rule:
        """Fits hosts and paths that hold ``words`` next to each other, whatever stands between them."""
        return Rule(
            " ".join(words),
            verdict,
            r"(?i)(^|[^a-z0-9])" + r"[^a-z0-9]+".join(map(_quoted, words)) + r"([^a-z0-9]|$)",
            tuple(w.lower() for w in words),
            0,
            False,
        )


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_ -])", r"\\\1", text)


#: The host and path rules of the registered query.
SITE_RULES = [
    Rule.host_path("allow", "com", "/"),
    Rule.host_path("block", "example.com", "/en/"),
    Rule.host_path("allow", "www.example.com", "/en/"),
    Rule.host_path("block", "net", "/es/"),
    Rule.host_path("block", "net", "/fr/"),
]
#: Patterns that decide where no host and path rule fits; what none of them fits is allowed.
SPAM_RULES = [
    Rule.word("block", "spam"),
    Rule.word("block", "cheap", "pills"),
    Rule.word("block", "casino"),
    Rule.word("block", "porn"),
    Rule.word("block", "xxx"),
    Rule.word("block", "free", "download"),
    Rule.word("block", "payday", "loan"),
    *(
        Rule.word("block", claim, goods)
        for claim in ("buy", "cheap", "discount", "hot", "instant", "online", "win")
        for goods in ("betting", "cialis", "escorts", "jackpot", "loans", "poker", "replica", "slots", "steroids", "viagra")
    ),
]


def host(url: Column) -> Column:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    return F.when(has, F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)).otherwise("")


def path(url: Column) -> Column:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    return F.when(has, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def tokens(target: Column) -> Column:
    runs = F.split(F.translate(target, UPPER, LOWER), "[^a-z0-9]+")
    return F.array_distinct(F.filter(runs, lambda t: t != ""))


def token_counts(urls: DataFrame, url: str, words: list[str]) -> dict[str, int]:
    """In how many URLs each of the rules' tokens stands, counted over all rows."""
    target = F.concat(host(F.col(url)), path(F.col(url)))
    if len(words) <= LITERAL_RULES:
        hits = urls.select(F.explode(F.array_intersect(tokens(target), F.array(*map(F.lit, words)))).alias("token"))
    else:
        wanted = urls.sparkSession.createDataFrame([(w,) for w in words], "token string")
        hits = urls.select(F.explode(tokens(target)).alias("token")).join(wanted, "token", "left_semi")
    found = {r["token"]: r["n"] for r in hits.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {w: found.get(w, 0) for w in words}


def rule_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules by their rarest token (ties: the longer, then the first in order), and the rules without one."""
    index: dict[str, list[Rule]] = {}
    always = []
    for rule in rules:
        if rule.tokens:
            key = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
            index.setdefault(key, []).append(rule)
        else:
            always.append(rule)
    return index, always


_KIND = "struct<rank:int,name:string,verdict:string,pattern:string,listed:boolean>"
_FIELDS = ("rank", "name", "verdict", "pattern", "listed")


def _literal(rules: list[Rule]) -> Column:
    return F.array(*(F.struct(*(F.lit(getattr(r, f)).alias(f) for f in _FIELDS)) for r in rules)).cast(f"array<{_KIND}>")


def _by_literal(pages: DataFrame, target: Column, index: dict[str, list[Rule]], always: list[Rule]) -> DataFrame:
    found = _literal(always)
    if index:
        entries = F.map_from_arrays(F.array(*map(F.lit, index)), F.array(*(_literal(r) for r in index.values())))
        keys = F.array_intersect(tokens(target), F.array(*map(F.lit, index)))
        found = F.concat(found, F.flatten(F.transform(keys, lambda t: F.element_at(entries, t))))
    return pages.withColumn("__fits", F.filter(found, lambda r: F.regexp_like(target, r["pattern"]))).withColumn("__n", F.size(found))


def _by_table(pages: DataFrame, target: Column, index: dict[str, list[Rule]], always: list[Rule]) -> DataFrame:
    # rules without a token are found by the empty one, which every URL has here
    listed = [(t, tuple(getattr(r, f) for f in _FIELDS)) for t, rules in (*index.items(), ("", always)) for r in rules]
    table = pages.sparkSession.createDataFrame(listed, f"token string, rule {_KIND}")
    urls = pages.select(target.alias("__target")).distinct()
    each = urls.select("__target", F.explode(F.array_append(tokens(F.col("__target")), F.lit(""))).alias("token"))
    tried = each.join(table, "token").withColumn("fit", F.regexp_like("__target", F.col("rule.pattern")))
    judged = tried.groupBy("__target").agg(F.collect_list(F.when(F.col("fit"), F.col("rule"))).alias("__fits"), F.count("*").cast("int").alias("__n"))
    none = _literal([])
    joined = pages.withColumn("__own", target).join(judged, F.col("__own") == F.col("__target"), "left")
    return joined.withColumns({"__fits": F.coalesce("__fits", none), "__n": F.coalesce("__n", F.lit(0))}).drop("__own", "__target")


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host, path, rule, verdict, pattern_rule, n_candidates``.

    ``rule`` names the longest host and path rule that fits; where there is none, it is null
    and the best other pattern (``pattern_rule``) or ``default`` gives the verdict. Columns
    of ``pages`` with these names are replaced.
    """
    words = sorted({t for r in rules for t in r.tokens})
    index, always = rule_index(rules, token_counts(pages, url, words) if words else {})
    target = F.concat(host(F.col(url)), path(F.col(url)))
    found = (_by_literal if len(rules) <= LITERAL_RULES else _by_table)(pages, target, index, always)
    judged = (
        found.withColumn("__host", host(F.col(url)))
        .withColumn("__path", path(F.col(url)))
        .withColumn("__fits", F.when(F.col("__host") == "", F.filter("__fits", lambda r: F.lit(False))).otherwise(F.col("__fits")))
        .withColumn("__n", F.when(F.col("__host") == "", 0).otherwise(F.col("__n")))
        .withColumn("__site", F.try_element_at(_sorted(True), F.lit(1)))
        .withColumn("__other", F.try_element_at(_sorted(False), F.lit(1)))
    )
    return judged.withColumns(
        {
            "host": F.col("__host"),
            "path": F.col("__path"),
            "rule": F.col("__site.name"),
            "pattern_rule": F.when(F.col("__site").isNull(), F.col("__other.name")),
            "verdict": F.coalesce(F.col("__site.verdict"), F.col("__other.verdict"), F.lit(default)),
            "n_candidates": F.col("__n"),
        }
    ).drop("__host", "__path", "__fits", "__n", "__site", "__other")


def _sorted(listed: bool) -> Column:
    return F.array_sort(
        F.transform(
            F.filter(F.col("__fits"), lambda r: r["listed"] == F.lit(listed)),
            lambda r: F.struct((-r["rank"]).alias("order"), r["name"].alias("name"), r["verdict"].alias("verdict")),
        )
    )
