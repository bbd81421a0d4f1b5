"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(text: Column) -> Column:
    """A number written with thousands commas; anything else is null."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def roc_date(text: Column) -> Column:
    """``115/08/21`` counts years from 1911; invalid dates are null."""
    part = F.split(text, "/")
    year = (F.try_element_at(part, F.lit(1)).try_cast("int") + 1911).cast("string")
    iso = F.concat_ws("-", year, F.try_element_at(part, F.lit(2)), F.try_element_at(part, F.lit(3)))
    return F.when(text.rlike(r"^\d{2,3}/\d{1,2}/\d{1,2}$"), F.try_to_timestamp(iso, F.lit("yyyy-M-d")).cast("date"))


def visible_width(text: Column) -> Column:
    """Length in which characters beyond U+2E80 count twice."""
    return F.length(text) + F.length(F.regexp_replace(text, "[^\\x{2E81}-\\x{10FFFF}]", ""))


#: Markdown marks that a count of visible characters leaves out; headings and dashes only where a line starts.
HEADING, MARKS = r"(?m)^#{1,6}\s*", r"(?m)\*\*|__|`|\*|^[-–—]\s*"
#: Typographic variants of one sign, and marks that take no space before or after them.
VARIANTS, PLAIN = "‘’“”–—−\u00a0", "''\"\"--- "
BEFORE, AFTER = r"\s+([.,;:!?%)\]}])", r"([(\[{])\s+"


def visible_chars(text: Column) -> Column:
    """Characters left without markdown marks and white space."""
    return F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, HEADING, ""), MARKS, ""), r"\s", ""))


def match_form(text: Column) -> Column:
    """Text for matching quotes: one form of each sign, single spaces, none before a closing or behind an opening mark."""
    single = F.trim(F.regexp_replace(F.translate(text, VARIANTS, PLAIN), r"\s+", " "))
    return F.regexp_replace(F.regexp_replace(single, BEFORE, "$1"), AFTER, "$1")


#: White space of any script, the time stamp of a line, the mark of a numbered speaker.
SPACE = r"[\t-\r\x1C-\x20\x{85}\p{Z}]"
STAMP = r"^\[(\d{1,2})[:.](\d{2})(?::(\d{2}))?\]"
SPEAKER = rf"(?:^|{SPACE})Speaker{SPACE}*\d+{SPACE}*[:\]]{SPACE}*"
#: A time stamp that starts a turn, with the name that may follow it.
TURN = rf"(?m)^{SPACE}*\[\d{{1,3}}:\d{{2}}(?::\d{{2}})?\]{SPACE}*(?:[^:\n]{{0,60}}?:{SPACE}*)?"


def words(line: Column) -> Column:
    """Lower-case words of one line, without the stamp at its start and the marks of numbered speakers. Signs part words, ``_`` does not."""
    unstamped = F.when(line.startswith("["), F.regexp_replace(line, STAMP, " ")).otherwise(line)
    plain = F.when(line.contains("Speaker"), F.regexp_replace(unstamped, SPEAKER, " ")).otherwise(unstamped)
    return F.filter(F.split(F.regexp_replace(F.lower(plain), r"[^\p{L}\p{N}_]+", " "), " "), lambda w: w != "")


def stamp_seconds(line: Column) -> Column:
    """Seconds of the stamp at the start of a line, ``h:mm:ss`` or ``mm:ss``; null without one."""
    part = lambda i: F.regexp_extract(line, STAMP, i).try_cast("int")
    return F.when(part(3).isNotNull(), part(1) * 3600 + part(2) * 60 + part(3)).otherwise(part(1) * 60 + part(2))


#: Fixed value: a stamp with up to three digits of minutes at the start of a line.
LONG_STAMP = r"^(\s*)\[(\d{1,3}):(\d{2})(?::(\d{2}))?\]"


def offset_stamps(text: Column, offset: Column, near: int = 180) -> Column:
    """The stamps of a part of a recording as times of the whole: ``offset`` seconds later, in ``mm:ss`` or ``h:mm:ss``.

    If the first stamp is within ``near`` seconds of the offset, the part was stamped in times of the whole already and nothing is added.
    """
    part = lambda line, i: F.regexp_extract(line, LONG_STAMP, i).try_cast("int")
    secs = lambda line: F.when(part(line, 4).isNotNull(), part(line, 2) * 3600 + part(line, 3) * 60 + part(line, 4)).otherwise(part(line, 2) * 60 + part(line, 3))
    every = F.split(text, "\n")
    first = F.get(F.filter(F.transform(every, secs), lambda s: s.isNotNull()), F.lit(0))
    shift = F.when((offset > 0) & ~F.coalesce(F.abs(first - offset) <= near, F.lit(False)), offset).otherwise(0)
    moved = lambda line: F.concat(F.regexp_extract(line, LONG_STAMP, 1), F.lit("["), clock(secs(line) + shift), F.lit("]"), F.regexp_replace(line, LONG_STAMP, ""))
    return F.array_join(F.transform(every, lambda line: F.when(line.rlike(LONG_STAMP), moved(line)).otherwise(line)), "\n")


def round_binary(value: Column, digits: int) -> Column:
    """``value`` rounded half to even by its exact binary value: 2.675 is a little less than it looks and gives 2.67.

    The part that the product with a power of ten loses is found by splitting both factors in halves; it decides where the product
    lands on a half. Numbers from 2**52 / 10**digits on have no digits to lose and stay.
    """
    power = float(10**digits)
    whole = F.lit(134217729.0)

    def halves(x: Column) -> tuple[Column, Column]:
        high = x * whole - (x * whole - x)
        return high, x - high

    (a, b), (c, e) = halves(value), halves(F.lit(power))
    p = value * power
    lost = ((a * c - p) + a * e + b * c) + b * e
    down = F.floor(p).cast("double")
    half = p - down - 0.5
    odd = down % 2 != 0
    up = (half > 0) | ((half == 0) & ((lost > 0) | ((lost == 0) & odd)))
    return F.when(F.abs(value) >= 2.0**52 / power, value).otherwise((down + up.cast("double")) / power)


def slug(text: Column) -> Column:
    """Lower-case ASCII words joined by hyphens, at most 60 characters."""
    return F.left(F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), F.lit("-")), F.lit(60))


def tier(value: Column, bounds: list[tuple[float | None, str]]) -> Column:
    """The name of the first tier whose upper bound exceeds the value (no bound: all)."""
    out = None
    for under, name in bounds:
        hit = F.lit(True) if under is None else value < under
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.when(value.isNotNull(), out)


def clip(value: Column, low: float, high: float) -> Column:
    """Null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def age_hours(then: Column, now: Column) -> Column:
    """Hours from ``then`` to ``now``, negative for what lies ahead."""
    return (F.unix_timestamp(now) - F.unix_timestamp(then)) / 3600


def fresh(then: Column, now: Column, hours: float = 36) -> Column:
    """Whether something was released in the last ``hours``; what lies ahead is not fresh."""
    return age_hours(then, now).between(0, hours)


def series_digits(value: Column) -> Column:
    """Aggregate: the digits behind the point that suit all values of a series: none for whole numbers, two if all are below 2, else one."""
    return F.when(F.coalesce(F.bool_and(value == F.floor(value)), F.lit(True)), 0).when(F.max(F.abs(value)) < 2, 2).otherwise(1)


def with_digits(value: Column, digits: Column) -> Column:
    """A number with thousands separators and 0, 1 or 2 digits."""
    return F.when(digits == 0, F.format_number(value, 0)).when(digits == 1, F.format_number(value, 1)).otherwise(F.format_number(value, 2))


def clock(seconds: Column) -> Column:
    """``h:mm:ss``, or ``mm:ss`` below an hour."""
    s = seconds.cast("int")
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))


def seconds(text: Column) -> Column:
    """Seconds of ``h:mm:ss`` or ``mm:ss``; null for anything else."""
    p = F.transform(F.split(text, ":"), lambda x: x.try_cast("int"))
    return F.when(
        text.rlike(r"^(\d{1,2}:)?\d{1,2}:\d{2}$"), F.aggregate(p, F.lit(0), lambda acc, x: acc * 60 + x)
    )


def redacted(text: Column) -> Column:
    """URLs without the values of their keys and tokens."""
    return F.regexp_replace(text, r"(?i)\b(api_?key|token|secret)=[^&\s]+", "$1=***")


#: Patterns of personal data and of marks that a source leaves in a document.
PRIVATE = {
    "email": r"[\w.+-]+@[\w.-]+\.\w{2,}",
    "reversed_email": r"[A-Z]{2}\.[A-Z]{3}\.[A-Z]+@\d+",
    "tracking_hash": r"\b[0-9a-f]{32}\b",
    "exclusive": r"(?i)exclusive use of|evisulcxe",
    "prepared_for": r"Prepared for\s+[A-Z]|deraperP",
    "phone": r"\+?\d[\d ()-]{7,}\d",
    "ipv4": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
}
#: Paths of home and listing pages.
LISTING = r"(?i)^/?$|/(markets|topics?|tag|tags|category|categories|section|sections|latest|news)/?$"


def first_date(text: Column) -> Column:
    """The first date found by the patterns in order: ISO, then day and month in letters, then day/month/year."""
    forms = [(r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"), (r"(\d{1,2} [A-Z][a-z]{2} \d{4})", "d MMM yyyy"), (r"(\d{1,2}/\d{1,2}/\d{4})", "d/M/yyyy")]
    return F.coalesce(
        *(F.try_to_timestamp(F.nullif(F.regexp_extract(text, p, 1), F.lit("")), F.lit(f)).cast("date") for p, f in forms)
    )


def has_offset(text: Column) -> Column:
    """A timestamp that parses and names its offset."""
    return F.try_to_timestamp(text).isNotNull() & text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")


def is_article(url: Column) -> Column:
    """Not the path of a home or listing page."""
    return ~F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1).rlike(LISTING)


def due_date(field: Column, text: Column) -> Column:
    return F.coalesce(field.try_cast("date"), F.nullif(F.regexp_extract(text, r"due (\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date"))


#: A numbering and a lead-in that a heading may start with, the ends of questions, and where a first sentence ends.
NUMBERED = r"^\s*(?:[一二三四五六七八九十]+[、.]|\d+[、.)])\s*"
LEAD = r"^(?:一句話(?:主張)?|主張|結論|重點|核心)\s*[：:]\s*"
ASKS, FIRST_SENTENCE = r"(?:什麼|嗎|呢|為何|\?|？)\s*$", r"[。；]|——"


def headline(text: Column) -> Column:
    """The first heading without its number and lead-in; of a question or an empty one, the first sentence below, 40 characters at
    most. Empty without any heading."""
    heading = F.regexp_replace(F.regexp_extract(text, r"(?m)^#[# ]*(.*)$", 1), NUMBERED, "")
    heading = F.trim(F.regexp_replace(F.trim(heading), LEAD, ""))
    below = F.regexp_extract(text, r"(?s)(?:\A|\n)#[^\n]*\n(.*)", 1)
    first = F.regexp_replace(F.trim(F.regexp_extract(below, r"(?m)^\s*([^#\s].*)$", 1)), r"\*\*|__|`", "")
    sentence = F.trim(F.split(first, FIRST_SENTENCE)[0])
    short = F.when(F.length(sentence) <= 40, sentence).otherwise(F.concat(F.left(sentence, F.lit(40)), F.lit("…")))
    wanted = (heading == "") | heading.rlike(ASKS)
    return F.coalesce(F.when(wanted & (first != ""), short).otherwise(heading), F.lit(""))


def quota_error(raw: Column) -> Column:
    """``delay`` (seconds to wait, two added), ``metric`` and ``per_day`` of an answer that refuses for a quota; what is no JSON is
    searched as text."""
    schema = "error struct<message string, details array<struct<retryDelay string, violations array<struct<quotaId string, quotaMetric string>>>>>"
    error = F.from_json(raw, schema)["error"]
    waits = F.filter(F.transform(error["details"], lambda x: F.regexp_extract(x["retryDelay"], r"^([0-9.]+)s", 1)), lambda x: x != "")
    found = F.regexp_extract(raw, r"retryDelay[\"':\s]+([0-9.]+)s", 1)
    delay = F.floor(F.coalesce(F.element_at(F.nullif(waits, F.array().cast("array<string>")), -1), F.nullif(found, F.lit(""))).try_cast("double")).cast("int") + 2
    every = F.flatten(F.transform(error["details"], lambda x: F.coalesce(x["violations"], F.array().cast("array<struct<quotaId:string,quotaMetric:string>>"))))
    named = F.filter(F.transform(every, lambda x: F.coalesce(F.nullif(x["quotaId"], F.lit("")), F.nullif(x["quotaMetric"], F.lit("")))), lambda x: x.isNotNull())
    metric = F.coalesce(F.when(F.size(named) > 0, F.element_at(named, -1)), F.left(F.when(error.isNotNull(), F.coalesce(error["message"], F.lit(""))).otherwise(F.coalesce(raw, F.lit(""))), F.lit(120)))
    blob = F.concat(metric, F.coalesce(raw, F.lit("")))
    per_day = F.contains(blob, F.lit("PerDay")) | F.contains(F.lower(blob), F.lit("per day"))
    return F.struct(delay.alias("delay"), metric.alias("metric"), per_day.alias("per_day"))
