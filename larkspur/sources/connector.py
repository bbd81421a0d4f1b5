"""A connector for recorded answers of series endpoints, on the Python data source API.

``spark.read.format("recorded_series").option("path", ...)`` reads folders ``route=<route>/ident=<identifier>/month=<yyyy-mm>/``, whose
files hold what an endpoint answered. Each identifier and month is a partition of its own; dates and identifiers that a query asks for are
pushed down with ``.option("pushdown", "true")`` (in sessions with ``spark.sql.python.filterPushdown.enabled``), so other months and identifiers are not opened. ``recorded_lookup`` reads the
episodes of podcast lookups in the same way.

What can go wrong has its own error: ``UnknownIdentifier`` (no route takes it, or the endpoint says that it has no such series; never hidden by
a fallback, whose own failure would tell nothing), ``UpstreamFailure`` (the endpoint and its fallback both fail) and ``EmptyAnswer`` (an answer
without rows, where the route does not say that this is a normal state).
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition


class SourceError(RuntimeError):
    pass


class UnknownIdentifier(SourceError):
    pass


class UpstreamFailure(SourceError):
    pass


class EmptyAnswer(SourceError):
    pass


@dataclass(frozen=True)
class Route:
    """``pattern``: the identifiers that it takes; ``empty_ok``: whether no rows are a normal answer; ``fallback``: the route that is asked
    when this one cannot be reached."""

    parse: str
    unit: str
    pattern: str = "$^"
    empty_ok: bool = False
    fallback: str | None = None


#: The first route whose pattern fits takes an identifier; bare capitals fit two kinds of source, so a recorded header decides for them.
ROUTES = {
    "exchange": Route("months", "points", r"\d{4,6}(\.TWO?)?"),
    "quotes": Route("quotes", "points", r"\^.+|.*=.*|.+\.[A-Z]{1,3}"),
    "messages": Route("rows", "rows", r"MSG:.+", empty_ok=True),
    "holdings": Route("rows", "tonnes", r"FUND:.+"),
    "observations": Route("observations", "as published", r"[A-Z0-9]+", fallback="graph"),
    "graph": Route("graph", "as published"),
    "adjusted": Route("adjusted", "dollars"),
}
AMBIGUOUS = r"[A-Z0-9]+"


def route_of(ident: str, headers: dict[str, str] | None = None) -> str:
    """The route of an identifier. ``headers`` names the source of cached series; only what could be of several sources asks them."""
    if headers and re.fullmatch(AMBIGUOUS, ident) and headers.get(ident) in ROUTES:
        return headers[ident]
    for name, route in ROUTES.items():
        if re.fullmatch(route.pattern, ident):
            return name
    raise UnknownIdentifier(f"no route takes {ident!r}")


def _number(text: object) -> float | None:
    try:
        return float(str(text).replace(",", "").strip())
    except ValueError:
        return None


def _observations(text: str, ident: str) -> Iterator[tuple]:
    for o in json.loads(text).get("observations", []):
        yield o["date"], _number(o["value"])


def _graph(text: str, ident: str) -> Iterator[tuple]:
    for row in csv.DictReader(io.StringIO(text)):
        yield row.get("observation_date") or row.get("DATE"), _number(row.get(ident))


def _quotes(text: str, ident: str) -> Iterator[tuple]:
    result = json.loads(text)["chart"]["result"][0]
    for t, close in zip(result.get("timestamp", []), result["indicators"]["quote"][0].get("close", [])):
        yield datetime.fromtimestamp(t, timezone.utc).date().isoformat(), None if close is None else float(close)


def _adjusted(text: str, ident: str) -> Iterator[tuple]:
    for r in json.loads(text):
        yield r["date"][:10], _number(r.get("adjClose"))


def _rows(text: str, ident: str) -> Iterator[tuple]:
    for r in json.loads(text).get("rows", []):
        yield r.get("date"), _number(r.get("value"))


def _months(text: str, ident: str) -> Iterator[tuple]:
    """Columns by keyword; years count from 1911."""
    table = json.loads(text)
    fields = table.get("fields", [])
    at = [next((i for i, f in enumerate(fields) if word in f), None) for word in ("日期", "收盤")]
    if None in at:
        raise UpstreamFailure(f"{ident}: no columns for date and close in {fields}")
    for row in table.get("data", []):
        m = re.fullmatch(r"(\d{2,3})/(\d{1,2})/(\d{1,2})", row[at[0]].strip())
        yield f"{int(m[1]) + 1911}-{int(m[2]):02d}-{int(m[3]):02d}" if m else None, _number(row[at[1]])


PARSERS = {"observations": _observations, "graph": _graph, "quotes": _quotes, "adjusted": _adjusted, "rows": _rows, "months": _months}


def _listed(store: fs.FileSystem, path: str) -> list[fs.FileInfo]:
    return sorted(store.get_file_info(fs.FileSelector(path, allow_not_found=True)), key=lambda f: f.path)


def _answer(store: fs.FileSystem, folder: str) -> str | None:
    """The text of the files in a folder; None without files. A byte order mark is dropped."""
    files = [f.path for f in _listed(store, folder) if f.is_file and not re.search(r"/[._][^/]*$", f.path)]
    text = "".join(store.open_input_stream(f).read().decode("utf-8-sig") for f in files)
    return text if files else None


def _status(text: str) -> int:
    """The status that a recorded failure has, else 200."""
    m = re.fullmatch(r'\s*\{"status":\s*(\d+)\}\s*', text)
    return int(m[1]) if m else 200


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Month(InputPartition):
    route: str
    ident: str
    month: str | None


class RecordedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("a path of recorded answers is needed")
        self.path = options["path"].rstrip("/")
        self.headers = json.loads(options.get("headers", "{}"))
        self.idents = [x for x in options.get("idents", "").split(",") if x] or None
        self.since: date | None = None

    def partitions(self) -> list[Month]:
        store, root = _store(self.path)
        idents = self.idents
        if idents is None:
            idents = sorted({f.base_name.removeprefix("ident=") for r in _listed(store, root) if not r.is_file for f in _listed(store, r.path) if f.base_name.startswith("ident=")})
        out = []
        for ident in idents:
            name = route_of(ident, self.headers)
            names = [n for n in (name, ROUTES[name].fallback) if n]
            months = sorted({f.base_name.removeprefix("month=") for n in names for f in _listed(store, f"{root}/route={n}/ident={ident}") if f.base_name.startswith("month=")})
            if not months:
                raise UpstreamFailure(f"no answer is recorded for {ident!r}")
            out += [Month(name, ident, m) for m in months if self.since is None or m >= f"{self.since:%Y-%m}"]
        return out or [Month("", "", None)]

    def read(self, partition: Month) -> Iterator[tuple]:
        if partition.month is None:
            return
        store, root = _store(self.path)
        name, ident = partition.route, partition.ident
        text = _answer(store, f"{root}/route={name}/ident={ident}/month={partition.month}")
        status = 404 if text is None else _status(text)
        if status == 400:
            raise UnknownIdentifier(f"the endpoint {name} has no series {ident!r}")
        if status != 200 and ROUTES[name].fallback:
            tried, name = name, ROUTES[name].fallback
            text = _answer(store, f"{root}/route={name}/ident={ident}/month={partition.month}")
            if text is None or _status(text) != 200:
                raise UpstreamFailure(f"{ident}: {tried} answered {status}, and {name} failed too")
        elif status != 200:
            raise UpstreamFailure(f"{ident}: {name} answered {status}")
        route = ROUTES[name]
        rows = [(d, v) for d, v in PARSERS[route.parse](text, ident) if d and v is not None]
        if not rows and not route.empty_ok:
            raise EmptyAnswer(f"{ident}: {name} answered without rows for {partition.month}")
        for d, v in rows:
            yield ident, date.fromisoformat(d), v, route.unit, name


class PushingReader(RecordedReader):
    """Leaves out the partitions that filters do not ask for."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes bounds of dates and lists of identifiers to leave partitions out; Spark applies all of them again."""
        for f in filters:
            if isinstance(f, (GreaterThanOrEqual, GreaterThan)) and f.attribute == ("d",) and isinstance(f.value, date):
                self.since = max(filter(None, (self.since, f.value)))
            elif isinstance(f, EqualTo) and f.attribute == ("series_id",):
                self.idents = [x for x in self.idents or [f.value] if x == f.value]
            elif isinstance(f, In) and f.attribute == ("series_id",):
                self.idents = [x for x in self.idents or f.value if x in f.value]
            yield f


class RecordedSeries(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded_series"

    def schema(self) -> str:
        return "series_id string, d date, v double, unit string, route string"

    def reader(self, schema) -> RecordedReader:
        # Spark refuses a reader that takes filters in a session that does not push them
        return (PushingReader if self.options.get("pushdown", "false").lower() == "true" else RecordedReader)(self.options)


@dataclass
class Show(InputPartition):
    show: str


class LookupReader(DataSourceReader):
    """Episodes of ``show=<key>/`` folders. What is no episode or has no date is left out; an episode without sound stays, marked."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[Show]:
        store, root = _store(self.path)
        return [Show(f.base_name.removeprefix("show=")) for f in _listed(store, root) if f.base_name.startswith("show=")] or [Show("")]

    def read(self, partition: Show) -> Iterator[tuple]:
        store, root = _store(self.path)
        text = _answer(store, f"{root}/show={partition.show}") if partition.show else None
        if text is None or _status(text) != 200:
            return  # one show that fails does not keep the others from being found
        for x in json.loads(text).get("results", []):
            if x.get("wrapperType") != "podcastEpisode":
                continue
            try:
                released = datetime.strptime(x.get("releaseDate") or "", "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
            except ValueError:
                continue
            yield partition.show, str(x.get("trackId")), x.get("trackName") or "", released, x.get("trackTimeMillis"), bool(x.get("episodeUrl"))


class RecordedLookup(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded_lookup"

    def schema(self) -> str:
        return "show string, track_id string, title string, release_ts timestamp, duration_ms long, has_sound boolean"

    def reader(self, schema) -> LookupReader:
        return LookupReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordedSeries)
    spark.dataSource.register(RecordedLookup)


