"""All registered queries of the library and the SQL that gives the same rows."""

from larkspur.plans import aggregates, controls, documents, events, rules, series, streams, text, verdicts

_PARTS = (series, events, aggregates, text, rules, documents, streams, verdicts, controls)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
