"""The driver contract holds with and without the corpus operators."""

import importlib
import sys

from larkspur.plans import registry


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())


def test_the_entry_works_without_the_corpus_operators(monkeypatch):
    import __spark_entry__ as entry

    full = set(entry.queries())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(importlib.reload(entry).queries()) == full - {"pipeline"}
    monkeypatch.setitem(sys.modules, "larkspur.llm", None)
    alone = importlib.reload(entry)
    assert set(alone.queries()) == set(registry.QUERIES) and set(alone.oracle_sql()) == set(registry.ORACLES)
    monkeypatch.undo()
    importlib.reload(entry)


def test_the_library_does_not_import_the_corpus_operators():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "larkspur"
    for file in root.rglob("*.py"):
        if "llm" not in file.relative_to(root).parts:
            assert "larkspur.llm" not in file.read_text(), file
