"""The driver's contract holds with and without the corpus operators."""

import sys

import __spark_entry__ as entry
import pytest


@pytest.mark.parametrize("missing", ["pushbroom.llm", "xxhash"])
def test_queries_of_the_engine_need_no_corpus_operators(monkeypatch, missing):
    """``missing`` cannot be imported: the subpackage itself, or a library that it needs."""
    for name in [n for n in sys.modules if n.startswith("pushbroom.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    names = set(entry.queries())
    assert names and not any(n.startswith("op") or n == "pipeline" for n in names)
    assert set(entry.oracle_sql()) == names - {"fourier_destripe_tilted"}
