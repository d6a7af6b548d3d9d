"""The entry file without the optional training-data modules."""

from __future__ import annotations

import sys

import pytest

import __spark_entry__ as entry_points
from flowlab.plans import catalog


@pytest.mark.parametrize("absent", ["public_tokenizers", "corpus_pipeline", "flowlab.llm.queries"])
def test_other_queries_work_without_optional_modules(monkeypatch, absent):
    for name in [n for n in sys.modules if n.startswith("flowlab.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, absent, None)
    assert entry_points.training_data() is None
    assert set(entry_points.queries()) == set(catalog.QUERIES)
    assert set(entry_points.oracle_sql()) <= set(catalog.QUERIES)
