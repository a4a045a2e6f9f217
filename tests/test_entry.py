"""The training-data part is optional: whatever it misses, the other queries stay."""

import builtins
import importlib.util
import os
import sys

import pytest

from conftest import ROOT
from plantlake.plans.catalog import QUERIES


def load():
    spec = importlib.util.spec_from_file_location("entry_again", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.mark.parametrize("missing", ["plantlake.llm", "corpus_pipeline", "tokenizers", "xxhash"])
def test_queries_without(monkeypatch, missing):
    real = builtins.__import__

    def refuse(name, *args, **kwargs):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args, **kwargs)

    for name in [n for n in sys.modules if n.startswith(("plantlake.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    if missing.startswith(("plantlake.llm", "corpus_pipeline")):
        monkeypatch.setitem(sys.modules, missing, None)
    monkeypatch.setattr(builtins, "__import__", refuse)
    module = load()
    assert set(QUERIES) <= set(module.queries())
    assert set(module.oracle_sql()) <= set(module.queries())
    if missing != "corpus_pipeline":
        assert "pipeline" not in module.queries()
