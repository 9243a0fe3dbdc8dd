import builtins
import importlib
import sys
from types import SimpleNamespace

import pytest

from tracemill.session import shared_dir


def reloaded(monkeypatch, lost):
    """__spark_entry__ where importing `lost` fails."""
    for name in [n for n in sys.modules if n == "__spark_entry__" or n.startswith("tracemill.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == lost:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", without)
    return importlib.import_module("__spark_entry__")


def test_other_queries_outlive_a_missing_library(monkeypatch):
    entry = reloaded(monkeypatch, "public_tokenizers")
    assert "redact_standard" in entry.queries() and not any(n.startswith("op") and n[2].isdigit() for n in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_shared_folder_must_be_named_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"), conf=conf)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(spark)
