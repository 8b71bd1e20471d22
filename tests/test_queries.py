"""Every registered core query against its SQL, on the smallest tables."""

import pytest

from arcweave.plans.oracles import ORACLES
from arcweave.plans.queries import QUERIES
from check_oracles import TESTDATA, compare, oracle_connection

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, tables, name):
    assert compare(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) is None


def test_the_entry_survives_a_missing_library(monkeypatch):
    import importlib
    import sys

    for name in [n for n in sys.modules if n.startswith(("arcweave.llm", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tokenizers", None)
    monkeypatch.setitem(sys.modules, "tiktoken", None)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLES)
