import importlib
import re
import sys

import __spark_entry__ as entry


def test_oracles_belong_to_queries():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 50
    assert all(callable(f) for f in queries.values())


def test_nothing_needs_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("tallyframe.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tallyframe.llm", None)
    fresh = importlib.reload(entry)
    names = set(fresh.queries())
    assert {"p4_found", "p6_found", "p7_found", "trades"} <= names
    assert not [n for n in names if re.match(r"p(1|2|3|5|8|9|10)_", n)] and set(fresh.oracle_sql()) <= names
    monkeypatch.undo()
    importlib.reload(entry)


def test_flagship(spark, small):
    df = entry.entry(spark)
    assert {"doc_id", "item", "ticker", "least"} <= set(df.columns) and df.count() >= 0


def test_core_queries_run_on_the_smallest_tables(spark, small):
    queries = entry.queries()
    for name in ("p4_found", "p6_found", "p7_found", "holdings", "identity_warnings", "page_transactions", "donors", "scorecard"):
        assert queries[name](spark, small).count() >= 0, name
