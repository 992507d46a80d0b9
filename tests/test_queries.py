import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck, type_difference
from checks.queries import QUERIES
from plan import explained

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_contract(spark):
    assert set(entry.queries()) >= set(QUERIES)
    assert set(QUERIES) <= set(ORACLES)
    assert entry.entry(spark).columns == ["item_id", "doc_id", "rank", "score", "lang", "source"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, con, small, name):
    df = QUERIES[name](spark, small)
    assert type_difference(df, con, ORACLES[name]) == []
    plan = explained(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    actual = df.toPandas()
    assert difference(actual, con.execute(ORACLES[name]).df()) is None


def test_recall_of_contained_passages(spark, con, small):
    """A passage that a document contains whole should mostly be found in it."""
    contained = con.execute(
        "SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"
    ).fetchall()
    hits = {(r.item_id, r.doc_id) for r in QUERIES["retrieve_topk"](spark, small).collect()}
    if contained:
        found = sum((i, d) in hits for i, d in contained)
        assert found / len(contained) >= 0.5
