"""Registered queries against their DuckDB statements, and the bounds on accuracy where SQL has none."""

import pytest

from aeroledger.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted(found.fetchall(), key=repr)
    assert want and sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr) == want


def test_one_query_for_each_operator():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
