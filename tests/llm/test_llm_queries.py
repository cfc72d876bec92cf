"""Queries of the training-data operators against their DuckDB SQL."""

import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from oracle_util import compare, duck
from tillstream.llm.queries import ORACLE, QUERIES


def test_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    sf = SF01 if name in ("op1_url_filters", "op6_source_mixing") else SF001
    r = compare(spark, name, sf, QUERIES, ORACLE, duck(sf))
    assert r["ok"], r
