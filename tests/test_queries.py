"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

from corpusloom.plans.oracle import ORACLE
from corpusloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


def test_communities_hold_most_weight(spark, folder):
    row = QUERIES["R5_modularity"](spark, folder).first()
    assert row.modularity > 0.1 and row.communities > 1
    assert all(r.converged for r in QUERIES["R4_document_communities"](spark, folder).select("converged").distinct().collect())


def test_no_fit_row_is_misplaced(spark, folder):
    row = QUERIES["M4_kmeans_fit"](spark, folder).first()
    assert row.misplaced == 0 and row.settled


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLE[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["cluster_id", "rank", "term", "weight"]
