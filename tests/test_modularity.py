"""Communities by modularity: known optima, nesting levels, never below label propagation."""

import pytest

from corpusloom.operators import graph
from corpusloom.operators.modularity import modular_communities
from test_graph import edge_table, random_edges


def ring(cliques, size):
    edges = {(c * size + a, c * size + b): 1.0 for c in range(cliques) for a in range(size) for b in range(a + 1, size)}
    return edges | {tuple(sorted((c * size, (c + 1) % cliques * size + 1))): 1.0 for c in range(cliques)}


def test_ring_of_cliques(spark):
    """The cliques are the best communities of a ring of few of them."""
    df = edge_table(spark, ring(8, 6))
    found = modular_communities(df)
    labels = {r.node: r.label for r in found.labels().collect()}
    assert len(set(labels.values())) == 8
    assert all(len({labels[c * 6 + a] for a in range(6)}) == 1 for c in range(8))
    levels = found.levels.orderBy("level").collect()
    assert levels[0].communities == 48 and levels[-1].communities == 8
    assert graph.modularity(df, found.labels()).first().modularity == pytest.approx(levels[-1].modularity)


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_rise_and_nest_and_beat_propagation(spark, seed):
    df = edge_table(spark, random_edges(seed, nodes=60, edges=150))
    found = modular_communities(df)
    values = [r.modularity for r in found.levels.orderBy("level").collect()]
    assert len(values) > 1 and values == sorted(values)
    path = {}
    for r in found.path.collect():
        path.setdefault(r.node, {})[r.level] = r.label
    for level in range(len(values) - 1):
        above = {}
        for own in path.values():
            assert above.setdefault(own[level], own[level + 1]) == own[level + 1]
    assert values[-1] >= graph.modularity(df, graph.communities(df)).first().modularity


def test_hub_lone_repeated_and_looped(spark):
    """A node with a third of all edges, nodes without edges, edges listed twice and edges of a node with itself."""
    rows = [(0, i, 1.0) for i in range(1, 120)] + [(i, i + 1, 3.0) for i in range(1, 240)] + [(5, 6, 1.0), (6, 5, 1.0), (7, 7, 2.0)]
    df = spark.createDataFrame(rows, "src int, dst int, weight double")
    found = modular_communities(df, spark.createDataFrame([(900,), (0,)], "node int"))
    labels = found.labels().collect()
    assert len(labels) == 242 and {r.label for r in labels if r.node == 900} == {900}
    assert graph.modularity(df, found.labels()).first().modularity == pytest.approx(found.levels.agg({"modularity": "max"}).first()[0])


def test_empty(spark):
    found = modular_communities(spark.createDataFrame([], "src int, dst int, weight double"))
    assert found.labels().collect() == [] and found.levels.count() == 1
