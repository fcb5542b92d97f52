import random
from collections import defaultdict
from hashlib import md5

import pytest

from corpusloom.operators import graph


def random_edges(seed, nodes=30, edges=90):
    draw = random.Random(seed)
    found = {}
    while len(found) < edges:
        a, b = sorted(draw.sample(range(nodes), 2))
        found[a, b] = draw.randint(1, 9) / 10
    return found


def propagate(edges, rounds):
    neighbours = defaultdict(list)
    for (a, b), w in edges.items():
        neighbours[a].append((b, w))
        neighbours[b].append((a, w))
    labels = {n: n for n in neighbours}
    for turn in range(rounds):
        before = dict(labels)
        for half in (0, 1):
            new = {}
            for node, links in neighbours.items():
                if int(md5(f"{node}#{turn}".encode()).hexdigest()[7], 16) % 2 != half:
                    continue
                votes = defaultdict(float)
                for other, w in links:
                    votes[labels[other]] += w
                new[node] = min(votes, key=lambda label: (-round(votes[label], 9), label != labels[node], label))
            labels.update(new)
        if labels == before:
            return labels, True
    return labels, False


def edge_table(spark, edges):
    return spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src int, dst int, weight double")


@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_communities_and_modularity(spark, rounds):
    edges = random_edges(rounds)
    df = edge_table(spark, edges)
    labels = graph.communities(df, rounds=rounds)
    got = {r.node: r.label for r in labels.collect()}
    assert (got, labels.first().converged) == propagate(edges, rounds)
    total = sum(edges.values())
    degree, inner = defaultdict(float), 0.0
    for (a, b), w in edges.items():
        degree[got[a]] += w
        degree[got[b]] += w
        inner += w * (got[a] == got[b])
    want = inner / total - sum((d / (2 * total)) ** 2 for d in degree.values())
    row = graph.modularity(df, labels).first()
    assert row.modularity == pytest.approx(want) and row.communities == len(set(got.values()))


def test_hub_with_a_third_of_all_edges(spark):
    edges = {(0, i): 1.0 for i in range(1, 400)}
    edges |= {(i, i + 1): 2.0 for i in range(1, 800)}
    got = graph.communities(edge_table(spark, edges), rounds=3).collect()
    assert {r.node: r.label for r in got} == propagate(edges, 3)[0]


@pytest.mark.parametrize("few", [0, 1])
def test_kept_votes_give_the_labels_of_fresh_ones(spark, monkeypatch, few):
    """Votes corrected from the first round on, with repeated links, links of a node with itself, null ends and short lists."""
    monkeypatch.setattr(graph, "FEW", few)
    monkeypatch.setattr(graph, "LIST", 3)
    monkeypatch.setattr(graph, "HALVES", 2)
    edges = random_edges(7, nodes=40, edges=110) | {(0, i): 0.2 for i in range(40, 90)}
    rows = [(a, b, w / 2) for (a, b), w in edges.items() for _ in "12"] + [(None, 3, 1.0), (4, None, 1.0)]
    got = graph.communities(spark.createDataFrame(rows, "src int, dst int, weight double")).collect()
    labels, settled = propagate(edges, graph.ROUNDS)
    assert {r.node: r.label for r in got if r.node is not None} == labels and {r.converged for r in got} == {settled}


def test_rounds_move_labels_only(spark):
    """Links lie by neighbour already, so a join with labels moves none of them."""
    df = graph.both_ways(edge_table(spark, random_edges(3)))
    lists = graph.by_neighbour(df.withColumn("salt", (df.node * 0).cast("int")), "weight")
    labels = df.select("node", df.node.alias("label")).distinct()
    joined = lists.join(graph.shown(labels, "label").hint("merge"), ["neighbour", "salt"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("Exchange hashpartitioning(neighbour") == 1
    assert sum(len(r.near) for r in lists.collect()) == df.count()
    lists.unpersist()


def test_linked_nodes_agree_and_lone_ones_stay(spark):
    nodes = spark.createDataFrame([(9,), (0,)], "node int")
    rows = graph.communities(edge_table(spark, {(0, 1): 1.0}), nodes).collect()
    labels = {r.node: r.label for r in rows}
    assert labels[0] == labels[1] and labels[9] == 9 and all(r.converged for r in rows)


def test_two_cliques_joined_by_an_edge(spark):
    edges = {(a + low, b + low): 1.0 for low in (0, 6) for a in range(6) for b in range(a + 1, 6)} | {(0, 6): 1.0}
    df = edge_table(spark, edges)
    labels = graph.communities(df)
    got = {r.node: r.label for r in labels.collect()}
    assert len({got[n] for n in range(6)}) == 1 == len({got[n] for n in range(6, 12)}) and got[0] != got[6]
    assert graph.modularity(df, labels).first().modularity > 0.4


def test_jaccard_edges(spark):
    sets = {0: "abc", 1: "bcd", 2: "xyz", 3: "z"}
    rows = [(c, t) for c, terms in sets.items() for t in terms]
    got = graph.jaccard_edges(spark.createDataFrame(rows, "cluster_id int, term string")).collect()
    assert {(r.src, r.dst): r.weight for r in got} == {(0, 1): 0.5, (2, 3): pytest.approx(1 / 3)}


def test_display_weights(spark):
    rows = [(0, "a", 4.0), (0, "b", 1.0), (1, "a", 0.5)]
    got = graph.display_weights(spark.createDataFrame(rows, "cluster_id int, term string, weight double"))
    assert sorted((r.cluster_id, r.scale) for r in got.collect()) == [(0, 0.25), (0, 1.0), (1, 1.0)]
