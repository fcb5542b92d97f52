"""Edges between two sets of nodes: the labels of the general way, no growing broadcast, no table left behind."""

import os
import random

import pytest

from corpusloom.operators import graph
from corpusloom.operators.modularity import modular_communities
from corpusloom.session import Shelf, shared_folder
from test_graph import edge_table, propagate, random_edges


def documents_and_terms(seed, documents=40, terms=12, each=5):
    draw = random.Random(seed)
    edges = {(d, -1 - t): draw.randint(1, 9) / 10 for d in range(documents) for t in draw.sample(range(terms), each)}
    return edges | {(d, -1): 0.2 for d in range(documents)}


def folders(spark):
    return set(os.listdir(shared_folder(spark).removeprefix("file://")))


def kinds(spark, before):
    return sorted(name.rpartition("-")[0] for name in folders(spark) - before)


def joins(df):
    """Join and exchange nodes of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    return [line.strip("+-: *()0123456789").split(",")[0] for line in plan.splitlines() if "Join" in line or "Exchange" in line]


def test_labels_of_documents_and_terms(spark):
    """With edges listed twice, null ends and a node without edges; and only the labels stay in the shared folder."""
    edges = documents_and_terms(1)
    rows = [(a, b, w / 2) for (a, b), w in edges.items() for _ in "12"] + [(None, -3, 1.0), (4, None, 1.0)]
    before = folders(spark)
    got = graph.communities(spark.createDataFrame(rows, "src int, dst int, weight double"), spark.createDataFrame([(900,)], "node int"), rounds=3)
    labels, settled = propagate(edges, 3)
    found = {r.node: r.label for r in got.collect() if r.node is not None}
    assert found == labels | {900: 900} and got.first().converged == settled
    assert kinds(spark, before) == ["labels"]


def test_small_side_may_be_src_and_lists_may_be_short(spark, monkeypatch):
    monkeypatch.setattr(graph, "LIST", 3)
    edges = {(b, a): w for (a, b), w in documents_and_terms(2).items()}
    got = graph.communities(edge_table(spark, edges), rounds=2).collect()
    assert {r.node: r.label for r in got} == propagate(edges, 2)[0]


def test_general_way_leaves_labels_only(spark):
    before = folders(spark)
    graph.communities(edge_table(spark, random_edges(4)), rounds=2)
    assert kinds(spark, before) == ["labels"]


def test_only_the_small_side_is_broadcast(spark):
    """Labels of the many nodes were broadcast once for each of eight parts while Spark thought them small."""
    edges = edge_table(spark, documents_and_terms(3))
    shelf = Shelf(spark)
    found = shelf.put("ends", graph.ends(edges))
    sides, flag = graph.two_sided(edges, found, shelf)
    labels = found.select("node", found.node.alias("label"), found[flag].alias("few"))
    few, many = labels.filter("few"), labels.filter("NOT few")
    assert flag == "second" and few.count() == 12 and sides.lists.count() == 40
    large = joins(sides.of_large(few.select("node", "label")).groupBy("node", "label").count())
    assert [x.split()[0] for x in large] == ["BroadcastHashJoin", "BroadcastExchange"]
    small = [x.split()[0] for x in joins(sides.of_small(many.select("node", "label"), few.select("node")))]
    assert small == ["BroadcastHashJoin", "ShuffledHashJoin", "Exchange", "BroadcastExchange"]
    shelf.drop("ends", "lists")


def test_no_broadcast_between_any_nodes(spark):
    df = graph.both_ways(edge_table(spark, random_edges(3)))
    lists = graph.by_neighbour(df.withColumn("salt", (df.node * 0).cast("int")), "weight")
    labels = df.select("node", df.node.alias("label")).distinct()
    moved = labels.select("node", labels.label.alias("before"), "label")
    votes = graph._votes(lists, labels)
    for plan in (votes, graph._changed_votes(votes, lists, moved)):
        assert joins(plan) and not any("Broadcast" in x for x in joins(plan))
    lists.unpersist()


@pytest.mark.parametrize("shown", [graph.MOST_SHOWN, 0])
def test_modularity_of_documents_and_terms(spark, monkeypatch, shown):
    """The same communities either way; only their paths stay in the shared folder."""
    monkeypatch.setattr(graph, "MOST_SHOWN", shown)
    rows = [(a, b, w) for (a, b), w in documents_and_terms(5, 30, 10, 3).items()] + [(3, -1, 0.4), (None, -2, 1.0), (4, None, 1.0)]
    edges = spark.createDataFrame(rows, "src int, dst int, weight double")
    before = folders(spark)
    found = modular_communities(edges.filter("src + dst IS NOT NULL"), spark.createDataFrame([(900,)], "node int"))
    labels = {r.node: r.label for r in found.labels().collect()}
    levels = [(r.communities, round(r.modularity, 9)) for r in found.levels.orderBy("level").collect()]
    assert kinds(spark, before) == ["path"] * len(levels) and len(levels) > 1 and labels[900] == 900
    assert graph.modularity(edges, found.labels()).first().modularity == pytest.approx(levels[-1][1])
    first = test_modularity_of_documents_and_terms.__dict__.setdefault("first", (labels, levels))
    assert first == (labels, levels)


def test_modularity_sums_edges_before_they_meet_the_many_labels(spark):
    """The labels of the many nodes were broadcast, or all edges shuffled twice."""
    edges = edge_table(spark, documents_and_terms(6))
    labels = graph.ends(edges).select("node", (graph.F.col("node") % 3).alias("label"))
    plan = graph.modularity(edges, labels)._jdf.queryExecution().executedPlan().toString()
    names = [word for word in plan.replace("(", " ").split() if word in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")]
    assert names[0] == "SortMergeJoin" and "sum(weight" in plan.partition("SortMergeJoin")[2]
    assert "LeftSemi" in plan.partition("SortMergeJoin")[2].partition("BroadcastExchange")[2]


def test_a_newer_table_replaces_the_older(spark):
    before, shelf = folders(spark), Shelf(spark)
    for n in (1, 2, 3):
        kept = shelf.put("numbers", spark.range(n).repartition(2, "id"), 2, "id")
    assert kept.count() == 3 and kinds(spark, before) == ["numbers"]
    shelf.drop("numbers", "never put")
    assert kinds(spark, before) == []
