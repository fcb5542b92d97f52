"""Communities by modularity: moves of single nodes, then of whole communities, level by level.

A level begins with every node as a community of its own. In a round first one
part of the nodes, chosen by a hash of node and round, and then the others move
to the neighbouring community that raises modularity the most, if any does. When
nearly no node moves, the communities become the nodes of a smaller weighted
graph, with the weights between them summed, and the next level begins there.
Levels end when modularity no longer rises, so each listed level is better
than the one before.

A level's links(node, neighbour, weight) hold each edge both ways; a link from a
node to itself carries twice the weight inside it. Edge tables of any size are
taken: a node's links are joined in parts and lie by neighbour for all rounds of a level, votes are summed per (node, label)
before the best is picked by a plain minimum, and a label travels with the
total degree of its community. If one side of the edges is small, as terms are, the first
level works on ``graph.Sides`` and no link is stored twice or shuffled. Only sums come to the driver.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators.graph import SALTS, Sides, both_ways, by_neighbour, ends, in_part, shown, two_sided
from corpusloom.session import Shelf, freed_shuffles, stored

LEVELS = 12
ROUNDS = 8
PARTS = 2
SETTLED = 0.01
GAIN = 1e-4


@dataclass
class Communities:
    """``path(node, level, label)`` of every level and ``levels(level, communities, modularity)``; labels of a level nest in those of the next."""

    path: DataFrame
    levels: DataFrame

    def labels(self) -> DataFrame:
        """(node, label) of the last level, whose modularity is the greatest."""
        last = self.levels.agg(F.max("level")).first()[0]
        return self.path.filter(F.col("level") == last).select("node", "label")


def _best(votes: DataFrame, state: DataFrame, whole: float, hint: str) -> DataFrame:
    """(node, best): the label with the greatest gain among votes(node, label, weight, total) and the node's own; ``hint`` for the join."""
    own = state.hint(hint).select("node", F.col("label").alias("own"), "degree", F.col("total").alias("own_total"))

    def rank(weight, label, total):
        others = total - F.when(label == F.col("own"), F.col("degree")).otherwise(0.0)
        gain = F.round(weight - F.col("degree") * others / whole, 9)
        return F.struct((-gain).alias("g"), (label != F.col("own")).alias("other"), label.alias("label"))

    heard, stay = rank(F.col("weight"), F.col("label"), F.col("total")), rank(F.lit(0.0), F.col("own"), F.col("own_total"))
    found = votes.join(own, "node")
    return found.groupBy("node").agg(F.min(heard).alias("heard"), F.min(stay).alias("stay")).select("node", F.least("heard", "stay")["label"].alias("best"))


def _moved(links: DataFrame | Sides, state: DataFrame, whole: float, turn: int, part: int, shelf: Shelf) -> DataFrame:
    """state(node, label, degree, few) after one part of the nodes has moved, with ``moved``; links: sides, or lists by neighbour."""
    mine = in_part("node", turn, PARTS) == part
    totals = state.groupBy("label").agg(F.sum("degree").alias("total"))
    known = shelf.put("known", state.join(totals.hint("merge"), "label").select("node", "label", "degree", "few", "total"))
    sums = F.sum("weight").alias("weight"), F.max("total").alias("total")
    if isinstance(links, Sides):
        few, many = known.filter("few"), known.filter("NOT few")
        of_large = links.of_large(few.select("node", "label", "total"), mine).groupBy("node", "label").agg(*sums)
        of_small = links.of_small(many.select("node", "label", "total"), few.filter(mine).select("node")).groupBy("node", "label").agg(*sums)
        best = _best(of_large, many, whole, "shuffle_hash").unionByName(_best(of_small, few, whole, "broadcast"))
    else:
        opened = links.join(shown(known, "label", "total").hint("merge"), ["neighbour", "salt"])
        near = opened.select("neighbour", "label", "total", F.explode("near").alias("l")).select("neighbour", "label", "total", "l.*")
        votes = near.filter(mine & (F.col("node") != F.col("neighbour"))).groupBy("node", "label").agg(*sums)
        best = _best(votes, known, whole, "merge")
    after = F.coalesce("best", "label")
    changed = state.select("node", "label", "degree", "few").join(best.hint("merge"), "node", "left")
    return shelf.put("moved", changed.select("node", after.alias("label"), "degree", "few", (after != F.col("label")).alias("moved")))


def _contracted(links: DataFrame | Sides, state: DataFrame, shelf: Shelf) -> DataFrame:
    """The links of the communities, summed."""
    if isinstance(links, Sides):
        named = both_ways(links.between(*(state.filter(side).select("node", "label") for side in ("NOT few", "few"))))
    else:
        first = state.select("node", F.col("label").alias("of_node")).hint("merge")
        second = state.select(F.col("node").alias("neighbour"), F.col("label").alias("of_neighbour")).hint("merge")
        named = links.join(first, "node").join(second, "neighbour").select(F.col("of_node").alias("node"), F.col("of_neighbour").alias("neighbour"), "weight")
    return shelf.put("links", _salted(named.groupBy("node", "neighbour").agg(F.sum("weight").alias("weight"))))


def _salted(links: DataFrame) -> DataFrame:
    return links.select("node", "neighbour", "weight", F.pmod(F.hash("node"), F.lit(SALTS)).alias("salt"))


def _quality(links: DataFrame, whole: float) -> tuple[int, float]:
    """(number, modularity) of the nodes of a contracted graph, each as a community."""
    inside = F.sum(F.when(F.col("node") == F.col("neighbour"), F.col("weight")).otherwise(0.0))
    each = links.groupBy("node").agg(F.sum("weight").alias("degree"), inside.alias("inside"))
    value = F.sum(F.col("inside") / whole - F.col("degree") * F.col("degree") / (whole * whole))
    return tuple(each.agg(F.count(F.lit(1)), F.coalesce(value, F.lit(0.0))).first())


def modular_communities(edges: DataFrame, nodes: DataFrame | None = None) -> Communities:
    """Communities of edges(src, dst, weight) with positive weights; ``nodes(node)`` adds nodes without edges.

    Edges listed more than once add up. A node without edges stays alone. The
    result depends on nothing but the table; ties go to the lower label.
    """
    spark, shelf = edges.sparkSession, Shelf(edges.sparkSession)
    found = shelf.put("ends", ends(edges))
    whole = float(found.agg(F.coalesce(F.sum("degree"), F.lit(0.0))).first()[0])
    every = found.select("node") if nodes is None else found.select("node").unionByName(nodes.select("node"))
    path = stored(every.distinct().select("node", F.col("node").alias("label")), "path")
    sided = two_sided(edges, found, shelf)
    if sided is None:
        links = shelf.put("links", _salted(both_ways(edges).groupBy("node", "neighbour").agg(F.sum("weight").alias("weight"))))
        number, quality = _quality(links, whole)
    else:
        square = F.sum(-F.col("degree") * F.col("degree") / (whole * whole))
        links, (number, quality) = sided[0], tuple(found.agg(F.count(F.lit(1)), square).first())
    paths, levels = [path.select("node", F.lit(0).alias("level"), "label")], [(0, path.count(), quality)]
    for level in range(1, LEVELS + 1):
        if isinstance(links, Sides):
            state, lists = found.select("node", "degree", F.col(sided[1]).alias("few")), links
        else:
            state = links.groupBy("node").agg(F.sum("weight").alias("degree")).withColumn("few", F.lit(False))
            lists = by_neighbour(links, "weight")
        state = shelf.put("moved", state.select("node", F.col("node").alias("label"), "degree", "few", F.lit(False).alias("moved")))
        for turn in range(ROUNDS):
            moves = 0
            for part in range(PARTS):
                state = _moved(lists, state, whole, turn, part, shelf)
                moves += state.filter("moved").count()
            if moves <= SETTLED * number:
                break
        if lists is not links:
            lists.unpersist()
        smaller = _contracted(links, state, shelf)
        with freed_shuffles(spark):
            fewer, better = _quality(smaller, whole)
        if not better > quality + GAIN:
            break
        shelf.drop("ends", "lists")
        step = state.select(F.col("node").alias("label"), F.col("label").alias("above")).hint("merge")
        path = stored(path.join(step, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "path")
        links, number, quality = smaller, fewer, better
        paths.append(path.select("node", F.lit(level).alias("level"), "label"))
        levels.append((level, path.select("label").distinct().count(), quality))
    shelf.drop("ends", "lists", "links", "known", "moved")
    union = paths[0]
    for own in paths[1:]:
        union = union.unionByName(own)
    return Communities(union, spark.createDataFrame(levels, "level int, communities long, modularity double"))
