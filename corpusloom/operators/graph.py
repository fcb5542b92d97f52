"""Cluster graph: similarity edges, communities, modularity, display weights.

An edge table is edges(src, dst, weight), each undirected edge once. Except
for ``jaccard_edges`` the operators take edge tables of any size.
"""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.session import Shelf

# Rounds of label propagation at most, and parts of a node's links in the join with labels.
ROUNDS = 10
SALTS = 8
# Links of a task at about the most, and rounds whose halves a link carries as bits.
PART_LINKS = 4_000_000
HALVES = 30
# Links of a list at most. Share of the nodes: when no more move in a round, votes are kept and corrected.
LIST = 8192
FEW = 0.25
# Nodes of a side at most whose labels go to every task, as many as a model has terms; links of a task with such a side.
MOST_SHOWN = 262_144
SIDE_LINKS = 2_000_000


def jaccard_edges(members: DataFrame) -> DataFrame:
    """(src, dst, weight): Jaccard similarity of clusters that share a keyword.

    ``members(cluster_id, term)`` are the keyword sets of one clustering: at
    most 100 clusters of 100 keywords, so a term is in at most 100 sets. Not
    for sets of unbounded number, such as documents.
    """
    sized = members.withColumn(
        "size", F.count(F.lit(1)).over(Window.partitionBy("cluster_id"))
    )
    a, b = sized.alias("a"), sized.alias("b")
    shared = (
        a.join(b, (F.col("a.term") == F.col("b.term")) & (F.col("a.cluster_id") < F.col("b.cluster_id")))
        .groupBy(
            F.col("a.cluster_id").alias("src"),
            F.col("b.cluster_id").alias("dst"),
            (F.col("a.size") + F.col("b.size")).alias("sizes"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return shared.select("src", "dst", (F.col("n") / (F.col("sizes") - F.col("n"))).alias("weight"))


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, without a second read of the edge table."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("node"), F.col("src").alias("neighbour")),
    )
    return edges.select(F.explode(ends).alias("e"), "weight").select("e.node", "e.neighbour", "weight")


def in_second_half(node: str, turn: int):
    """Whether a node moves in the second half of a round; another half of the nodes each round."""
    digit = F.substring(F.md5(F.concat(F.col(node).cast("string"), F.lit(f"#{turn}"))), 8, 1)
    return digit.isin(*"13579bdf")


def in_part(node: str, turn: int, parts: int):
    """The part, of ``parts``, to which a node belongs in a round; another deal each round."""
    return F.pmod(F.xxhash64(F.col(node), F.lit(turn)), F.lit(parts))


def by_neighbour(links: DataFrame, *carried: str) -> DataFrame:
    """(neighbour, salt, near): stored links in lists of at most ``LIST``, kept by the executors; to be unpersisted.

    ``near`` lists (node, carried...). The lists lie by (neighbour, salt) and are
    sorted, in a number of parts that goes with the links, so a later join with
    labels moves and sorts the labels only and opens the lists that match.
    """
    least = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-links.count() // PART_LINKS))
    placed = links.repartition(parts, "neighbour", "salt").sortWithinPartitions("neighbour", "salt")
    numbered = placed.withColumn("part", F.floor(F.monotonically_increasing_id() / LIST))
    near = F.collect_list(F.struct("node", *carried)).alias("near")
    lists = numbered.groupBy("neighbour", "salt", "part").agg(near).select("neighbour", "salt", "near")
    return lists.sortWithinPartitions("neighbour", "salt").persist(StorageLevel.MEMORY_AND_DISK)


def shown(labels: DataFrame, *columns: str) -> DataFrame:
    """labels(node, columns...) once for each part of a neighbour's links."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return labels.select(F.col("node").alias("neighbour"), *columns, salts)


@dataclass(frozen=True)
class Sides:
    """Edges between two sets of nodes of which one is small, as documents and terms.

    ``lists(node, near)`` has the links of the large side, near(neighbour, weight),
    in lists of at most ``LIST``. They lie by node, each edge once, and stay there: the
    labels of their nodes are brought to them, and those of the small side, of
    at most ``MOST_SHOWN`` nodes, go to every task. So a round shuffles no link.
    """

    lists: DataFrame

    def of_large(self, few: DataFrame, mine=None) -> DataFrame:
        """(node, weight, columns of few but node) of the links of the large side's nodes, or of those ``mine``."""
        lists = self.lists if mine is None else self.lists.filter(mine)
        near = lists.select(F.col("node").alias("of"), F.explode("near").alias("l")).select("of", F.col("l.neighbour").alias("node"), "l.weight")
        return near.join(F.broadcast(few), "node").drop("node").withColumnRenamed("of", "node")

    def of_small(self, many: DataFrame, few: DataFrame) -> DataFrame:
        """(node, weight, columns of many but node) of the links of nodes of the small side, those in few(node)."""
        known = self.lists.join(many.hint("shuffle_hash"), "node").drop("node")
        near = known.select(*(c for c in known.columns if c != "near"), F.explode("near").alias("l"))
        return near.select(F.col("l.neighbour").alias("node"), "l.weight", *(c for c in near.columns if c != "l")).join(F.broadcast(few), "node", "left_semi")


    def between(self, many: DataFrame, few: DataFrame) -> DataFrame:
        """(src, dst, weight): the edges between the labels of many(node, label) and few(node, label), summed."""
        named = self.lists.join(many.hint("shuffle_hash"), "node").select(F.col("label").alias("src"), F.explode("near").alias("l"))
        named = named.select("src", F.col("l.neighbour").alias("node"), "l.weight").join(F.broadcast(few), "node")
        return named.groupBy("src", F.col("label").alias("dst")).agg(F.sum("weight").alias("weight"))


def ends(edges: DataFrame) -> DataFrame:
    """(node, degree, first, second): the nodes, their weight and whether they are a src and a dst of an edge."""
    both = F.array(
        F.struct(F.col("src").alias("node"), F.lit(True).alias("first")),
        F.struct(F.col("dst").alias("node"), F.lit(False).alias("first")),
    )
    each = edges.select(F.explode(both).alias("e"), "weight").select("e.*", "weight").groupBy("node")
    return each.agg(F.sum("weight").alias("degree"), F.max("first").alias("first"), F.max(~F.col("first")).alias("second"))


def two_sided(edges: DataFrame, nodes: DataFrame, shelf: Shelf) -> tuple[Sides, str] | None:
    """The edges as sides, and which column of nodes, those of ``ends``, tells the small one; None if no side is small or a node is on both."""
    known = nodes.filter("node IS NOT NULL")
    firsts, seconds, twice = (
        n or 0 for n in known.agg(*(F.sum(F.expr(c).cast("bigint")) for c in ("first", "second", "first AND second"))).first()
    )
    if twice or not 0 < min(firsts, seconds) <= MOST_SHOWN:
        return None
    large, small, flag = ("src", "dst", "second") if firsts >= seconds else ("dst", "src", "first")
    whole = edges.filter("src IS NOT NULL AND dst IS NOT NULL")
    least = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-whole.count() // SIDE_LINKS))
    links = whole.select(F.col(large).alias("node"), F.col(small).alias("neighbour"), "weight")
    placed = links.repartition(parts, "node").sortWithinPartitions("node")
    numbered = placed.withColumn("part", F.floor(F.monotonically_increasing_id() / LIST))
    near = F.collect_list(F.struct("neighbour", "weight")).alias("near")
    lists = numbered.groupBy("node", "part").agg(near).select("node", "near")
    return Sides(shelf.put("lists", lists, parts, "node")), flag


def _votes(lists: DataFrame, labels: DataFrame, mine=None) -> DataFrame:
    """(node, label, weight, n): sums over the links of all nodes, or of those ``mine``."""
    near = lists.join(shown(labels, "label").hint("merge"), ["neighbour", "salt"]).select("label", F.explode("near").alias("l")).select("label", "l.*")
    near = near if mine is None else near.filter(mine)
    return near.groupBy("node", "label").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))


def _changed_votes(votes: DataFrame, lists: DataFrame, moved: DataFrame) -> DataFrame:
    """The votes after moved(node, before, label): only links of these nodes are opened."""
    near = lists.join(shown(moved, "before", "label").hint("merge"), ["neighbour", "salt"]).select("before", "label", F.explode("near").alias("l"))
    both = F.array(
        F.struct(F.col("before").alias("label"), (-F.col("l.weight")).alias("weight"), F.lit(-1).cast("bigint").alias("n")),
        F.struct(F.col("label").alias("label"), F.col("l.weight").alias("weight"), F.lit(1).cast("bigint").alias("n")),
    )
    change = near.select("l.node", F.explode(both).alias("v")).select("node", "v.*")
    sums = votes.unionByName(change).groupBy("node", "label").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))
    return sums.filter("n > 0")


def _best(votes: DataFrame, own: DataFrame) -> DataFrame:
    """(node, best): the label that wins among votes(node, label, weight), for nodes of own(node, own)."""
    rank = F.struct((-F.round("weight", 9)).alias("w"), (F.col("label") != F.col("own")).alias("other"), "label")
    return votes.join(own, "node").groupBy("node").agg(F.min(rank)["label"].alias("best"))


def _relabelled(labels: DataFrame, best: DataFrame, shelf: Shelf) -> tuple[DataFrame, int]:
    """The labels after the winners took over, with ``before`` and ``moved``, and how many nodes moved."""
    kept = [c for c in labels.columns if c not in ("label", "before", "moved")]
    after = labels.select(*kept, F.col("label").alias("before")).join(best.withColumnRenamed("best", "label").hint("merge"), "node", "left")
    after = after.select(*kept, F.coalesce("label", "before").alias("label"), "before")
    labels = shelf.put("labels", after.withColumn("moved", F.col("label") != F.col("before")))
    return labels, labels.filter("moved").count()


def communities(edges: DataFrame, nodes: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(node, label, converged) by label propagation until no label changes.

    Every node starts with itself as label. In a round first one half of the
    nodes, chosen by a hash of node and round, and then the other takes the
    label with the largest total edge weight among its neighbours (compared
    after rounding to 9 places; its own label wins a tie, else the lower one),
    so linked nodes do not swap labels for ever. ``converged`` says that a
    whole round changed nothing, which within ``rounds`` rounds it need not.
    ``nodes(node)`` adds nodes without edges, which keep themselves.

    Votes are summed per (node, label) before the best is picked by a plain
    minimum. Edges between two sets of nodes, one of them small, are kept as
    ``Sides``. Of others a node's links are joined in ``SALTS`` parts, so a node with
    very many neighbours is never in one task whole. Links lie by neighbour for
    all rounds and carry the halves of their node. Once few nodes move, the votes
    are kept and only the links of nodes that moved are added and taken off.
    The edges are read some four times, so they should be stored.
    """
    shelf = Shelf(edges.sparkSession)
    found = shelf.put("ends", ends(edges))
    sided = two_sided(edges, found, shelf)
    every = found.select("node", F.lit(False).alias("few") if sided is None else F.col(sided[1]).alias("few"))
    if nodes is not None:
        every = every.unionByName(nodes.select("node", F.lit(False).alias("few")))
    every = every.groupBy("node").agg(F.max("few").alias("few"))
    labels = shelf.put("labels", every.select("node", F.col("node").alias("label"), "few"))
    labels, converged = _unsided(edges, labels, rounds, shelf) if sided is None else _sided(sided[0], labels, rounds, shelf)
    shelf.drop("ends", "lists", "votes")
    return labels.select("node", "label", F.lit(converged).alias("converged"))


def _sided(sides: Sides, labels: DataFrame, rounds: int, shelf: Shelf) -> tuple[DataFrame, bool]:
    """The labels after the rounds, and whether they have settled, for the edges of ``sides``."""
    for turn in range(rounds):
        moves = 0
        for half in (False, True):
            mine = in_second_half("node", turn) == half
            few, many = labels.filter("few"), labels.filter("NOT few")
            own = F.col("label").alias("own")
            sums = F.sum("weight").alias("weight")
            of_large = sides.of_large(few.select("node", "label"), mine).groupBy("node", "label").agg(sums)
            of_small = sides.of_small(many.select("node", "label"), few.filter(mine).select("node")).groupBy("node", "label").agg(sums)
            best = _best(of_large, many.select("node", own).hint("shuffle_hash"))
            best = best.unionByName(_best(of_small, F.broadcast(few.select("node", own))))
            labels, last = _relabelled(labels, best, shelf)
            moves += last
        if not moves:
            return labels, True
    return labels, False


def _unsided(edges: DataFrame, labels: DataFrame, rounds: int, shelf: Shelf) -> tuple[DataFrame, bool]:
    """As ``_sided`` for edges between any nodes."""
    salt = F.pmod(F.hash("node"), F.lit(SALTS)).alias("salt")
    links = both_ways(edges).select("node", "neighbour", "weight", salt)
    bits = [F.when(in_second_half("node", t), 1 << t).otherwise(0) for t in range(min(rounds, HALVES))]
    halves = labels.select("node", sum(bits, F.lit(0)).alias("halves"))
    lists = by_neighbour(shelf.put("links", links.join(halves.hint("merge"), "node")), "weight", "halves")
    few, votes, converged = FEW * labels.count(), None, False
    for turn in range(rounds):
        moves = 0
        second = F.col("halves").bitwiseAND(F.lit(1 << turn)) != 0 if turn < HALVES else in_second_half("node", turn)
        for half in (False, True):
            mine = in_second_half("node", turn) == half
            heard = _votes(lists, labels, second == half) if votes is None else votes
            own = labels.filter(mine).select("node", F.col("label").alias("own"))
            labels, last = _relabelled(labels, _best(heard, own.hint("merge")), shelf)
            moves += last
            if votes is not None and last:
                moved = labels.filter("moved").select("node", "before", "label")
                votes = shelf.put("votes", _changed_votes(votes, lists, moved))
        if not moves:
            converged = True
            break
        if votes is None and moves <= few:
            votes = shelf.put("votes", _votes(lists, labels))
    lists.unpersist()
    shelf.drop("links")
    return labels, converged


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row (communities, modularity) for a labelling of the nodes.

    One pass over labelled edges: each adds its weight to the degree of both
    ends' communities and, when they agree, to the inner weight. If one of the
    sides is small, as terms are, its labels go to every task and edges are summed by
    the other side's node and this label before they meet the other labels.
    """
    distinct = edges.agg(*(F.approx_count_distinct(c).alias(c) for c in ("src", "dst"))).first()
    small, large = ("src", "dst") if distinct.src < distinct.dst else ("dst", "src")
    names = {c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")) for c in (small, large)}
    if distinct[small] <= MOST_SHOWN:
        shown_labels = F.broadcast(names[small].join(edges.select(small).distinct(), small, "left_semi"))
        labelled = edges.join(shown_labels, small).groupBy(large, f"{small}_label").agg(F.sum("weight").alias("weight"))
    else:
        labelled = edges.join(names[small].hint("merge"), small)
    labelled = labelled.join(names[large].hint("merge"), large)
    inner = F.when(F.col("src_label") == F.col("dst_label"), F.col("weight")).otherwise(0.0)
    parts = F.array(
        F.struct(F.col("src_label").alias("label"), inner.alias("inner")),
        F.struct(F.col("dst_label").alias("label"), F.lit(0.0).alias("inner")),
    )
    per_community = (
        labelled.select(F.explode(parts).alias("p"), "weight")
        .groupBy("p.label")
        .agg(F.sum("p.inner").alias("inner"), F.sum("weight").alias("degree"))
    )
    twice = F.sum("degree")
    return per_community.agg(
        F.count(F.lit(1)).alias("communities"),
        (2 * F.sum("inner") / twice - F.sum(F.col("degree") * F.col("degree")) / (twice * twice)).alias(
            "modularity"
        ),
    )


def display_weights(keywords: DataFrame) -> DataFrame:
    """Keywords with ``scale``, their weight relative to the cluster's heaviest."""
    heaviest = F.max("weight").over(Window.partitionBy("cluster_id"))
    return keywords.withColumn("scale", F.col("weight") / heaviest)
