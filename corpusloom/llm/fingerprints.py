"""Fingerprints of documents as invertible Bloom lookup sketches, in Spark SQL functions only.

A text is the set of the digests of its paragraphs (the parts between line
feeds). A digest is a 64-bit number that carries its own 24-bit checksum. Its
sketch has three rows of ``WIDTH`` cells; a digest falls into one cell of each
row, and a cell holds how many fell in and their exclusive-or. Subtracting two
sketches cell by cell leaves the digests that only one text has: a cell with
one digest shows it, taking it out of its other cells uncovers more, and so
on. If cells are left over, the two sets are sketched again at four times the
size, as four parts by a hash of the digest, and so on for the parts that fail
until none does.

From the number of differing digests follows the Jaccard likeness of the two
sets. Texts are whole; a null text is the empty text, which has one empty
paragraph, so equal texts have likeness 1.

Documents are put in descending order of key, null keys last, ties by text.
``EDGE`` keys in a row make a part; a text is shuffled once, to its group,
and only groups' ends meet their neighbours in the next group, in a tree of
parts of parts. A part is one group, unless it has over ``GROUP_ROWS`` rows: then
equal rows are counted first, and its groups are its keys, each cut by ranges of
the tie, so one key of very many rows, or no key, fills many groups. Equal rows
follow each other as separate rows.
"""

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.common import kept

WIDTH = 12
ROUNDS = 16
EDGE = 512
SPLIT = 4
GROUP_ROWS = 65_536
MOST_HOT = 100_000  # parts of more rows than a group takes, which are broadcast
COPIES = 4_096  # equal rows written out at once

CELLS = "array<struct<n: int, x: bigint>>"
CHECK = "(xxhash64(shiftrightunsigned({d}, 24)) & 16777215L)"


def digests(text: str) -> str:
    """SQL: the distinct digests of a text's paragraphs."""
    high = "shiftrightunsigned(xxhash64(p), 24)"
    return f"array_distinct(transform(split({text}, '\\n', -1), p -> shiftleft({high}, 24) | (xxhash64({high}) & 16777215L)))"


def _slot(row: int, digest: str) -> str:
    return f"pmod(shiftrightunsigned({digest}, {24 + 13 * row}) & 8191, {WIDTH})"


def sketch(ds: str) -> str:
    """SQL: the cells of a set of digests."""
    rows = [f"transform(sequence(0, {WIDTH - 1}), c -> filter({ds}, d -> {_slot(r, 'd')} = c))" for r in range(3)]
    return (
        f"transform(concat({', '.join(rows)}), f -> named_struct("
        "'n', size(f), 'x', aggregate(f, 0L, (a, d) -> a ^ d)))"
    )


def difference(a: str, b: str) -> str:
    """SQL: a sketch less another one."""
    return f"zip_with({a}, {b}, (p, q) -> named_struct('n', p.n - q.n, 'x', p.x ^ q.x))"


def _pure(cells: str) -> str:
    """SQL: the digests that stand alone in a cell, with their sign."""
    check = CHECK.format(d="c.x")
    return f"array_distinct(filter({cells}, c -> abs(c.n) = 1 AND (c.x & 16777215L) = {check}))"


def _without(cells: str, pure: str) -> str:
    """SQL: the cells less the given digests."""
    hit = " ".join(f"WHEN {r} THEN {_slot(r, 'p.x')}" for r in range(3))
    return (
        f"transform({cells}, (c, i) -> aggregate(filter({pure}, p -> (CASE i DIV {WIDTH} {hit} END) = i % {WIDTH}), c, "
        "(a, p) -> named_struct('n', a.n - p.n, 'x', a.x ^ p.x)))"
    )


def peeled(cells: str) -> str:
    """SQL: struct of the digests found with their signs, and whether no cell is left over."""
    start = f"named_struct('cells', {cells}, 'pure', {_pure(cells)}, 'found', CAST(array() AS {CELLS}))"
    step = (
        f"element_at(transform(array({_without('s.cells', 's.pure')}), "
        f"r -> named_struct('cells', r, 'pure', {_pure('r')}, 'found', concat(s.found, s.pure))), 1)"
    )
    return (
        f"aggregate(sequence(1, {ROUNDS}), {start}, (s, k) -> IF(size(s.pure) = 0, s, {step}), "
        "s -> named_struct('found', s.found, 'whole', NOT exists(s.cells, c -> c.n != 0 OR c.x != 0)))"
    )


def written(cells: str) -> str:
    """SQL: a sketch as text."""
    return f"array_join(transform({cells}, c -> concat(hex(c.n), ':', hex(c.x))), ' ')"


def differing(sets: DataFrame) -> DataFrame:
    """(id, n_differing, found) for rows (id, a, b) of two sets of digests with unique ids.

    ``found`` are the digests that only one of the sets has.
    """
    state = kept(
        sets.selectExpr("id", "a", "b", f"{difference(sketch('a'), sketch('b'))} AS cells").selectExpr(
            "id", "a", "b", f"{peeled('cells')} AS peel"
        ),
        "peeled",
    )
    done = [state.filter("peel.whole").selectExpr("id", "transform(peel.found, c -> c.x) AS found")]
    failed = state.filter("NOT peel.whole").selectExpr("id", "0L AS part", "a", "b")
    turn = 0
    while not failed.isEmpty():
        turn += 1
        sides = failed.selectExpr("id", "part", "explode(a) AS digest", "true AS own").unionByName(
            failed.selectExpr("id", "part", "explode(b) AS digest", "false AS own")
        )
        parts = (
            sides.selectExpr("id", f"part * {SPLIT} + pmod(xxhash64(digest, {turn}), {SPLIT}) AS part", "digest", "own")
            .groupBy("id", "part")
            .agg(F.expr("collect_list(CASE WHEN own THEN digest END) AS a"), F.expr("collect_list(CASE WHEN NOT own THEN digest END) AS b"))
        )
        state = kept(
            parts.selectExpr("id", "part", "a", "b", f"{difference(sketch('a'), sketch('b'))} AS cells").selectExpr(
                "id", "part", "a", "b", f"{peeled('cells')} AS peel"
            ),
            "peeled",
        )
        done.append(state.filter("peel.whole").selectExpr("id", "transform(peel.found, c -> c.x) AS found"))
        failed = state.filter("NOT peel.whole").select("id", "part", "a", "b")
    if len(done) == 1:
        return done[0].selectExpr("id", "CAST(size(found) AS BIGINT) AS n_differing", "found")
    every = done[1]
    for part in done[2:]:
        every = every.unionByName(part)
    retried = every.groupBy("id").agg(F.flatten(F.collect_list("found")).alias("found"))
    return done[0].unionByName(retried).selectExpr("id", "CAST(size(found) AS BIGINT) AS n_differing", "found")


def next_lower(ids: DataFrame) -> DataFrame:
    """(id, next): for distinct ids, null the last, the next lower one; the lowest has none."""
    if ids.limit(EDGE + 1).count() <= EDGE:  # few enough for one group
        return ids.select("id", F.lead(F.struct("id")).over(Window.partitionBy(F.lit(0)).orderBy(F.col("id").desc_nulls_last())).alias("next"))
    by_group = Window.partitionBy("part").orderBy(F.col("id").desc_nulls_last())
    grouped = ids.withColumn("part", _group("id"))
    own = grouped.withColumn("next", F.lead(F.struct("id")).over(by_group)).withColumn("top", F.first(F.struct("id")).over(by_group))
    own = kept(own, "order")
    groups = own.select("part", "top").distinct()
    if groups.limit(2).count() < 2:
        return own.select("id", "next")
    after = next_lower(groups.select(F.col("part").alias("id"))).select(
        F.col("id").alias("own"), F.col("next.id").alias("after"), F.col("next").isNotNull().alias("more")
    )
    tops = groups.select(F.col("part").alias("top_part"), F.col("top").alias("after_top"))
    inside = own.filter(F.col("next").isNotNull()).select("id", "next")
    last = own.filter(F.col("next").isNull()).select("id", "part")
    met = (
        last.join(after, last["part"].eqNullSafe(after["own"]))
        .join(tops, F.col("more") & F.col("after").eqNullSafe(F.col("top_part")), "left")
        .select("id", F.when(F.col("more"), F.col("after_top")).alias("next"))
    )
    return inside.unionByName(met)


def _group(key: str):
    return F.expr(f"({key} - pmod({key}, {EDGE}L)) DIV {EDGE}L")


GROUP = ["part", "key", "range"]


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc_id, text, tie, ds, part, key, range), and those of parts with too many rows with their number n, or None.

    In parts of too many rows equal rows are one. Their limit grows with the
    table only where there would be more than ``MOST_HOT`` such parts.
    """
    hashed = ["doc_id", "text", "xxhash64(text) AS tie", f"{digests('text')} AS ds", "part"]
    rows = rows.withColumn("part", _group("doc_id"))
    counts = rows.groupBy("part").count()
    total, largest = counts.agg(F.sum("count"), F.max("count")).first()
    limit = max(GROUP_ROWS, (total or 0) // MOST_HOT)
    cold = rows.selectExpr(*hashed, "CAST(NULL AS BIGINT) AS key", "0L AS range")
    if (largest or 0) <= limit:
        return cold, None
    hot = F.broadcast(counts.filter(F.col("count") > limit).select(F.col("part").alias("hot"), F.lit(True).alias("is_hot")))
    marked = rows.join(hot, F.col("part").eqNullSafe(F.col("hot")), "left")
    many = marked.filter("is_hot").groupBy("doc_id").count().agg(F.max("count")).first()[0]
    bits = (many // limit).bit_length()
    found = marked.filter("is_hot").groupBy("part", "doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
    copied = kept(found.selectExpr(*hashed, "n"), "copied")
    apart = copied.selectExpr("*", "doc_id AS key", f"shiftright(tie, {64 - bits}) AS range" if bits else "0L AS range").drop("n")
    rest = marked.filter("is_hot IS NULL").selectExpr(*hashed, "CAST(NULL AS BIGINT) AS key", "0L AS range")
    return rest.unionByName(apart), copied


def _following(groups: DataFrame) -> DataFrame:
    """(own, next): the group after each group; after the last comes the first."""
    order = Window.partitionBy("part").orderBy(F.col("key").desc_nulls_last(), "range")
    own = F.struct(*GROUP)
    placed = kept(groups.select("part", own.alias("own"), F.lead(own).over(order).alias("next"), F.first(own).over(order).alias("top")), "groups")
    tops = placed.select("part", "top").distinct()
    first = placed.orderBy(F.col("part").desc_nulls_last()).limit(1).select("part").head()
    after = next_lower(tops.select(F.col("part").alias("id"))).select(
        F.col("id").alias("own_part"),
        F.when(F.col("next").isNotNull(), F.col("next.id")).otherwise(F.lit(None if first is None else first[0]).cast("long")).alias("next_part"),
    )
    reached = after.join(tops, F.col("next_part").eqNullSafe(F.col("part"))).select("own_part", F.col("top").alias("after_top"))
    inside = placed.filter("next IS NOT NULL").select("own", "next")
    last = placed.filter("next IS NULL").select("part", "own")
    return inside.unionByName(last.join(reached, F.col("part").eqNullSafe(F.col("own_part"))).select("own", F.col("after_top").alias("next")))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last half, rounded down, replaced by as much of the
    next document's beginning; after the last document comes the first.
    """
    rows, copied = _grouped(docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "coalesce(CAST(text AS STRING), '') AS text"))
    order = Window.partitionBy(*GROUP).orderBy(F.col("doc_id").desc_nulls_last(), "tie")
    placed = rows.withColumn("place", F.row_number().over(order)).withColumn("follow", F.lead(F.struct("text", "ds")).over(order))
    edge = "place = 1 OR follow IS NULL"
    half = "length(text) DIV 2"
    edited = f"concat(substring(text, 1, CAST(length(text) - {half} AS INT)), substring(follow.text, 1, CAST({half} AS INT)))"
    columns = [
        "doc_id", "CAST(length(text) AS BIGINT) AS n_chars", "ds", "follow.ds AS next_ds",
        f"CASE WHEN follow IS NOT NULL THEN {edited} END AS edited",
    ]
    shown = placed.selectExpr(*columns, *GROUP, "place", "follow IS NULL AS last", f"CASE WHEN {edge} THEN text END AS text")
    digested = ["doc_id", "n_chars", "ds", "next_ds", "sha2(edited, 256) AS edited_sha256", f"{digests('edited')} AS edited_ds"]
    own = kept(shown.selectExpr(*digested, *GROUP, "place", "last", "text"), "neighbours")

    heads = kept(own.filter("place = 1").select(*GROUP, "text", "ds"), "heads")
    lasts = own.filter("last").select("doc_id", "n_chars", *GROUP, "text", "ds")
    following = _following(heads.select(*GROUP))
    heads = heads.select(F.struct(*GROUP).alias("head"), F.struct("text", "ds").alias("follow"))
    met = lasts.join(following, F.struct(*(lasts[c] for c in GROUP)).eqNullSafe(F.col("own"))).join(heads, F.col("next").eqNullSafe(F.col("head")))
    ends = met.selectExpr(*columns).selectExpr(*digested)
    every = own.filter("NOT last").select(*ends.columns).unionByName(ends).withColumn("copies", F.lit(1).cast("long"))
    if copied is not None:  # all of equal rows but one are followed by their like
        alike = copied.filter("n > 1").withColumn("follow", F.struct("text", "ds"))
        every = every.unionByName(alike.selectExpr(*columns, "n - 1 AS copies").selectExpr(*digested, "copies"))
    every = kept(every.withColumn("id", F.monotonically_increasing_id()), "digests")

    pairs = every.selectExpr("id * 2 AS id", "ds AS a", "edited_ds AS b").unionByName(
        every.selectExpr("id * 2 + 1 AS id", "ds AS a", "next_ds AS b")
    )
    found = differing(pairs).select("id", "n_differing")
    by_row = found.groupBy(F.expr("id DIV 2").alias("id")).agg(
        F.max(F.expr("CASE WHEN id % 2 = 0 THEN n_differing END")).alias("from_edited"),
        F.max(F.expr("CASE WHEN id % 2 = 1 THEN n_differing END")).alias("from_next"),
    )
    near = "(size(ds) + size({o}) - {d}) / CAST(size(ds) + size({o}) + {d} AS DOUBLE)"
    shown = every.join(by_row, "id").selectExpr(
        "doc_id", "n_chars", "edited_sha256",
        f"{written(sketch('ds'))} AS fingerprint",
        f"{written(sketch('edited_ds'))} AS edited_fingerprint",
        f"{near.format(o='edited_ds', d='from_edited')} AS near_edited",
        f"{near.format(o='next_ds', d='from_next')} AS near_next",
        "copies",
    )
    if copied is None:
        return shown.drop("copies")
    lots = shown.withColumn("lot", F.expr(f"explode(sequence(0L, copies - 1, {COPIES}L))")).repartition("doc_id", "edited_sha256", "lot")
    return lots.withColumn("copy", F.expr(f"explode(sequence(1L, least({COPIES}L, copies - lot)))")).drop("copies", "lot", "copy")
