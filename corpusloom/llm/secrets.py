"""Secrets in texts, and how widely each is copied.

Three kinds are always found: ``assign`` (a value given to a name like token or
password), ``access`` (access key ids) and ``hex`` (long hexadecimal runs).
``other`` are further runs of at least 24 letters, digits and ``+/_=-`` of
mixed kinds and high entropy that no other kind covers.

Ownership: the hash of every candidate's value is counted over the corpus by
the distinct repositories (one document is one) and owners (the source)
that have it. A value with at least ``WIDE_OWNERS`` owners and
``WIDE_REPOSITORIES`` repositories is a widely copied example; any other is
owner-specific and taken for live. Only a value's hash leaves its document.
Candidates of kind ``other`` become spans only if they are live; spans of the
three first kinds always stay.

Equal texts are counted by owner first, and counts of a value are combined
per owner before they meet, so a value in a third of all rows does no harm. A
null or empty text has no candidates; a null owner is one owner; rows with
equal or null keys stay separate rows, and a null key is its text's.
"""

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import free_name, kept, slices, strings, text_key

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
OTHER = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
MAY_HOLD = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{16}|[A-Za-z0-9+/_=-]{24}"
KINDS = ("assign", "access", "hex", "other")
ENTROPY = 3.5
WIDE_OWNERS = 3
WIDE_REPOSITORIES = 5
FOUND = "array<struct<kind: string, start: int, end: int, hash: binary>>"
FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary())]))


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in (value.count(x) for x in set(value)))


def mixed_kinds(value: str) -> bool:
    kinds = sum(any(f(c) for c in value) for f in (str.isupper, str.islower, str.isdigit))
    return kinds == 3 and entropy(value) >= ENTROPY


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) in order of start and kind; places are code points, ends exclusive."""
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    base = sorted((s, e) for _, s, e, _ in found)
    nth, reach = 0, 0  # both kinds of spans come in order of start: one sweep over both
    for m in OTHER.finditer(text):
        start, end = m.span()
        while nth < len(base) and base[nth][0] < end:
            reach = max(reach, base[nth][1])
            nth += 1
        if reach <= start and mixed_kinds(m[0]):
            found.append(("other", start, end, m[0]))
    return sorted(found, key=lambda c: (c[1], KINDS.index(c[0])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def scanned(docs: DataFrame, owner: str = "source") -> DataFrame:
    """(doc_id, owner, key, found) of every row: its candidates with the hashes of their values."""

    def run(batches):
        for batch in slices(batches):
            rows = [
                [(k, s, e, hashlib.sha256(v.encode("utf-8", "surrogatepass")).digest()[:16]) for k, s, e, v in candidates(t)]
                for t in strings(batch.column("text"))
            ]
            found = pa.array([[dict(zip(("kind", "start", "end", "hash"), c)) for c in row] for row in rows], FOUND_TYPE)
            columns = [batch.column(c) for c in ("doc_id", "owner", "key")]
            yield pa.RecordBatch.from_arrays([*columns, found], ["doc_id", "owner", "key", "found"])

    has_owner = owner in docs.columns
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.col(owner).cast("string") if has_owner else F.lit(None).cast("string")).alias("owner"),
        text_key().alias("key"),
        F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInArrow(run, f"doc_id long, owner string, key binary, found {FOUND}")


def ownership(scans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) of every candidate value of the corpus."""
    owner = F.coalesce(F.concat(F.lit("="), "owner"), F.lit("")).alias("owner")
    repository = F.coalesce(F.col("doc_id").cast("string"), F.hex("key"))
    rows = scans.filter(F.size("found") > 0).select(
        owner, repository.alias("repository"), F.explode(F.array_distinct(F.transform("found", lambda c: c["hash"]))).alias("hash")
    )
    by_repository = rows.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def _text_verdicts(scans: DataFrame) -> DataFrame:
    """(key, wide): for every distinct text with candidates, the hashes that are widely copied."""
    wide = ownership(scans).filter((F.col("n_owners") >= WIDE_OWNERS) & (F.col("n_repositories") >= WIDE_REPOSITORIES))
    values = scans.filter(F.size("found") > 0).select("key", F.explode("found.hash").alias("hash")).distinct()
    return values.join(wide.select("hash"), "hash").groupBy("key").agg(F.collect_set("hash").alias("wide"))


def judged(docs: DataFrame, owner: str = "source") -> DataFrame:
    """(doc_id, key, spans, live, examples) of every row, spans with kind, start and end.

    ``spans`` are the base spans and the live ones of kind ``other``; ``live``
    are owner-specific, ``examples`` widely copied.
    """
    scans = kept(scanned(docs, owner), "scans")
    none = F.array().cast("array<binary>")
    some = scans.filter(F.size("found") > 0).join(_text_verdicts(scans), "key", "left")
    rows = some.withColumn("wide", F.coalesce("wide", none)).unionByName(
        scans.filter(F.size("found") == 0).withColumn("wide", none)
    )
    is_wide = F.transform("found", lambda c: F.array_contains("wide", c["hash"]))
    shown = rows.withColumn(
        "found",
        F.transform(
            F.arrays_zip("found", is_wide.alias("wide")),
            lambda x: F.struct(
                x["found"]["kind"].alias("kind"), x["found"]["start"].alias("start"), x["found"]["end"].alias("end"), x["wide"].alias("wide")
            ),
        ),
    )
    return shown.select(
        "doc_id",
        "key",
        F.filter("found", lambda c: ~c["wide"] | (c["kind"] != "other")).alias("spans"),
        F.filter("found", lambda c: ~c["wide"]).alias("live"),
        F.filter("found", lambda c: c["wide"]).alias("examples"),
    )


def _listed(spans):
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ",")


def report(docs: DataFrame, owner: str = "source") -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, live and copied ones."""

    def count(spans, kind):
        return F.size(F.filter(spans, lambda c: c["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda c: c["kind"] != "other")
    return judged(docs, owner).select(
        "doc_id",
        *(count("spans", k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.size("examples").cast("long").alias("n_examples"),
        _listed("live").alias("live_spans"),
    )


def redacted(docs: DataFrame, owner: str = "source") -> DataFrame:
    """The documents with live secrets replaced by ``[secret]``; no row is lost.

    Only texts that may hold a candidate are shuffled, to meet the set of
    hashes of their widely copied values.
    """
    verdicts = kept(_text_verdicts(kept(scanned(docs, owner), "scans")), "copied-values")
    columns = docs.columns
    key_name, wide_name = free_name(columns, "key"), free_name(columns, "wide")
    may = F.coalesce(F.col("text").cast("string").rlike(MAY_HOLD), F.lit(False))
    joined_rows = docs.filter(may).withColumn(key_name, text_key()).join(
        verdicts.select(F.col("key").alias(key_name), F.col("wide").alias(wide_name)), key_name, "left"
    )
    place = columns.index("text")

    def run(batches):
        for batch in slices(batches):
            texts, wide = batch.column("text").to_pylist(), batch.column(wide_name).to_pylist()
            new = pa.array([t if t is None else without_live(t, w or ()) for t, w in zip(texts, wide)], pa.string())
            arrays = [batch.column(c) for c in columns]
            arrays[place] = new
            if "n_chars" in columns:
                size = [n if t is None or t == u else len(u) for n, t, u in zip(batch.column("n_chars").to_pylist(), texts, new.to_pylist())]
                at = columns.index("n_chars")
                arrays[at] = pa.array(size, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    changed = joined_rows.select(*(F.col(f"`{c}`") for c in columns), wide_name).mapInArrow(run, docs.schema)
    return docs.filter(~may).unionByName(changed)


def without_live(text: str, wide) -> str:
    """The text with its owner-specific secrets replaced; spans that touch are replaced as one."""
    out, at = [], 0
    for _, start, end, value in candidates(text):
        if hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16] in wide:
            continue
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text
