"""Document filters: language, keywords, sampling."""

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.fixed_values import MIN_KEYWORD_HITS
from corpusloom.functions.text import quoted, tokens_sql

# Largest keyword list. Keywords also join the vocabulary, and more of them would
# be no vocabulary that the later steps can hold.
MOST_KEYWORDS = 100_000


def in_language(docs: DataFrame, lang: str = "en", column: str = "lang") -> DataFrame:
    return docs.filter(F.col(column) == lang)


def has_keywords(keywords: DataFrame, min_hits: int = MIN_KEYWORD_HITS) -> Column:
    """Whether ``text`` has at least ``min_hits`` token occurrences among keywords(term).

    The same keyword twice counts twice. The list is a hash set inside the
    expression, so hits are counted per row and nothing is shuffled; a list of
    more than ``MOST_KEYWORDS`` terms is refused.
    """
    terms = [row.term for row in keywords.select("term").distinct().limit(MOST_KEYWORDS + 1).collect()]
    if len(terms) > MOST_KEYWORDS:
        raise ValueError(f"more than {MOST_KEYWORDS} keywords")
    if not terms:
        return F.lit(min_hits <= 0)
    hits = F.expr(f"filter({tokens_sql('text')}, t -> t IN ({quoted(terms)}))")
    return F.coalesce(F.size(hits) >= min_hits, F.lit(False))


def with_keywords(docs: DataFrame, keywords: DataFrame, min_hits: int = MIN_KEYWORD_HITS) -> DataFrame:
    """Rows with at least ``min_hits`` token occurrences among keywords(term)."""
    return docs.filter(has_keywords(keywords, min_hits))


def sample_documents(docs: DataFrame, per_thousand: int, seed: int = 0) -> DataFrame:
    """About ``per_thousand`` of every 1,000 documents, chosen by a hash of the key.

    Unlike a random draw it gives the same documents after a task is redone,
    and however the input is partitioned.
    """
    digest = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f"#{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000
    return docs.filter(bucket < per_thousand)
