"""Vocabulary: document frequencies, word lists combined, term positions."""

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.functions.fixed_values import MIN_TOKEN_CHARS, VOCABULARY_SIZE
from corpusloom.functions.text import tokens


# No token is empty, so the empty term can stand for the documents themselves.
EVERY_DOCUMENT = ""


def document_frequency(docs: DataFrame) -> DataFrame:
    """(term, df) over the documents; the empty term has the number of documents.

    One pass gives both. Terms are made distinct inside each document; what is
    shuffled is one partial count per term and task, so a word in every
    document costs no more than a rare one.
    """
    terms = F.array_append(F.array_distinct(tokens("text")), F.lit(EVERY_DOCUMENT))
    return (
        docs.select(F.explode_outer(terms).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def frequent_terms(frequencies: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``size`` most frequent terms, as (term, df): the head of a derived vocabulary."""
    terms = frequencies.filter(F.col("term") != EVERY_DOCUMENT)
    return terms.orderBy(F.desc("df"), "term").limit(size)


def listed_terms(words: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """First ``size`` words of an ordered word list(term, pos)."""
    return words.orderBy("pos").limit(size)


def combine_words(
    base: DataFrame, extra: DataFrame | None = None, excluded: DataFrame | None = None
) -> DataFrame:
    """Distinct lower-case terms of ``base`` and ``extra`` without ``excluded``."""
    terms = base.select("term")
    if extra is not None:
        terms = terms.unionByName(extra.select("term"))
    terms = terms.select(F.lower("term").alias("term")).distinct()
    terms = terms.filter(F.length("term") >= MIN_TOKEN_CHARS)
    if excluded is not None:
        terms = terms.join(excluded.select("term"), "term", "left_anti")
    return terms


def positions(terms: DataFrame) -> DataFrame:
    """Terms with ``idx``, their place in sorted order.

    One window over the whole vocabulary: it holds at most the vocabulary size
    and the filter words, about 25,000 short rows.
    """
    return terms.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)
