"""Term weights: counts, norms, IDF and TF-IDF vectors.

A document's counts, norm and vector are built inside its row. None of them
passes through a shuffle; only document frequencies, at most one row per term
and task, do.

Computed arrays are unnested with ``explode_outer`` here and in the other
modules: for ``explode`` the optimizer adds filters on the array that compute
it again, further down.
"""

from dataclasses import dataclass
from functools import cached_property, lru_cache
from math import log

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Interaction, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.fixed_values import VOCABULARY_SIZE
from corpusloom.functions.text import norm_sql, runs_norm, token_runs, token_runs_sql, tokens, tokens_sql
from corpusloom.operators.vocabulary import EVERY_DOCUMENT, document_frequency

# Terms of a vocabulary at most.
MOST_TERMS = 262_144


def term_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, term, c) for every token of every document."""
    runs = F.expr(token_runs_sql(tokens_sql("text")))
    counted = docs.select("doc_id", F.explode_outer(runs).alias("run")).filter("run IS NOT NULL")
    return counted.select("doc_id", "run.term", "run.c")


def document_norms(docs: DataFrame) -> DataFrame:
    """(doc_id, norm): Euclidean norm of all term counts, in or out of a vocabulary."""
    return docs.select("doc_id", F.expr(norm_sql(tokens_sql("text"))).alias("norm"))


@dataclass(frozen=True)
class Weighting:
    """A fitted vocabulary: ``terms`` holds (term, df, idf) in sorted order.

    With m documents, idf = ln((m + 1) / (df + 1)).

    It is bounded by the vocabulary size and held like any Spark ML model
    state; ``documents`` is the number of documents it was fitted on.
    """

    terms: tuple[tuple[str, int, float], ...]
    documents: int

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """(idx, term, df, idf)."""
        rows = [(i, *entry) for i, entry in enumerate(self.terms)]
        return spark.createDataFrame(rows, "idx int, term string, df bigint, idf double")

    @cached_property
    def pipeline(self) -> PipelineModel:
        session = SparkSession.active().sparkContext.applicationId
        return _pipeline(session, tuple(t for t, _, _ in self.terms), tuple(w for _, _, w in self.terms))

    def vectors(self, docs: DataFrame) -> DataFrame:
        """``docs`` without its text, with vectors ``tf`` and ``tfidf``; a narrow step."""
        kept = [c for c in docs.columns if c != "text"]
        return self.pipeline.transform(docs).select(*kept, "tf", "tfidf")

    def weights(self, docs: DataFrame) -> DataFrame:
        """Long form: ids of ``docs``, idx, term, c, norm, tf, idf, w; a narrow step.

        The vocabulary is model state of bounded size, hence the broadcast.
        """
        ids = [c for c in docs.columns if c != "text"]
        counted = (
            docs.select(*ids, tokens("text").alias("tokens"))
            .select(*ids, token_runs("tokens").alias("runs"))
            .select(*ids, "runs", runs_norm("runs").alias("norm"))
            .select(*ids, "norm", F.explode_outer("runs").alias("run"))
            .select(*ids, "run.term", "run.c", "norm")
        )
        known = F.broadcast(self.vocabulary(docs.sparkSession))
        tf = F.col("c") / F.col("norm")
        return counted.join(known, "term").select(
            *ids, "idx", "term", "c", "norm", tf.alias("tf"), "idf", (tf * F.col("idf")).alias("w")
        )


@lru_cache(maxsize=4)
def _pipeline(session: str, terms: tuple[str, ...], idf: tuple[float, ...]) -> PipelineModel:
    """text -> tokens -> counts -> counts / norm (``tf``) -> tf x idf (``tfidf``).

    The norm counts every token, also those outside the vocabulary, so it
    scales the count vector as a column of its own. Kept per session because
    handing a large vocabulary to the JVM takes seconds.
    """
    scale = f"coalesce(try_divide(1D, {norm_sql('_tokens')}), 0D)"
    return PipelineModel(
        stages=[
            SQLTransformer(statement=f"SELECT *, {tokens_sql('text')} AS _tokens FROM __THIS__"),
            SQLTransformer(statement=f"SELECT *, {scale} AS _scale FROM __THIS__"),
            CountVectorizerModel.from_vocabulary(
                list(terms), inputCol="_tokens", outputCol="_counts"
            ),
            Interaction(inputCols=["_scale", "_counts"], outputCol="tf"),
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="tfidf"),
        ]
    )


def fit_weighting(
    docs: DataFrame, vocabulary: DataFrame | None = None, size: int = VOCABULARY_SIZE
) -> Weighting:
    """Weighting of docs(doc_id, text) over a vocabulary(term), derived when not given."""
    return weighting_of(document_frequency(docs), vocabulary, size)


def weighting_of(
    frequencies: DataFrame, vocabulary: DataFrame | None = None, size: int = VOCABULARY_SIZE
) -> Weighting:
    """Weighting from document frequencies, in one pass over them.

    The empty term, which has the number of documents, sorts in front of all
    others. The vocabulary becomes model state, held by the driver and every
    task, so more than ``MOST_TERMS`` terms are refused.
    """
    if vocabulary is None:
        known = frequencies.orderBy(F.desc("df"), "term").limit(size + 1)
    else:
        listed = vocabulary.select("term")
        every = listed.sparkSession.createDataFrame([(EVERY_DOCUMENT,)], "term string")
        known = listed.unionByName(every).join(frequencies, "term", "left")
    rows = known.limit(MOST_TERMS + 2).collect()  # the terms and the empty one, or one more
    if len(rows) > MOST_TERMS + 1:
        raise ValueError(f"a vocabulary of over {MOST_TERMS} terms is too large for one model")
    found = {row.term: row.df or 0 for row in rows}
    documents = found.pop(EVERY_DOCUMENT, 0)
    return Weighting(
        tuple((t, df, log((documents + 1) / (df + 1))) for t, df in sorted(found.items())), documents
    )


def coordinates(column: str) -> tuple[Column, Column]:
    """Index and value arrays of a vector column.

    A vector with few zeros is kept dense, without indices.
    """
    inside = F.unwrap_udt(column)
    values = inside["values"]
    dense = F.sequence(F.lit(0), F.size(values) - 1)
    return F.when(inside["indices"].isNull(), dense).otherwise(inside["indices"]), values


def entries(vectors: DataFrame, column: str, *ids: str) -> DataFrame:
    """Long form of a vector column: (ids..., idx, value) for entries that are not zero."""
    indices, values = coordinates(column)
    pairs = F.arrays_zip(indices.alias("i"), values.alias("v"))
    exploded = vectors.select(*ids, F.explode_outer(pairs).alias("e")).filter("e.v <> 0")
    return exploded.select(*ids, F.col("e.i").alias("idx"), F.col("e.v").alias("value"))
