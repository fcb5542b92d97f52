"""The whole clustering job: crawl documents in, result tables out.

Text is read twice after it has been labelled: once for document frequencies,
once for vectors. Everything later starts from stored tables.
"""

from urllib.parse import unquote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators import clusters, documents, language, reports, vocabulary
from corpusloom.operators.weights import Weighting, weighting_of
from corpusloom.session import stored
from corpusloom.sources import result_tables, word_lists


def label_corpus(
    docs: DataFrame, model: PipelineModel, lang: str, keywords: DataFrame | None = None
) -> DataFrame:
    """(doc_id, lang, text): docs(doc_id, text) labelled and stored once.

    Compressed crawl files, which do not split, are then read a single time.
    Only texts in ``lang`` that pass the keywords are kept, since nothing reads the others again.
    Counting languages reads one small column. Each task writes one file;
    a folder per language would take each task as many files as languages.
    """
    labelled = language.label_language(docs.select("doc_id", "text"), model)
    wanted = F.col("predicted") == lang
    if keywords is not None:
        wanted = wanted & documents.has_keywords(keywords)
    kept = F.when(wanted, F.col("text"))
    return stored(
        labelled.select("doc_id", F.col("predicted").alias("lang"), kept.alias("text")), "labelled"
    )


def store_languages(labelled: DataFrame, root: str, job_id: int) -> None:
    counts = language.language_counts(labelled)
    named = language.named_counts(counts, word_lists.language_names(labelled.sparkSession))
    rows = named.select(F.lit(job_id).alias("job_id"), "lang", F.col("n").alias("count"))
    result_tables.store(rows, root, "job_languages", [job_id])


def run_languages(docs: DataFrame, model: PipelineModel, root: str, job_id: int) -> None:
    """Count the languages of docs(doc_id, text) only; one pass over the text."""
    labelled = language.label_language(docs.select("doc_id", "text"), model)
    store_languages(labelled.withColumnRenamed("predicted", "lang"), root, job_id)


def job_vocabulary(
    frequencies: DataFrame, words: DataFrame | None, keywords: DataFrame | None
) -> DataFrame:
    """Terms of a run: listed or derived words, filter words, less web noise."""
    if words is not None:
        base = vocabulary.listed_terms(words)
    else:
        base = vocabulary.frequent_terms(frequencies)
    excluded = word_lists.excluded_words(frequencies.sparkSession)
    return vocabulary.combine_words(base, keywords, excluded)


def run_clustering(
    docs: DataFrame,
    model: PipelineModel,
    root: str,
    job_id: int,
    lang: str = "en",
    words: DataFrame | None = None,
    keywords: DataFrame | None = None,
    seed: int = 1,
    partitions: int | None = None,
) -> None:
    """Label, filter, weight and cluster docs(doc_id, text); store the result tables.

    ``words(term, pos)`` replaces the derived vocabulary; ``keywords(term)``
    restricts the run to documents with at least two hits and joins the
    vocabulary. ``partitions`` makes the fit independent of the file layout.
    """
    spark = docs.sparkSession
    labelled = label_corpus(docs, model, lang, keywords)
    store_languages(labelled, root, job_id)
    chosen = documents.in_language(labelled, lang).select(
        "doc_id", "text", F.col("_metadata.file_path").alias("file")
    )
    if keywords is not None:
        chosen = chosen.filter("text IS NOT NULL")

    frequencies = stored(vocabulary.document_frequency(chosen), "frequencies")
    weighting = weighting_of(frequencies, job_vocabulary(frequencies, words, keywords))
    vectors = stored(weighting.vectors(chosen).select("doc_id", "file", "tfidf"), "vectors")

    fitted = clusters.fit_kmeans(vectors, clusters.cluster_count(weighting.documents), seed, partitions)
    centers = stored(clusters.model_centers(spark, fitted), "centers")
    k = len(fitted.clusterCenters())
    assignment = stored(
        clusters.nearest_center(vectors, centers, k, len(weighting.terms)), "assignment"
    )
    store_clusters(assignment, centers, weighting.vocabulary(spark), k, root, job_id)
    save_model(weighting, centers, k, root, job_id)


def save_model(weighting: Weighting, centers: DataFrame, k: int, root: str, job_id: int) -> None:
    """A run's vocabulary with frequencies, its size and its centers, as tables by job."""
    spark = centers.sparkSession
    result_tables.store(weighting.vocabulary(spark).withColumn("job_id", F.lit(job_id)), root, "model_terms", [job_id])
    size = spark.createDataFrame([(job_id, weighting.documents, k)], "job_id int, documents bigint, k int")
    result_tables.store(size, root, "model_size", [job_id])
    result_tables.store(centers.withColumn("job_id", F.lit(job_id)), root, "model_centers", [job_id])


def score_documents(spark: SparkSession, root: str, job_id: int, docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with cluster_id, d2 and cos_sim under the saved model of a run, also of an earlier session."""

    def saved(name):
        return result_tables.load(spark, root, name).filter(F.col("job_id") == job_id)

    size = saved("model_size").first()
    if size is None:
        raise ValueError(f"no model of job {job_id}")
    rows = saved("model_terms").select("term", "df", "idf").orderBy("term").collect()  # the vocabulary of a run
    weighting = Weighting(tuple((r.term, r.df, r.idf) for r in rows), size.documents)
    centers = saved("model_centers").select("cluster_id", "idx", "w")
    return clusters.nearest_center(weighting.vectors(docs), centers, size.k, len(rows))


def store_clusters(
    assignment: DataFrame, centers: DataFrame, known: DataFrame, k: int, root: str, job_id: int
) -> None:
    """Sizes, keyword lists and top documents of a clustering."""

    def store(table, name):
        result_tables.store(table.withColumn("job_id", F.lit(job_id)), root, name, [job_id])

    sizes = clusters.cluster_sizes(assignment, k)
    store(sizes.withColumn("cluster_label", F.lit(None).cast("string")), "job_clusters")
    store(reports.keyword_lists(clusters.cluster_keywords(centers, known)), "cluster_keywords")
    top = stored(clusters.top_documents(assignment, "file"), "top")
    texts = clusters.with_text(top.drop("file"), files_of(top))
    store(reports.ordered_top_documents(texts, clusters.largest_clusters(sizes)), "cluster_topdocs")


def files_of(top: DataFrame) -> DataFrame:
    """Only the files that hold a top document: at most one per cluster."""
    files = [unquote(row.file) for row in top.select("file").distinct().collect()]
    return top.sparkSession.read.parquet(*files).select("doc_id", "text")
