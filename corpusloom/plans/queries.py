"""Registered queries, one per operator: (spark, folder) -> DataFrame.

Each reads whole tables. Integers are widened and doubles rounded to 6 places
so that results compare with an independent SQL engine.
"""

from dataclasses import dataclass
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions import text
from corpusloom.functions.fixed_values import FILTER_WORD_LINES
from corpusloom.operators import clusters, documents, graph, language, modularity, reports, vocabulary, weights
from corpusloom.plans import inputs
from corpusloom.plans.clustering_run import save_model, score_documents
from corpusloom.plans.inputs import english, table, texts
from corpusloom.session import Shelf, freed_shuffles, scratch_path, stored
from corpusloom.sources import backlog, crawl_text, result_tables, word_lists

QUERIES = {}
EXCLUDED_HEAD = 186
FIT_PARTITIONS = 16
FIT_ROWS = 50_000
MONTH = "2015-05"
SAMPLE_PATHS = 4
# What the keys of result tables are made of in the key check.
KEY_GROUPS = {
    "job": "source",
    "job_languages": "concat(source, lang)",
    "job_clusters": "concat(lang, n_chars % 7)",
    "cluster_keywords": "n_chars",
    "cluster_topdocs": "substring(text, 1, 12)",
    "job_errors": "doc_id",
    "file_paths": "text",
}
JOB = 1


def query(name):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(spark, folder))

        QUERIES[name] = run
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind == "int":
            column = column.cast("bigint")
        elif kind == "double":
            column = F.round(column, 6) + F.lit(0.0)
        elif kind in ("timestamp", "timestamp_ntz"):
            if kind == "timestamp":
                column = F.to_utc_timestamp(column, F.current_timezone())
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Sources and sinks


@query("S1_crawl_documents")
def crawl_documents(spark, folder):
    path = scratch_path(spark, "crawl")
    records = inputs.raw_records(spark, folder).select("value")
    records.write.option("compression", "gzip").text(path)
    return crawl_text.read_documents(spark, path).select(
        "doc_id", "uri", "warc_date", "content_type", "text"
    )


@query("S2_record_fields")
def record_fields(spark, folder):
    parsed = crawl_text.parse_records(inputs.raw_records(spark, folder))
    return parsed.select("record_id", "file", "uri", "warc_date", "content_type", "text")


@query("S3_plain_text_records")
def plain_text_records(spark, folder):
    parsed = crawl_text.parse_records(inputs.raw_records(spark, folder))
    return crawl_text.plain_text(parsed).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


@query("S4_word_list")
def word_list(spark, folder):
    return word_lists.words_of(table(spark, folder, "benchmark"), "text")


@query("S5_backlog_new")
def backlog_new(spark, folder):
    paths = inputs.file_paths(spark, folder)
    fresh = backlog.new_paths(paths.filter("job_id IS NOT NULL"), paths)
    return fresh.select("year_month", "file_path")


@query("S6_backlog_sample")
def backlog_sample(spark, folder):
    return backlog.sample_unclaimed(inputs.file_paths(spark, folder), MONTH, SAMPLE_PATHS)


@query("S7_backlog_claim")
def backlog_claim(spark, folder):
    """Every month's claims kept as its newest version and read back."""
    paths, root = stored(inputs.file_paths(spark, folder), "backlog"), scratch_path(spark, "backlog")
    claimed = stored(backlog.claim(paths, inputs.claims(spark, folder)), "claimed")
    for row in claimed.select("year_month").distinct().collect():  # twelve months
        backlog.save_version(paths, root, row.year_month)
        backlog.save_version(claimed, root, row.year_month)
    return backlog.latest(spark, root).select("year_month", "file_path", "job_id")


@query("J8_claimed_by_job")
def claimed_by_job(spark, folder):
    claimed = backlog.claim(inputs.file_paths(spark, folder), inputs.claims(spark, folder))
    return claimed.groupBy("year_month", "job_id").agg(F.count(F.lit(1)).alias("n"))


def named_languages(spark, folder):
    docs = inputs.periods(spark, folder).withColumnRenamed("period", "job_id")
    counts = language.language_counts(docs, "job_id")
    return language.named_counts(counts, word_lists.language_names(spark), "job_id")


def written(spark, frame, name):
    """A result table after a write and a read."""
    root = scratch_path(spark, "results")
    result_tables.store(frame, root, name)
    return result_tables.load(spark, root, name)


@query("S8_job_languages")
def job_languages(spark, folder):
    rows = named_languages(spark, folder).withColumnRenamed("n", "count")
    return written(spark, rows, "job_languages").select("job_id", "lang", "count")


@query("S12_run_ledger")
def run_ledger(spark, folder):
    return result_tables.fold_run_events(inputs.run_events(spark, folder))


@query("S13_key_violations")
def key_violations(spark, folder):
    """Every result table's key check, on tables whose keys come from documents and repeat."""
    docs = table(spark, folder, "documents")
    found = None
    for name, key in result_tables.KEYS.items():
        group = F.expr(KEY_GROUPS[name])
        rows = docs.select(*(F.hash(F.lit(c), group).alias(c) if i else group.alias(c) for i, c in enumerate(key)))
        own = result_tables.key_violations(rows, key).agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")
        )
        found = own if found is None else found.unionByName(own)
    return found


# Filters and projections


@query("F1_english_documents")
def english_documents(spark, folder):
    docs = table(spark, folder, "documents")
    return documents.in_language(docs, "en").select("doc_id", "lang", "n_chars")


@query("F2_keyword_documents")
def keyword_documents(spark, folder):
    """A selective list: long benchmark words with a dot or a hyphen."""
    words = word_lists.words_of(table(spark, folder, "benchmark"), "text")
    chosen = words.filter((F.length("term") > 5) & (F.col("term").contains(".") | F.col("term").contains("-")))
    return documents.with_keywords(texts(spark, folder), chosen).select("doc_id")


@query("F2_shipped_filter_list")
def shipped_filter_list(spark, folder):
    """Every third document ends with a line of the shipped list."""
    lines = F.array(*(F.lit(line) for line in FILTER_WORD_LINES))
    line = F.get(lines, F.col("doc_id") % len(FILTER_WORD_LINES))
    ended = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" "), line)).otherwise(F.col("text"))
    docs = texts(spark, folder).withColumn("text", ended)
    found = documents.with_keywords(docs, word_lists.filter_words(spark), min_hits=1)
    terms = F.array(*(F.lit(r.term) for r in word_lists.filter_words(spark).collect()))
    hits = F.filter(text.tokens("text"), lambda t: F.array_contains(terms, t))
    return found.select("doc_id", F.size(hits).alias("hits"))


@query("J4_shipped_exclude_list")
def shipped_exclude_list(spark, folder):
    """Terms of at least five pages without the words of the shipped exclude list."""
    pages = table(spark, folder, "pages").select("page_id", F.explode(text.tokens("html")).alias("term"))
    counts = pages.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5")
    return counts.join(F.broadcast(word_lists.excluded_words(spark)), "term", "left_anti")  # a fixed list


@query("F3_document_texts")
def document_texts(spark, folder):
    return english(spark, folder).select("text")


@query("F4_backlog_unclaimed")
def backlog_unclaimed(spark, folder):
    return backlog.unclaimed(inputs.file_paths(spark, folder), MONTH).select("year_month", "file_path")


@query("F5_job_rows")
def job_rows(spark, folder):
    rows = named_languages(spark, folder)
    return result_tables.of_job(rows, JOB)


@query("F6_languages_present")
def languages_present(spark, folder):
    return language.language_counts(table(spark, folder, "documents")).filter("n > 0").select("lang")


@query("F7_sampled_documents")
def sampled_documents(spark, folder):
    return documents.sample_documents(table(spark, folder, "documents"), 100).select("doc_id", "lang")


# Text functions


@query("P1_language_window")
def language_window(spark, folder):
    docs = texts(spark, folder)
    return docs.select("doc_id", text.language_window("text").alias("window"))


@query("P2_tokens")
def document_tokens(spark, folder):
    docs = texts(spark, folder)
    exploded = docs.select("doc_id", F.posexplode_outer(text.tokens("text")).alias("pos", "term"))
    return exploded.filter("pos IS NOT NULL")


@query("P3_stop_words_removed")
def stop_words_removed(spark, folder):
    before, after = F.expr(text.raw_tokens_sql("text")), text.tokens("text")
    return texts(spark, folder).select(
        "doc_id", (F.size(before) - F.size(after)).alias("removed"), F.size(after).alias("kept")
    )


@query("P4_content_type")
def content_types(spark, folder):
    records = inputs.raw_records(spark, folder)
    headers = F.substring_index("value", "\n\n", 1)
    return records.select(text.content_type(headers).alias("content_type")).groupBy("content_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("P5_lower_vocabulary")
def lower_vocabulary(spark, folder):
    words = table(spark, folder, "benchmark").select(
        F.explode(F.expr("regexp_extract_all(text, '[A-Za-z]{3,}', 0)")).alias("term")
    )
    return vocabulary.combine_words(words)


@query("P6_array_text")
def array_text(spark, folder):
    decoded = text.decode_array_text(
        F.concat(F.lit("{"), F.translate("url", ":/", ",,"), F.lit("}"))
    )
    return table(spark, folder, "pages").select("page_id", F.posexplode(decoded).alias("pos", "entry"))


# Languages


@query("L1_language_predict")
def language_predict(spark, folder):
    docs = texts(spark, folder)
    model = language.fit_language_model(docs)
    return language.label_language(docs, model).select("doc_id", "lang", "predicted")


@query("L2_language_confusion")
def language_confusion(spark, folder):
    """Fitted on even keys, counted on odd ones."""
    docs = texts(spark, folder)
    model = language.fit_language_model(docs.filter("doc_id % 2 = 0"))
    return language.confusion(language.label_language(docs.filter("doc_id % 2 = 1"), model))


@query("J1_language_names")
def language_names(spark, folder):
    counts = language.language_counts(table(spark, folder, "documents"))
    return language.named_counts(counts, word_lists.language_names(spark))


@query("A1_language_counts")
def language_counts(spark, folder):
    return language.language_counts(table(spark, folder, "documents"))


@query("R1_language_share_top10")
def language_share(spark, folder):
    return language.market_share(language.language_counts(inputs.periods(spark, folder), "period"))


@query("R2_language_share_trend")
def language_trend(spark, folder):
    return language.share_trend(language.language_counts(inputs.periods(spark, folder), "period"))


def monthly_counts(spark, folder):
    """Counts of languages by crawl month, from the stored tables of several jobs."""
    rows = written(spark, named_languages(spark, folder).withColumnRenamed("n", "count"), "job_languages")
    return language.monthly_counts(rows, stored(inputs.job_files(spark, folder), "file-paths"))


@query("R1_monthly_share_top10")
def monthly_share(spark, folder):
    return language.market_share(monthly_counts(spark, folder), "year_month")


@query("R2_monthly_share_trend")
def monthly_trend(spark, folder):
    return language.share_trend(monthly_counts(spark, folder), "year_month")


# Vocabulary and weights


def benchmark_words(spark, folder):
    return word_lists.words_of(table(spark, folder, "benchmark"), "text")


def noise_words(spark, folder):
    """The most frequent words of conversations, as an exclude list."""
    turns = table(spark, folder, "conversations")
    return vocabulary.frequent_terms(vocabulary.document_frequency(turns), EXCLUDED_HEAD)


def base_vocabulary(spark, folder):
    return vocabulary.frequent_terms(vocabulary.document_frequency(english(spark, folder)))


@query("K5_vocabulary_head")
def vocabulary_head(spark, folder):
    return base_vocabulary(spark, folder)


@query("K6_vocabulary_order")
def vocabulary_order(spark, folder):
    return vocabulary.positions(base_vocabulary(spark, folder)).select("idx", "term")


@query("U1_vocabulary_union")
def vocabulary_union(spark, folder):
    return vocabulary.combine_words(base_vocabulary(spark, folder), benchmark_words(spark, folder))


@query("U2_vocabulary_distinct")
def vocabulary_distinct(spark, folder):
    return word_lists.words_of(table(spark, folder, "conversations"), "text")


@query("U3_vocabulary_final")
def vocabulary_final(spark, folder):
    terms = vocabulary.combine_words(
        base_vocabulary(spark, folder), benchmark_words(spark, folder), noise_words(spark, folder)
    )
    return vocabulary.positions(terms).select("idx", "term")


@query("J4_vocabulary_minus_excluded")
def vocabulary_minus_excluded(spark, folder):
    return vocabulary.combine_words(
        base_vocabulary(spark, folder), excluded=noise_words(spark, folder)
    )


@query("A2_corpus_size")
def corpus_size(spark, folder):
    return english(spark, folder).agg(F.count(F.lit(1)).alias("documents"))


@query("A3_term_counts")
def term_counts(spark, folder):
    return weights.term_counts(texts(spark, folder))


@query("A4_document_norms")
def document_norms(spark, folder):
    return weights.document_norms(texts(spark, folder))


@query("A5_idf")
def idf(spark, folder):
    fitted = weights.fit_weighting(english(spark, folder))
    return fitted.vocabulary(spark).select("term", "df", "idf")


@query("J3_vocabulary_terms")
def vocabulary_terms(spark, folder):
    docs = english(spark, folder)
    return weights.fit_weighting(docs).weights(docs).select("doc_id", "idx", "term", "c")


@query("M1_term_frequency")
def term_frequency(spark, folder):
    docs = english(spark, folder)
    return weights.fit_weighting(docs).weights(docs).select("doc_id", "term", "tf")


@query("M2_tfidf")
def tfidf(spark, folder):
    docs = english(spark, folder)
    return weights.fit_weighting(docs).weights(docs).select("doc_id", "term", "w")


@query("J2_document_vectors")
def document_vectors(spark, folder):
    """Documents beside their vectors: number and sum of the entries."""
    docs = english(spark, folder)
    fitted = weights.fit_weighting(docs)
    values = F.filter(weights.coordinates("tfidf")[1], lambda v: v != 0)
    beside = fitted.vectors(docs.withColumn("n_chars", F.length("text")))
    return beside.select(
        "doc_id",
        "n_chars",
        F.size(values).alias("entries"),
        F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("total"),
    )


# Clusters


@dataclass
class Clustering:
    """One Lloyd step from the first k documents, then the final assignment."""

    docs: DataFrame
    fitted: weights.Weighting
    vectors: DataFrame
    k: int
    first: DataFrame

    @cached_property
    def centers(self) -> DataFrame:
        return stored(clusters.centroids(self.first, "kept"), "centers")

    @cached_property
    def assignment(self) -> DataFrame:
        return stored(self.nearest(self.vectors), "assignment")

    def nearest(self, vectors: DataFrame) -> DataFrame:
        return clusters.nearest_center(vectors, self.centers, self.k, len(self.fitted.terms))

    @property
    def vocabulary(self) -> DataFrame:
        return self.fitted.vocabulary(self.docs.sparkSession)

    @property
    def keywords(self) -> DataFrame:
        return clusters.cluster_keywords(self.centers, self.vocabulary)

    @property
    def sizes(self) -> DataFrame:
        return clusters.cluster_sizes(self.assignment, self.k)

    @property
    def topdocs(self) -> DataFrame:
        return clusters.with_text(clusters.top_documents(self.assignment), self.docs)


def clustering(spark, folder) -> Clustering:
    docs = english(spark, folder)
    fitted = weights.fit_weighting(docs)
    vectors = stored(fitted.vectors(docs).select("doc_id", "tfidf"), "vectors")
    k = clusters.cluster_count(fitted.documents)
    first = clusters.nearest_center(
        vectors.withColumn("kept", F.col("tfidf")),
        clusters.seed_centers(vectors, k), k, len(fitted.terms),
    )
    return Clustering(docs, fitted, vectors, k, first)


@query("M3_cluster_count")
def cluster_count(spark, folder):
    counted = table(spark, folder, "documents").filter("lang = 'en'").agg(F.count(F.lit(1)).alias("documents"))
    return counted.select("documents", clusters.cluster_count_column("documents").alias("k"))


@query("M4_kmeans_fit")
def kmeans_fit(spark, folder):
    """What holds for any fit: k clusters hold all documents, each is nearest to its own center
    (the cost is that of the best assignment), and one more step lowers the cost by under 2%."""
    docs = english(spark, folder)
    fitted = weights.fit_weighting(docs)
    vectors = stored(fitted.vectors(docs).select("doc_id", "tfidf"), "vectors")
    k, terms = clusters.cluster_count(fitted.documents), len(fitted.terms)
    model = clusters.fit_kmeans(vectors, k, partitions=max(FIT_PARTITIONS, fitted.documents // FIT_ROWS))
    own = model.transform(vectors).select("doc_id", "tfidf", F.col("prediction").alias("own"))
    at = clusters.nearest_center(own.withColumn("kept", F.col("tfidf")), clusters.model_centers(spark, model), k, terms)
    at = stored(at, "assigned")
    sizes = clusters.cluster_sizes(at.select("doc_id", "cluster_id"), k)
    step = stored(clusters.centroids(at, "kept"), "centers")
    after = clusters.nearest_center(vectors, step, k, terms).agg(F.sum("d2").alias("cost")).first().cost
    same = F.col("own") == F.col("cluster_id")
    totals = at.agg(F.sum("d2").alias("cost"), F.sum((~same).cast("bigint")).alias("misplaced")).first()
    return sizes.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("num_docs").alias("documents"),
        F.lit(totals.misplaced).alias("misplaced"),
        F.lit(after >= 0.98 * totals.cost).alias("settled"),
    )


@query("M5_lloyd_step")
def lloyd_step(spark, folder):
    return clustering(spark, folder).first.select("doc_id", "cluster_id", "d2")


@query("A8_centroids")
def centroids(spark, folder):
    run = clustering(spark, folder)
    return run.centers.join(F.broadcast(run.vocabulary), "idx").select("cluster_id", "term", "w")


@query("M6_assignment")
def assignment(spark, folder):
    return clustering(spark, folder).assignment.select("doc_id", "cluster_id", "d2")


@query("M7_cosine")
def cosine(spark, folder):
    return clustering(spark, folder).assignment.select("doc_id", "cluster_id", "cos_sim")


@query("M8_fold_in")
def fold_in(spark, folder):
    """Conversation turns scored against the clusters of the English documents."""
    run = clustering(spark, folder)
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return run.nearest(run.fitted.vectors(turns))


@query("M8_saved_model")
def saved_model(spark, folder):
    """The same from the model's tables, as a later session would read them."""
    run, root = clustering(spark, folder), scratch_path(spark, "results")
    save_model(run.fitted, run.centers, run.k, root, JOB)
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return score_documents(spark, root, JOB, turns)


@query("A6_cluster_sizes")
def cluster_sizes(spark, folder):
    return clustering(spark, folder).sizes


@query("A7_top_documents")
def top_documents(spark, folder):
    return clusters.top_documents(clustering(spark, folder).assignment)


@query("K1_cluster_keywords")
def cluster_keywords(spark, folder):
    return clustering(spark, folder).keywords


@query("K2_largest_clusters")
def largest_clusters(spark, folder):
    return clusters.largest_clusters(clustering(spark, folder).sizes)


@query("J5_largest_with_topdocs")
def largest_with_topdocs(spark, folder):
    run = clustering(spark, folder)
    largest = clusters.largest_clusters(run.sizes)
    return largest.join(clusters.top_documents(run.assignment), "cluster_id").select(
        "cluster_id", "num_docs", "doc_id"
    )


@query("S9_job_clusters")
def job_clusters(spark, folder):
    return stored_clusters(spark, clustering(spark, folder)).select("job_id", "cluster_id", "num_docs")


def stored_clusters(spark, run):
    rows = run.sizes.withColumn("cluster_label", F.lit(None).cast("string"))
    return written(spark, rows.withColumn("job_id", F.lit(JOB)), "job_clusters")


def stored_keywords(spark, run):
    rows = reports.keyword_lists(run.keywords).withColumn("job_id", F.lit(JOB))
    return written(spark, rows, "cluster_keywords")


def stored_topdocs(spark, run):
    rows = reports.ordered_top_documents(run.topdocs, clusters.largest_clusters(run.sizes))
    return written(spark, rows.withColumn("job_id", F.lit(JOB)), "cluster_topdocs")


@query("S10_cluster_keywords_table")
def cluster_keywords_table(spark, folder):
    stored = stored_keywords(spark, clustering(spark, folder))
    lists = F.arrays_zip("keywords", "keyword_weights")
    return stored.select("job_id", "cluster_id", F.posexplode(lists).alias("pos", "e")).select(
        "job_id", "cluster_id", "pos", F.col("e.keywords").alias("term"), F.col("e.keyword_weights").alias("weight")
    )


@query("S11_cluster_topdocs_table")
def cluster_topdocs_table(spark, folder):
    stored = stored_topdocs(spark, clustering(spark, folder))
    return stored.select("job_id", "cluster_id", "doc_order_id", "doc_id", "cos_sim", "text")


@query("K3_report_keywords")
def report_keywords(spark, folder):
    run = clustering(spark, folder)
    report = reports.report_keywords(stored_clusters(spark, run), stored_keywords(spark, run), JOB)
    return report.select(
        "cluster_id",
        "num_docs",
        F.array_join("keywords", ",").alias("keywords"),
        F.get("keyword_weights", F.lit(0)).alias("top_weight"),
    )


@query("J6_clusters_with_keywords")
def clusters_with_keywords(spark, folder):
    run = clustering(spark, folder)
    joined = stored_clusters(spark, run).join(stored_keywords(spark, run), ["job_id", "cluster_id"])
    return joined.select("job_id", "cluster_id", "num_docs", F.size("keywords").alias("n_keywords"))


@query("K4_report_topdocs")
def report_topdocs(spark, folder):
    run = clustering(spark, folder)
    return reports.report_topdocs(stored_clusters(spark, run), stored_topdocs(spark, run), JOB)


@query("J7_clusters_with_topdocs")
def clusters_with_topdocs(spark, folder):
    run = clustering(spark, folder)
    first = stored_topdocs(spark, run).filter("doc_order_id = 0")
    joined = stored_clusters(spark, run).join(first, ["job_id", "cluster_id"])
    return joined.select("job_id", "cluster_id", "num_docs", "doc_id")


# Cluster graph


@query("R3_cluster_jaccard")
def cluster_jaccard(spark, folder):
    return graph.jaccard_edges(clustering(spark, folder).keywords)


def document_edges(spark, folder):
    """Documents and vocabulary terms as one graph: an edge per weight.

    Documents keep their id, terms count down from -1.
    """
    docs = english(spark, folder)
    with freed_shuffles(spark):
        fitted = weights.fit_weighting(docs)
    rows = fitted.weights(docs).filter("w > 0")
    return rows.select(
        F.col("doc_id").alias("src"),
        (F.lit(-1) - F.col("idx")).cast("bigint").alias("dst"),
        F.col("w").alias("weight"),
    )


@query("R4_cluster_communities")
def cluster_communities(spark, folder):
    return graph.communities(graph.jaccard_edges(clustering(spark, folder).keywords))


@query("R4_document_communities")
def document_communities(spark, folder):
    shelf = Shelf(spark)
    found = graph.communities(shelf.put("edges", document_edges(spark, folder)))
    shelf.drop("edges")
    return found


@query("R5_modularity")
def propagated_modularity(spark, folder):
    edges = Shelf(spark).put("edges", document_edges(spark, folder))
    labels = graph.communities(edges)
    settled = labels.agg(F.min("converged")).first()[0]
    return graph.modularity(edges, labels).withColumn("converged", F.lit(settled))


@query("R4_modular_communities")
def modular_communities(spark, folder):
    """Communities by modularity of documents and terms: that levels rise and nest, and that their modularity is that of their labels."""
    edges = Shelf(spark).put("edges", document_edges(spark, folder))
    found = modularity.modular_communities(edges)
    values = [r.modularity for r in found.levels.orderBy("level").collect()]  # a row per level, at most 13
    checked = graph.modularity(edges, found.labels()).first()
    upper = found.path.select("node", (F.col("level") - 1).alias("level"), F.col("label").alias("above")).hint("merge")
    parents = found.path.join(upper, ["node", "level"]).groupBy("level", "label").agg(F.countDistinct("above").alias("n"))
    return edges.select(F.explode(F.array("src", "dst")).alias("node"), (F.col("weight") / 2).alias("weight")).agg(
        F.countDistinct("node").alias("nodes"),
        F.round(F.sum("weight"), 3).alias("weight"),
        F.lit(all(a < b for a, b in zip(values, values[1:])) and len(values) > 1).alias("rises"),
        F.lit(parents.filter("n > 1").isEmpty()).alias("nests"),
        F.lit(abs(checked.modularity - values[-1]) < 1e-9).alias("agrees"),
        F.lit(found.path.groupBy("level").count().select("count").distinct().count() == 1).alias("whole"),
    )


@query("R6_keyword_scale")
def keyword_scale(spark, folder):
    return graph.display_weights(clustering(spark, folder).keywords).select("cluster_id", "term", "scale")
