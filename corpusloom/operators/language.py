"""Language detection, language counts, market share and its trend."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, IndexToString, SQLTransformer, StringIndexerModel
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.functions.fixed_values import TOP_LANGUAGES
from corpusloom.functions.text import language_window_sql, trigrams_sql
from corpusloom.session import stored

# Labelled documents a model is fitted on, the first by a hash of their text. All
# their trigrams are kept, and their number bounds the model.
FIT_DOCUMENTS = 20_000
FIT_PARTITIONS = 16


def fit_language_model(labelled: DataFrame, documents: int = FIT_DOCUMENTS) -> PipelineModel:
    """Multinomial naive Bayes over all character trigrams of at most ``documents`` rows of labelled(text, lang).

    Returns a Spark ML pipeline: it saves, loads and scores inside the row, so
    labelling a corpus moves no text between machines.
    """
    split = SQLTransformer(
        statement=f"SELECT *, {trigrams_sql(language_window_sql('text'))} AS trigrams FROM __THIS__"
    )
    windows = labelled.filter("lang IS NOT NULL").select(
        F.md5("text").alias("digest"), F.expr(language_window_sql("text")).alias("text"), "lang"
    )
    chosen = stored(windows.orderBy("digest", "lang").limit(documents).select("text", "lang"), "labelled")
    grams = stored(split.transform(chosen.repartition(FIT_PARTITIONS)), "labelled-trigrams")
    kept = grams.select(F.explode_outer("trigrams").alias("gram")).filter("gram IS NOT NULL").distinct()
    vocabulary = sorted(row.gram for row in kept.collect())
    labels = sorted(row.lang for row in grams.select("lang").distinct().collect())
    counts = CountVectorizerModel.from_vocabulary(
        vocabulary, inputCol="trigrams", outputCol="trigram_counts"
    )
    indexer = StringIndexerModel.from_labels(labels, inputCol="lang", outputCol="label")
    bayes = NaiveBayes(
        smoothing=1.0,
        featuresCol="trigram_counts",
        labelCol="label",
        predictionCol="lang_index",
        rawPredictionCol="",
        probabilityCol="",
    ).fit(indexer.transform(counts.transform(grams)))
    names = IndexToString(inputCol="lang_index", outputCol="predicted", labels=labels)
    return PipelineModel(stages=[split, counts, bayes, names])


def label_language(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """``docs`` with the column ``predicted``; a narrow step."""
    return model.transform(docs).select(*docs.columns, "predicted")


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts of (lang, predicted)."""
    return predictions.groupBy("lang", "predicted").agg(F.count(F.lit(1)).alias("n"))


def language_counts(docs: DataFrame, *by: str) -> DataFrame:
    """Documents per language, optionally per crawl period or job as well."""
    return docs.groupBy(*by, "lang").agg(F.count(F.lit(1)).alias("n"))


def named_counts(counts: DataFrame, names: DataFrame, *by: str) -> DataFrame:
    """Counts by language name. Unknown codes are dropped, shared names summed.

    ``names`` is the fixed table of codes, 185 rows, hence the broadcast.
    """
    return (
        counts.join(F.broadcast(names), "lang")
        .groupBy(*by, F.col("name").alias("lang"))
        .agg(F.sum("n").alias("n"))
    )


def job_months(files: DataFrame) -> DataFrame:
    """(job_id, year_month): one crawl month for each job of files(year_month, file_path, job_id).

    A job over several months counts for the one that most of its files are
    of, the earlier of equals, so its documents are counted once. Files without
    a job or month, and job 0, which holds no results, are left out.
    """
    taken = files.filter((F.col("job_id") != 0) & F.col("year_month").isNotNull())
    months = taken.groupBy("job_id", "year_month").agg(F.count(F.lit(1)).alias("files"))
    most = F.min(F.struct(-F.col("files"), "year_month"))["year_month"]
    return months.groupBy("job_id").agg(most.alias("year_month"))


def monthly_counts(job_languages: DataFrame, files: DataFrame) -> DataFrame:
    """(year_month, lang, n): stored counts of all jobs, job_languages(job_id, lang, count), by crawl month.

    The join has one row per job on one side, however many files a job has.
    Jobs without a file in ``files`` have no month and are left out.
    """
    dated = job_languages.join(job_months(files), "job_id")
    return dated.groupBy("year_month", "lang").agg(F.sum("count").alias("n"))


def market_share(counts: DataFrame, period: str = "period", top: int = TOP_LANGUAGES) -> DataFrame:
    """The ``top`` languages of each period by share of documents.

    Works on counts, so a window holds at most one row per language.
    """
    whole = Window.partitionBy(period)
    ranked = whole.orderBy(F.desc("n"), "lang")
    return (
        counts.withColumn("share", F.col("n") / F.sum("n").over(whole))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= top)
    )


def share_trend(counts: DataFrame, period: str = "period") -> DataFrame:
    """Share of every language in every period and its change since the last one.

    A language that is absent from a period has share 0 there: the pivot has
    a column per language (at most 185), and turning it back fills the gaps.
    Languages and periods are few, so each language's periods fit one window.
    The few counts are stored first, as the languages and the pivot both need them.
    """
    counts = stored(counts, "language-counts")
    known = sorted(row.lang for row in counts.select("lang").distinct().collect() if row.lang is not None)
    by_period = counts.groupBy(period).pivot("lang", known).agg(F.sum("n")).fillna(0)
    languages = [c for c in by_period.columns if c != period]
    total = sum((F.col(f"`{c}`") for c in languages), F.lit(0))
    shares = by_period.select(period, *[(F.col(f"`{c}`") / total).alias(c) for c in languages])
    filled = shares.unpivot(period, [f"`{c}`" for c in languages], "lang", "share")
    over_time = Window.partitionBy("lang").orderBy(period)
    return filled.withColumn("change", F.col("share") - F.lag("share").over(over_time))
