"""Word lists: lines of text through the tokenizer."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusloom.functions import fixed_values as fixed
from corpusloom.functions.text import tokens


def words_of(lines: DataFrame, text: str = "value") -> DataFrame:
    """Distinct terms of lines of text."""
    return lines.select(F.explode_outer(tokens(text)).alias("term")).filter("term IS NOT NULL").distinct()


def read_word_list(spark: SparkSession, path) -> DataFrame:
    return words_of(spark.read.text(path))


def read_ordered_word_list(spark: SparkSession, path, size: int = fixed.VOCABULARY_SIZE) -> DataFrame:
    """(term, pos): the first ``size`` words of vocabulary files, best first, each with its first place.

    The files follow each other in order of their names. A repeated word counts
    for ``size`` each time and is listed once. A vocabulary file is a hand-kept
    list of words, so it is read as one record and its order is the order in
    the file; the window holds one number per file.
    """
    whole = spark.read.text(path, wholetext=True)
    files = whole.select(F.col("_metadata.file_path").alias("file"), tokens("value").alias("terms"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counts = files.select("file", F.size("terms").cast("bigint").alias("n"))
    starts = counts.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = files.join(starts, "file").select("before", F.posexplode("terms").alias("at", "term"))
    placed = placed.select("term", (F.col("before") + F.col("at")).alias("pos"))
    return placed.filter(F.col("pos") < size).groupBy("term").agg(F.min("pos").alias("pos"))


def excluded_words(spark: SparkSession) -> DataFrame:
    return words_of(spark.createDataFrame([(w,) for w in fixed.EXCLUDED_WORDS], "value string"))


def filter_words(spark: SparkSession) -> DataFrame:
    return words_of(spark.createDataFrame([(w,) for w in fixed.FILTER_WORD_LINES], "value string"))


def language_names(spark: SparkSession) -> DataFrame:
    """(lang, name) of every known language code."""
    return spark.createDataFrame(fixed.LANGUAGE_NAMES, "lang string, name string")
