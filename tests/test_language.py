import pytest
from pyspark.sql import functions as F

from corpusloom.operators import language
from corpusloom.plans import inputs
from corpusloom.sources import word_lists


def test_model_labels_unseen_documents(spark, folder):
    docs = inputs.texts(spark, "/root/testdata/sf0.01")
    model = language.fit_language_model(docs.filter("doc_id % 2 = 0"))
    unseen = docs.filter("doc_id % 2 = 1")
    labelled = language.label_language(unseen, model)
    right = labelled.filter("lang = predicted").count()
    assert right / unseen.count() > 0.95
    table = language.confusion(labelled)
    assert table.agg(F.sum("n")).first()[0] == unseen.count()


def test_short_texts_fall_back_to_the_commonest_language(spark):
    train = spark.createDataFrame(
        [("the good day and the night", "en"), ("the other", "en"), ("el buen dia y la noche", "es")],
        "text string, lang string",
    )
    model = language.fit_language_model(train)
    texts = spark.createDataFrame([(1, ""), (2, "ab"), (3, "the day"), (4, "la noche")], "doc_id int, text string")
    got = {r.doc_id: r.predicted for r in language.label_language(texts, model).collect()}
    assert got == {1: "en", 2: "en", 3: "en", 4: "es"}


def test_model_is_saved_and_loaded(spark):
    from pyspark.ml import PipelineModel

    from corpusloom.session import scratch_path

    train = spark.createDataFrame([("the good day", "en"), ("el buen dia", "es")], "text string, lang string")
    path = scratch_path(spark, "model")
    language.fit_language_model(train).save(path)
    texts = spark.createDataFrame([(1, "buen dia")], "doc_id int, text string")
    assert language.label_language(texts, PipelineModel.load(path)).first().predicted == "es"


def test_unknown_codes_are_dropped_and_shared_names_summed(spark):
    counts = spark.createDataFrame(
        [("en", 5), ("Ga", 2), ("ka", 3), ("zz", 9)], "lang string, n bigint"
    )
    got = {r.lang: r.n for r in language.named_counts(counts, word_lists.language_names(spark)).collect()}
    assert got == {"English": 5, "Georgian": 5}


def test_trend_fills_absent_languages(spark):
    counts = spark.createDataFrame(
        [(1, "en", 3), (1, "fr", 1), (2, "en", 4), (3, "en", 1), (3, "fr", 1)],
        "period int, lang string, n bigint",
    )
    got = {(r.period, r.lang): (r.share, r.change) for r in language.share_trend(counts).collect()}
    assert got[(1, "fr")] == (0.25, None)
    assert got[(2, "fr")] == (0.0, -0.25)
    assert got[(3, "fr")] == (0.5, 0.5)
    assert len(got) == 6


def test_market_share_keeps_the_top(spark):
    rows = [(1, f"l{i:02}", 100 - i) for i in range(15)]
    got = language.market_share(spark.createDataFrame(rows, "period int, lang string, n bigint")).collect()
    assert sorted(r.rank for r in got) == list(range(1, 11))
    assert max(got, key=lambda r: r.share).lang == "l00"
    assert [r.share for r in got if r.lang == "l00"] == pytest.approx([100 / sum(range(86, 101))])


def test_months_of_jobs(spark):
    files = [("2015-02", 1)] * 3 + [("2015-01", 1)] * 2 + [("2015-03", 2), ("2015-02", 2), ("2015-01", 0), ("2015-01", None), (None, 3)]
    table = spark.createDataFrame([(m, f"f{i}", j) for i, (m, j) in enumerate(files)], "year_month string, file_path string, job_id int")
    assert {tuple(r) for r in language.job_months(table).collect()} == {(1, "2015-02"), (2, "2015-02")}
    stored = [(1, "English", 10), (1, "French", 2), (2, "English", 5), (3, "English", 100), (4, "French", 1), (0, "French", 1)]
    counts = language.monthly_counts(spark.createDataFrame(stored, "job_id long, lang string, count long"), table)
    assert {tuple(r) for r in counts.collect()} == {("2015-02", "English", 15), ("2015-02", "French", 2)}
    assert language.monthly_counts(spark.createDataFrame(stored, "job_id long, lang string, count long"), table.limit(0)).collect() == []
