import math
from collections import Counter

import pytest
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from corpusloom.operators import vocabulary, weights
from corpusloom.plans import inputs
from test_text import expected_tokens

TEXTS = {
    1: "apple banana apple cherry",
    2: "banana banana date",
    3: "the of and",
    4: "",
    5: "apple elderberry. fig-tree fig-tree",
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string")


def brute(terms):
    counts = {d: Counter(expected_tokens(t)) for d, t in TEXTS.items()}
    df = {t: sum(t in c for c in counts.values()) for t in terms}
    out = {}
    for d, c in counts.items():
        norm = math.sqrt(sum(v * v for v in c.values()))
        for t in terms:
            if t in c:
                idf = math.log((len(TEXTS) + 1) / (df[t] + 1))
                out[d, t] = (c[t] / norm, c[t] / norm * idf)
    return out


@pytest.mark.parametrize("given", [False, True])
def test_long_weights_and_vectors_agree_with_brute_force(spark, docs, given):
    terms = ["apple", "banana", "fig-tree", "nowhere"] if given else sorted(
        {t for x in TEXTS.values() for t in expected_tokens(x)}
    )
    listed = spark.createDataFrame([(t,) for t in terms], "term string") if given else None
    fitted = weights.fit_weighting(docs, listed)
    assert [t for t, _, _ in fitted.terms] == terms and fitted.documents == 5
    want = brute(terms)
    long = {(r.doc_id, r.term): (r.tf, r.w) for r in fitted.weights(docs).collect()}
    vectors = fitted.vectors(docs)
    assert vectors.count() == 5
    from_vectors = {
        (r.doc_id, terms[r.idx]): r.value for r in weights.entries(vectors, "tfidf", "doc_id").collect()
    }
    assert long.keys() == want.keys() == from_vectors.keys()
    for key, (tf, w) in want.items():
        assert long[key] == pytest.approx((tf, w))
        assert from_vectors[key] == pytest.approx(w)


def test_idf_equals_spark_ml(spark, folder):
    docs = inputs.english(spark, folder)
    fitted = weights.fit_weighting(docs)
    model = IDF(inputCol="tf", outputCol="x").fit(fitted.vectors(docs))
    assert model.numDocs == fitted.documents
    assert list(model.idf) == pytest.approx([w for _, _, w in fitted.terms], abs=1e-12)


def test_vocabulary_excludes_neighbouring_words(spark):
    def words(*ws):
        return spark.createDataFrame([(w,) for w in ws], "term string")

    got = vocabulary.combine_words(
        words("alpha", "Beta", "beta", "gamma", "delta", "no"), words("fig-tree", "alpha"), words("beta", "gamma", "delta")
    )
    assert sorted(r.term for r in got.collect()) == ["alpha", "fig-tree"]
    placed = {r.term: r.idx for r in vocabulary.positions(got).collect()}
    assert placed == {"alpha": 0, "fig-tree": 1}


def test_frequencies_count_documents(spark, docs):
    got = {r.term: r.df for r in vocabulary.document_frequency(docs).collect()}
    assert got.pop(vocabulary.EVERY_DOCUMENT) == len(TEXTS)
    assert got == {"apple": 2, "banana": 2, "cherry": 1, "date": 1, "elderberry.": 1, "fig-tree": 1}
    head = [r.term for r in vocabulary.frequent_terms(vocabulary.document_frequency(docs), 3).collect()]
    assert head == ["apple", "banana", "cherry"]


def test_text_work_is_not_repeated_or_shuffled(spark, docs):
    """One tokenizer call per row and no exchange in front of the vectors."""
    fitted = weights.fit_weighting(docs)
    plan = fitted.vectors(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Exchange" not in plan
    plan = weights.term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Exchange" not in plan


def test_vocabulary_too_large_for_a_model(spark, monkeypatch):
    monkeypatch.setattr(weights, "MOST_TERMS", 3)
    docs = spark.createDataFrame([(1, "apple pear"), (2, "apple fig plum")], "doc_id long, text string")
    three = spark.createDataFrame([("apple",), ("pear",), ("unseen",)], "term string")
    assert [e[:2] for e in weights.fit_weighting(docs, three).terms] == [("apple", 2), ("pear", 1), ("unseen", 0)]
    with pytest.raises(ValueError):
        weights.fit_weighting(docs, three.union(docs.selectExpr("concat('more', doc_id)")))
