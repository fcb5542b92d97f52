"""The whole job on crawl files, and the reports read back from its tables."""

import tempfile

from pyspark.sql import functions as F

from corpusloom.operators import language, reports
from corpusloom.plans import inputs
from corpusloom.plans.clustering_run import run_clustering
from corpusloom.sources import crawl_text, result_tables


def test_run_and_reports(spark, folder):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    inputs.raw_records(spark, folder).select("value").write.text(f"{root}/crawl")
    docs = crawl_text.read_documents(spark, f"{root}/crawl")
    model = language.fit_language_model(inputs.texts(spark, folder))
    for _ in range(2):
        run_clustering(docs, model, root, job_id=4)
    tables = {
        name: result_tables.load(spark, root, name)
        for name in ("job_languages", "job_clusters", "cluster_keywords", "cluster_topdocs")
    }
    for name, table in tables.items():
        assert result_tables.key_violations(table, result_tables.KEYS[name]).count() == 0
    counted = {r.lang: r["count"] for r in tables["job_languages"].collect()}
    assert sum(counted.values()) == docs.count()
    assert tables["job_clusters"].agg(F.sum("num_docs")).first()[0] == counted["English"]
    keywords = reports.report_keywords(tables["job_clusters"], tables["cluster_keywords"], 4, n=3).collect()
    sizes = sorted((r.num_docs for r in tables["job_clusters"].collect()), reverse=True)
    assert [r.num_docs for r in keywords] == sizes[:3]
    for row in keywords:
        assert len(row.keywords) == len(row.keyword_weights) <= 100
        assert row.keyword_weights == sorted(row.keyword_weights, reverse=True)
    top = reports.report_topdocs(tables["job_clusters"], tables["cluster_topdocs"], 4, n=3).collect()
    assert sorted((r.num_docs for r in top), reverse=True) == sizes[:3]
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(texts[r.doc_id] == r.text for r in top)


def test_keyword_run(spark, folder):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    docs = inputs.texts(spark, folder).select("doc_id", "text")
    model = language.fit_language_model(inputs.texts(spark, folder))
    words = spark.createDataFrame([("hewh",), ("reou",), ("thth",), ("ening",), ("ation",)], "term string")
    run_clustering(docs, model, root, job_id=5, keywords=words)
    assert result_tables.load(spark, root, "job_clusters").filter("job_id = 5").count() >= 2
