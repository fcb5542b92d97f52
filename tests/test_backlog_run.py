"""Backlog round: files in, tables and ledger out, files claimed."""

import tempfile

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import language
from corpusloom.plans import inputs
from corpusloom.plans.backlog_run import run_month, run_next
from corpusloom.sources import backlog, result_tables


@pytest.fixture(scope="module")
def crawl(spark, folder):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    records = inputs.raw_records(spark, folder)
    records.select("value").repartition(4).write.option("compression", "gzip").text(f"{root}/files")
    names = spark.read.format("binaryFile").load(f"{root}/files/*.gz").select("path").collect()
    paths = [("2015-06", r.path.split("/")[-1], None) for r in names]
    model = language.fit_language_model(inputs.texts(spark, folder))
    backlog = spark.createDataFrame(paths, "year_month string, file_path string, job_id int")
    return root, backlog, model


def test_language_round(spark, crawl):
    root, paths, model = crawl
    after = run_month(
        spark, paths, "2015-06", 2, 11, model, root, f"{root}/files/",
        job_type="lang_only", cluster={"num_slaves": 19},
    )
    assert sorted(r.job_id or 0 for r in after.collect()) == [0, 0, 11, 11]
    job = result_tables.fold_run_events(spark.read.parquet(f"{root}/run_events")).first()
    assert (job.job_id, job.job_status, job.job_type, job.num_slaves) == (11, "COMPLETED", "lang_only", 19)
    assert job.start_ts <= job.end_ts and job.err_text is None
    counted = result_tables.load(spark, root, "job_languages").filter("job_id = 11")
    assert 0 < counted.agg(F.sum("count")).first()[0] < 200


def test_failed_round_claims_nothing(spark, crawl):
    root, paths, model = crawl
    with pytest.raises(Exception):
        run_month(spark, paths, "2015-06", 0, 12, model, root, f"{root}/missing/")
    events = spark.read.parquet(f"{root}/run_events").filter("job_id = 12")
    job = result_tables.fold_run_events(events).first()
    assert job.job_status == "ERROR" and job.err_text and job.end_ts is not None


def test_nothing_left(spark, crawl):
    root, paths, model = crawl
    assert run_month(spark, paths, "2015-07", 0, 13, model, root) is paths


def test_claims_are_stored_before_the_work_and_released_on_error(spark, crawl, tmp_path):
    root, paths, model = crawl
    store = f"{tmp_path}/backlog"
    backlog.save_version(paths, store, "2015-06")

    def jobs():
        return sorted(r.job_id or 0 for r in backlog.latest(spark, store).collect())

    run_next(spark, store, "2015-06", 2, 21, model, root, f"{root}/files/", job_type="lang_only")
    assert jobs() == [0, 0, 21, 21]
    with pytest.raises(Exception):
        run_next(spark, store, "2015-06", 1, 22, model, root, f"{root}/missing/", job_type="lang_only")
    assert jobs() == [0, 0, 21, 21]
    run_next(spark, store, "2015-06", 2, 23, model, root, f"{root}/files/", job_type="lang_only")
    assert jobs() == [21, 21, 23, 23]
