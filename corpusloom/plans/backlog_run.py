"""One round of the backlog: choose files of a month, process them, claim them."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.plans.clustering_run import run_clustering, run_languages
from corpusloom.session import stored
from corpusloom.sources import backlog, crawl_text, result_tables


def run_month(
    spark: SparkSession,
    file_paths: DataFrame,
    year_month: str,
    n: int,
    job_id: int,
    model: PipelineModel,
    root: str,
    location: str = "",
    job_type: str = "clustering",
    cluster: dict | None = None,
    backlog_root: str | None = None,
    lease_seconds: float = backlog.LEASE_SECONDS,
    **options,
) -> DataFrame:
    """The backlog after ``job_id`` has processed ``n`` unclaimed files (all if n < 1).

    Paths in the backlog are relative to ``location``. The run is recorded in
    the ledger under ``root``, with the error when it fails; then no file is
    claimed. With ``backlog_root`` the stored backlog there is used in place of
    ``file_paths``: the claim is published before the work begins, so a second
    run takes other files, for good when the work is done, and taken back on
    failure or when its lease of ``lease_seconds`` ends. ``cluster`` may name
    master_type, slave_type and num_slaves; ``options`` go to the clustering.
    """
    if backlog_root is None:
        chosen = stored(backlog.sample_unclaimed(file_paths, year_month, n), "chosen")
    else:
        chosen = backlog.claim_next(spark, backlog_root, year_month, n, job_id, lease_seconds)
    # The paths of one round: a list of file names, as the reader takes it.
    paths = [location + row.file_path for row in chosen.select("file_path").collect()]
    if not paths:
        return file_paths

    def record(status, **details):
        result_tables.record_run_event(spark, root, job_id, status, **details)

    record("STARTED", job_type=job_type, **(cluster or {}))
    try:
        docs = crawl_text.read_documents(spark, paths).select("doc_id", "text")
        if job_type == "lang_only":
            run_languages(docs, model, root, job_id)
        else:
            run_clustering(docs, model, root, job_id, **options)
    except Exception as error:
        record("ERROR", err_text=str(error))
        if backlog_root is not None:
            backlog.give_back(spark, backlog_root, year_month, job_id)
        raise
    if backlog_root is not None:
        backlog.finish(spark, backlog_root, year_month, job_id)
        record("COMPLETED")
        return backlog.latest(spark, backlog_root)
    record("COMPLETED")
    return backlog.claim(
        file_paths, chosen.select(*backlog.KEY, F.lit(job_id).alias("job_id"), F.lit(0).alias("claim_no"))
    )


def run_next(spark: SparkSession, backlog_root: str, year_month: str, n: int, job_id: int, *args, **options) -> DataFrame:
    """``run_month`` on the stored backlog: claims are published before the work and given back if it fails."""
    return run_month(spark, backlog.latest(spark, backlog_root), year_month, n, job_id, *args, backlog_root=backlog_root, **options)
