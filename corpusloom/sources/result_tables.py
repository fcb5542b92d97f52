"""Result tables of a run: Parquet, one folder per job and version.

A sink publishes a new version of the jobs it is given and leaves the others,
so a run that is tried again never doubles its rows, and readers see all rows of
a version or none.
"""

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.sources import versions

KEYS = {
    "job": ["job_id"],
    "job_languages": ["job_id", "lang"],
    "job_clusters": ["job_id", "cluster_id"],
    "cluster_keywords": ["job_id", "cluster_id"],
    "cluster_topdocs": ["job_id", "cluster_id", "doc_order_id"],
    "job_errors": ["job_id"],
    "file_paths": ["year_month", "file_path"],
}


def store(table: DataFrame, root: str, name: str, jobs: list[int] | None = None) -> None:
    """Publish the rows of each job as that job's newest version.

    The table is written once, aside; then each job's folder is renamed to its
    next version. ``jobs`` are the jobs that the table speaks for: those of them
    without a row get an empty version, so that no earlier rows are left.
    """
    spark = table.sparkSession
    aside = versions.building(f"{root}/{name}")
    table.write.partitionBy("job_id").parquet(aside)
    built = {job: f"{aside}/job_id={job}" for job in _jobs(spark, aside)}
    for job in jobs or []:
        if str(job) not in built:
            built[str(job)] = versions.building(f"{root}/{name}")
            table.drop("job_id").limit(0).coalesce(1).write.parquet(built[str(job)])
    for job, folder in built.items():
        target = f"{root}/{name}/job_id={job}"
        while not versions.publish(spark, folder, target, versions.newest(spark, target) + 1):
            pass  # another run of the job was first; this one is the newer


def _jobs(spark: SparkSession, folder: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/job_id=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return [status.getPath().getName().removeprefix("job_id=") for status in found]


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of every job's rows; reading goes on undisturbed while a job is published again."""
    newest = versions.versions(spark, f"{root}/{name}/job_id=*")  # a folder per job
    paths = [f"{folder}/version={version}" for folder, version in sorted(newest.items())]
    return spark.read.option("basePath", f"{root}/{name}").parquet(*paths).drop("version")


def of_job(table: DataFrame, job_id: int) -> DataFrame:
    """Rows of one job. Job 0 holds no results; partition pruning reads one folder."""
    return table.filter((F.col("job_id") == job_id) & (F.col("job_id") != 0))


def key_violations(table: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once: (key columns..., n)."""
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


RUN_DETAILS = ["job_type", "master_type", "slave_type", "num_slaves"]
RUN_EVENT = (
    "job_id bigint, ts timestamp, event_id bigint, status string, err_text string, "
    "job_type string, master_type string, slave_type string, num_slaves int"
)


def record_run_event(
    spark: SparkSession, root: str, job_id: int, status: str, err_text: str | None = None, **details
) -> None:
    """Append an event to a run's ledger: STARTED, COMPLETED or ERROR.

    ``details`` of the opening event: job_type ("clustering" or "lang_only"),
    master_type, slave_type, num_slaves.
    """
    nanoseconds = time.time_ns()
    moment = datetime.fromtimestamp(nanoseconds / 1e9, timezone.utc)
    row = (job_id, moment, nanoseconds, status, err_text, *[details.get(c) for c in RUN_DETAILS])
    event = spark.createDataFrame([row], RUN_EVENT).coalesce(1)
    event.write.mode("append").parquet(f"{root}/run_events")


def fold_run_events(events: DataFrame) -> DataFrame:
    """Job table from run events(job_id, ts, event_id, status, err_text).

    Events are only appended: first event opens the run, the last COMPLETED or
    ERROR event ends it, the last event gives the status. Details that the
    events carry are those of the last opening event.
    """
    opened = F.when(F.col("status") == "STARTED", F.struct("ts", "event_id"))
    details = [F.max_by(c, opened).alias(c) for c in RUN_DETAILS if c in events.columns]
    end = F.when(F.col("status").isin("COMPLETED", "ERROR"), F.col("ts"))
    when = F.struct("ts", "event_id")
    error = F.when(F.col("status") == "ERROR", when)
    return events.groupBy("job_id").agg(
        F.min("ts").alias("start_ts"),
        F.max(end).alias("end_ts"),
        F.max_by("status", when).alias("job_status"),
        F.max_by("err_text", error).alias("err_text"),
        *details,
    )
