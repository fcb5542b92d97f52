"""Backlog of crawl files: register, sample, claim, keep versions.

A stored backlog changes by whole versions of a month, each built on the one
before. A claim is such a change, with a lease, so two runs at once never hold
the same file and a run that died does not keep its files.

``file_paths(year_month, file_path, job_id)``; ``job_id`` is null until a run
has claimed the file. The table is partitioned by month, so every step reads
one month.
"""

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.session import stored
from corpusloom.sources import versions

KEY = ["year_month", "file_path"]
STORED = "file_path string, job_id int, lease_until timestamp, year_month string, version bigint"
LEASE_SECONDS = 6 * 3600


def new_paths(registered: DataFrame, offered: DataFrame) -> DataFrame:
    """Offered paths that are not registered yet, each once and unclaimed."""
    return (
        offered.select(KEY)
        .dropDuplicates()
        .join(registered.select(KEY), KEY, "left_anti")
        .withColumn("job_id", F.lit(None).cast("int"))
    )


def register(file_paths: DataFrame, path: str) -> None:
    """Append to the stored backlog."""
    file_paths.write.mode("append").partitionBy("year_month").parquet(path)


def unclaimed(file_paths: DataFrame, year_month: str) -> DataFrame:
    return file_paths.filter(
        (F.col("year_month") == year_month)
        & (F.col("file_path") != "")
        & F.col("job_id").isNull()
    )


def sample_unclaimed(
    file_paths: DataFrame, year_month: str, n: int, seed: int = 0
) -> DataFrame:
    """``n`` unclaimed paths of a month drawn without replacement; all if n < 1.

    The draw orders paths by a seeded hash, so it is repeatable and takes only
    the best ``n`` of each task to the final merge.
    """
    open_paths = unclaimed(file_paths, year_month).select(KEY)
    if n < 1:
        return open_paths
    available = open_paths.count()
    if n > available:
        raise ValueError(f"asked for {n} paths, only {available} are unclaimed")
    draw = F.md5(F.concat("file_path", F.lit(f"#{seed}")))
    return open_paths.orderBy(draw, "file_path").limit(n)


def claim(file_paths: DataFrame, claims: DataFrame) -> DataFrame:
    """Backlog after claims(year_month, file_path, job_id, claim_no).

    A path that has a job keeps it; among claims to the same path the lowest
    ``claim_no`` wins.
    """
    first = claims.groupBy(KEY).agg(
        F.min(F.struct("claim_no", F.col("job_id").alias("claimed_by"))).alias("first")
    )
    return (
        file_paths.join(first.select(*KEY, "first.claimed_by"), KEY, "left")
        .select(*KEY, F.coalesce("job_id", "claimed_by").alias("job_id"))
    )


def _folder(root: str, year_month: str) -> str:
    return f"{root}/year_month={year_month}"


def read_version(spark: SparkSession, root: str, year_month: str, version: int) -> DataFrame:
    """A month of the backlog as of a version; 0 is the empty one."""
    if version == 0:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("basePath", root).parquet(f"{_folder(root, year_month)}/version={version}")


def change_month(spark: SparkSession, root: str, year_month: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The month after ``change``, published as a new version; ``change`` is called again if another run was first."""

    def next_version(version: int) -> DataFrame:
        month = change(read_version(spark, root, year_month, version))
        lease = F.col("lease_until") if "lease_until" in month.columns else F.lit(None)
        return month.select("file_path", F.col("job_id").cast("int"), lease.cast("timestamp").alias("lease_until"))

    made = versions.commit(spark, root, _folder(root, year_month), next_version)
    return read_version(spark, root, year_month, made)


def save_version(file_paths: DataFrame, root: str, year_month: str) -> None:
    """Write a month of the backlog as its newest version; earlier versions stay as they are."""
    change_month(file_paths.sparkSession, root, year_month, lambda _: file_paths.filter(F.col("year_month") == year_month))


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of every month: (year_month, file_path, job_id, lease_until)."""
    newest = versions.versions(spark, f"{root}/year_month=*")  # a folder per month
    if not newest:
        return spark.createDataFrame([], STORED).drop("version")
    paths = [f"{folder}/version={version}" for folder, version in newest.items()]
    return spark.read.schema(STORED).option("basePath", root).parquet(*paths).select(*KEY, "job_id", "lease_until")


def lapsed(month: DataFrame, now: datetime | None = None) -> DataFrame:
    """The month with claims whose lease is over given back; a finished claim has no lease."""
    over = F.col("lease_until") <= F.lit(now or datetime.now(timezone.utc))
    back = F.when(~F.coalesce(over, F.lit(False)), F.col("job_id"))
    return month.withColumns({"job_id": back, "lease_until": F.when(back.isNotNull(), F.col("lease_until"))})


def claim_next(spark: SparkSession, root: str, year_month: str, n: int, job_id: int, seconds: float = LEASE_SECONDS) -> DataFrame:
    """The files of a month that ``job_id`` now holds for so many seconds: ``n`` more that nobody held (all if n < 1).

    No file is ever held by two runs: a run whose version was not the first on
    its base draws again from what is left. A run that died gives its files
    back when its lease ends; one that lives on renews it (``renew``).
    """
    until = datetime.now(timezone.utc) + timedelta(seconds=seconds)

    def change(month):
        free = lapsed(month)
        # written, so that the draw is one and the same for the count of what is left and for the claim
        chosen = stored(sample_unclaimed(free, year_month, n).withColumn("chosen", F.lit(True)), "chosen")
        mine = F.coalesce("chosen", F.lit(False))
        return free.join(chosen, KEY, "left").select(
            *KEY, F.when(mine, F.lit(job_id)).otherwise(F.col("job_id")).alias("job_id"),
            F.when(mine, F.lit(until)).otherwise(F.col("lease_until")).alias("lease_until"),
        )

    return change_month(spark, root, year_month, change).filter(F.col("job_id") == job_id).select(*KEY, "job_id", "lease_until")


def _set_lease(spark: SparkSession, root: str, year_month: str, job_id: int, until) -> None:
    lease = F.when(F.col("job_id") == job_id, until).otherwise(F.col("lease_until"))
    change_month(spark, root, year_month, lambda month: month.withColumn("lease_until", lease))


def renew(spark: SparkSession, root: str, year_month: str, job_id: int, seconds: float = LEASE_SECONDS) -> None:
    """Let a run hold its files so many seconds from now."""
    _set_lease(spark, root, year_month, job_id, F.lit(datetime.now(timezone.utc) + timedelta(seconds=seconds)))


def finish(spark: SparkSession, root: str, year_month: str, job_id: int) -> None:
    """Let a completed run keep its files for good."""
    _set_lease(spark, root, year_month, job_id, F.lit(None).cast("timestamp"))


def give_back(spark: SparkSession, root: str, year_month: str, job_id: int) -> None:
    """The files of a failed run are free again."""
    change_month(spark, root, year_month, lambda month: release(month, job_id))


def release(file_paths: DataFrame, job_id: int) -> DataFrame:
    """The backlog with the files of a failed job unclaimed again."""
    return file_paths.withColumn("job_id", F.when(F.col("job_id") != job_id, F.col("job_id")))
