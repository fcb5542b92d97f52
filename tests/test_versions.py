"""Claims of runs at the same time, leases, and result tables that change as a whole."""

import tempfile
from datetime import datetime, timedelta, timezone

import pytest

from corpusloom.sources import backlog, result_tables, versions

PATHS = "year_month string, file_path string, job_id int"
MONTH = "2015-06"


@pytest.fixture
def root(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/backlog"
    backlog.save_version(spark.createDataFrame([(MONTH, f"f{i}", None) for i in range(6)], PATHS), root, MONTH)
    return root


def holders(spark, root):
    return {r.file_path: r.job_id for r in backlog.latest(spark, root).collect()}


def test_a_claim_between_reading_and_publishing_is_not_lost(spark, root, monkeypatch):
    """The other run claims after this one has read the month and drawn its files."""
    other = []
    publish = versions.publish

    def late(spark_, built, folder, version):
        if not other:
            other.append(None)
            other.append({r.file_path for r in backlog.claim_next(spark, root, MONTH, 3, 8).collect()})
        return publish(spark_, built, folder, version)

    monkeypatch.setattr(versions, "publish", late)
    mine = {r.file_path for r in backlog.claim_next(spark, root, MONTH, 3, 7).collect()}
    assert len(mine) == 3 == len(other[1]) and not mine & other[1]
    assert sorted(holders(spark, root).values()) == [7, 7, 7, 8, 8, 8]
    with pytest.raises(ValueError):
        backlog.claim_next(spark, root, MONTH, 1, 9)
    assert versions.newest(spark, f"{root}/year_month={MONTH}") == 3  # the one that lost was never published


def test_publish_never_replaces_a_version(spark, root):
    built = versions.building(root)
    spark.range(1).write.parquet(built)
    before = holders(spark, root)
    assert versions.publish(spark, built, f"{root}/year_month={MONTH}", 1) is False
    assert holders(spark, root) == before


def test_leases(spark, root):
    dead = {r.file_path for r in backlog.claim_next(spark, root, MONTH, 4, 7, seconds=-1).collect()}
    alive = {r.file_path for r in backlog.claim_next(spark, root, MONTH, 0, 8, seconds=600).collect()}
    assert dead < alive and len(alive) == 6  # the dead run's files, its lease over, went to the next one
    backlog.renew(spark, root, MONTH, 8, seconds=-1)
    month = backlog.latest(spark, root)
    assert backlog.unclaimed(backlog.lapsed(month), MONTH).count() == 6
    assert backlog.unclaimed(backlog.lapsed(month, datetime.now(timezone.utc) - timedelta(hours=1)), MONTH).count() == 0
    backlog.finish(spark, root, MONTH, 8)
    assert backlog.unclaimed(backlog.lapsed(backlog.latest(spark, root)), MONTH).count() == 0
    backlog.give_back(spark, root, MONTH, 8)
    assert set(holders(spark, root).values()) == {None}


def test_an_empty_result_replaces_the_old_one(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    schema = "job_id int, cluster_id int, num_docs bigint"
    result_tables.store(spark.createDataFrame([(1, 0, 5), (2, 0, 6)], schema), root, "job_clusters")
    reader = result_tables.load(spark, root, "job_clusters")
    result_tables.store(spark.createDataFrame([], schema), root, "job_clusters", [1])
    assert sorted(map(tuple, result_tables.load(spark, root, "job_clusters").select("job_id", "num_docs").collect())) == [(2, 6)]
    assert reader.count() == 2  # a reader of before still has its whole version
    result_tables.store(spark.createDataFrame([], schema), root, "job_clusters", [2])
    assert result_tables.load(spark, root, "job_clusters").count() == 0
