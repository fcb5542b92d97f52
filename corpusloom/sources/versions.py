"""Folders published whole: written aside, then renamed to the next version number if nobody has it yet.

A version is built on the one before it. Of two writers that build on the same
one only the first can publish; the other reads again and tries anew. Readers
take the newest version, so they never see half of one. The rename must be one
step of the file system that fails if its target exists, as in a distributed file
system or a local one; object stores need a committer of their own.
"""

import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

TRIES = 50


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def building(root: str) -> str:
    """A new folder beside the versions, which readers of ``root`` skip."""
    return f"{root}/_building/{uuid.uuid4().hex}"


def versions(spark: SparkSession, folder: str) -> dict[str, int]:
    """Newest version number of every folder that the pattern names and that has one."""
    place = _path(spark, f"{folder}/version=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    newest: dict[str, int] = {}
    for status in found:
        base, number = re.fullmatch(r"(.*)/version=(\d+)", status.getPath().toString()).groups()
        newest[base] = max(newest.get(base, 0), int(number))
    return newest


def newest(spark: SparkSession, folder: str) -> int:
    return max(versions(spark, folder).values(), default=0)


def publish(spark: SparkSession, built: str, folder: str, version: int) -> bool:
    """Make a written folder the given version; False if there is one already."""
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, built).toUri(), spark._jsc.hadoopConfiguration())
    target = _path(spark, f"{folder}/version={version}")
    files.mkdir(target.getParent(), spark._jvm.org.apache.hadoop.fs.permission.FsPermission.getDirDefault(), True)
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(_path(spark, built), target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def commit(spark: SparkSession, root: str, folder: str, change: Callable[[int], DataFrame]) -> int:
    """Publish what ``change`` makes of the newest version, again from the start if another writer was first."""
    for _ in range(TRIES):
        base = newest(spark, folder)
        built = building(root)
        change(base).write.parquet(built)
        if publish(spark, built, folder, base + 1):
            return base + 1
    raise RuntimeError(f"no version could be published in {TRIES} tries: {folder}")
