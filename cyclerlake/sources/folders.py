"""Folders by test, read some at a time.

A frame over files keeps their paths, sizes and partition values in the driver, kilobytes for each folder and its files, and a task
lists every folder. Tests grow in number with the data, so beyond ``FOLDERS`` of them batches are read one after the other.
What the driver holds is then a batch, and the names of the folders beside each other in one folder.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, islice

from pyspark.sql import DataFrame, SparkSession

from cyclerlake.session import work_folder

# so many folders are in one frame
FOLDERS = 10_000
SETTINGS = {
    # small files are read some hundreds to a task
    "spark.sql.files.openCostInBytes": "262144",
    # what was listed for a batch is not kept for others
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}


def _partitions(spark: SparkSession, folder: str) -> list[str]:
    """Folders of partitions in a folder; none if it does not exist."""
    hadoop, arrays = spark._jvm.org.apache.hadoop.fs, spark._jvm.scala.runtime.ScalaRunTime
    at = hadoop.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    # one text: a call into the JVM per folder would take longest; line feeds are escaped in names of partitions
    found = arrays.genericWrapArray(hadoop.FileUtil.stat2Paths(system.listStatus(at))).mkString("\n").split("\n")
    return sorted(p for p in found if "=" in p.rsplit("/", 1)[-1])


def _innermost(spark: SparkSession, folder: str) -> Iterator[str]:
    """Folders without partitions in them; all lie equally deep, so they are not looked into."""
    depth, at = 0, folder
    while inner := _partitions(spark, at)[:1]:
        depth, at = depth + 1, inner[0]

    def below(top: str, levels: int) -> Iterator[str]:
        if not levels:
            yield top
        elif levels == 1:
            yield from _partitions(spark, top)
        else:
            for inner in _partitions(spark, top):
                yield from below(inner, levels - 1)

    return below(folder, depth)


def _reading(spark: SparkSession) -> SparkSession:
    """A session with the same settings but those that many small files need."""
    session = spark.newSession()
    # a batch is listed by some tasks per core, not by a task per folder
    tasks = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}
    for key, value in (spark.conf.getAll | SETTINGS | tasks).items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def landed_by_folders(spark: SparkSession, roots: Sequence[str], rows: Callable[[SparkSession, list[str]], DataFrame], purpose: str) -> DataFrame | None:
    """What ``rows`` gives for the folders below the roots, landed batch by batch; None where they fit one frame."""
    found = (folder for root in roots for folder in _innermost(spark, root))
    batches = iter(lambda: list(islice(found, FOLDERS)), [])
    first = list(islice(batches, 2))
    if len(first) < 2:
        return None
    session, path = _reading(spark), work_folder(spark, purpose)
    for folders in chain(first, batches):
        part = rows(session, folders)
        schema = part.schema
        part.write.mode("append").parquet(path)
        # handles of the JVM are in reference cycles; what they hold of a batch goes when these are collected
        del part
        gc.collect()
    return spark.read.schema(schema).parquet(path)
