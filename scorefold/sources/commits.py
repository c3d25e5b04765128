"""Replacing single files of a partitioned Parquet folder.

New files are written into a hidden folder inside the table, which readers
skip.  A marker that lists new and old files makes the commit final: only then
are the new files moved to their partitions and the old ones removed.  A commit
that is interrupted after its marker is finished by the next writer; one that is
interrupted before leaves files that nobody reads.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

HIDDEN = ".merge-"
MARKER = "commit.json"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, place: str):
    return _path(spark, place).getFileSystem(spark._jsc.hadoopConfiguration())


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a ``_metadata.file_path`` stands for."""
    return _path(spark, spark._jvm.java.net.URI(uri)).toString()


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files below a folder, relative to it."""
    fs, top = _files(spark, folder), _path(spark, folder)
    base = fs.makeQualified(top).toString().rstrip("/") + "/"
    found, names = fs.listFiles(top, True), []
    while found.hasNext():
        text = found.next().getPath().toString()
        if not text.rsplit("/", 1)[-1].startswith(("_", ".")):
            names.append(text.removeprefix(base))
    return sorted(names)


def commit_files(rows: DataFrame, place: str, parts: Sequence[str], old: Sequence[str]) -> bool:
    """Write ``rows`` once and put them in place of the files ``old``; True if a partition is new."""
    spark = rows.sparkSession
    hidden = f"{place}/{HIDDEN}{uuid.uuid4().hex[:12]}"
    rows.write.partitionBy(*parts).parquet(f"{hidden}/files")
    marker = json.dumps({"new": _data_files(spark, f"{hidden}/files"), "old": list(old)})
    fs = _files(spark, place)
    stream = fs.create(_path(spark, f"{hidden}/{MARKER}.part"), True)
    stream.write(bytearray(marker.encode()))
    stream.close()
    fs.rename(_path(spark, f"{hidden}/{MARKER}.part"), _path(spark, f"{hidden}/{MARKER}"))
    return _finish(spark, place, hidden)


def _finish(spark: SparkSession, place: str, hidden: str) -> bool:
    """Moves and removals of a commit; each may have been done before."""
    fs, new_partition = _files(spark, place), False
    stream = fs.open(_path(spark, f"{hidden}/{MARKER}"))
    try:
        commit = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    for name in commit["new"]:
        source, target = _path(spark, f"{hidden}/files/{name}"), _path(spark, f"{place}/{name}")
        if fs.exists(source):
            if not fs.exists(target.getParent()):
                new_partition = True
                fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"could not move {name} into {place}")
    for name in commit["old"]:
        fs.delete(_path(spark, name), False)
    fs.delete(_path(spark, hidden), True)
    return new_partition


def finish_commits(spark: SparkSession, place: str) -> int:
    """Finish the commits that were interrupted after their marker; returns how many."""
    fs, done = _files(spark, place), 0
    for status in fs.listStatus(_path(spark, place)):
        name = status.getPath().getName()
        if name.startswith(HIDDEN) and fs.exists(_path(spark, f"{place}/{name}/{MARKER}")):
            _finish(spark, place, f"{place}/{name}")
            done += 1
    return done
