"""What is current in a folder: numbered pointer files, the highest of which counts.

A pointer is written under a name of its own and then renamed to its number, which fails if that number is taken, so of two
writers one wins and the other can look again. Readers see the old pointer or the new one, never a part of one. Files go
through Hadoop's file systems, whose rename of a single file is atomic on HDFS and on local disks; on an object store it
needs a file system that keeps it so.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

FOLDER = "_current"


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):  # noqa: ANN202
    p = _path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, sorted; nothing if there is no such folder."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def version(spark: SparkSession, top: str) -> int:
    """The number of the current pointer; 0 without one."""
    return max((int(n) for n in names(spark, f"{top}/{FOLDER}") if n.isdigit()), default=0)


def read(spark: SparkSession, top: str, number: int | None = None) -> list[str]:
    """The lines of a pointer, by default the current one's."""
    number = version(spark, top) if number is None else number
    if not number:
        return []
    fs, p = file_system(spark, f"{top}/{FOLDER}/{number}")
    source = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return text.splitlines()


def put(spark: SparkSession, top: str, number: int, lines: list[str]) -> bool:
    """Makes lines the pointer of a number; False if the number is taken."""
    fs, new = file_system(spark, f"{top}/{FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(new, False)
    try:
        out.write("".join(f"{x}\n" for x in lines).encode())
    finally:
        out.close()
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(new, _path(spark, f"{top}/{FOLDER}/{number}"), none)
    except Exception as e:
        fs.delete(new, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def forget(spark: SparkSession, top: str, keep: int = 2) -> list[str]:
    """Deletes all but the newest pointers; what the kept ones name, for callers that clear up what they point to."""
    known = sorted(int(n) for n in names(spark, f"{top}/{FOLDER}") if n.isdigit())
    for n in known[:-keep]:
        remove(spark, f"{top}/{FOLDER}/{n}")
    return [x for n in known[-keep:] for x in read(spark, top, n)]
