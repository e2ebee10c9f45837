"""Versioned tables: a load adds a version, and readers go by a pointer that is written last.

    <path>/data/<folder of a version>/..    rows, never changed once written
    <path>/versions/<number>                one small file each: the folder's name

A reader that has begun keeps its version, and one that begins finds the last finished one,
so no load ever leaves it without a table. Nothing is renamed, which on an object store
would be a copy. A load that fails leaves a folder that no pointer names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DIGITS = 12


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions there are, in order."""
    files, folder = _files(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    names = (s.getPath().getName() for s in files.listStatus(folder))
    return sorted(int(n) for n in names if n.isdigit())


def _point(spark: SparkSession, path: str, folder: str) -> int:
    """Names a folder as the next version. A number that another load took meanwhile is
    left to it: the file is only created where there is none."""
    exists = spark._jvm.org.apache.hadoop.fs.FileAlreadyExistsException
    number = (versions(spark, path) or [0])[-1]
    while True:
        number += 1
        files, pointer = _files(spark, f"{path}/versions/{number:0{DIGITS}d}")
        if files.exists(pointer):
            continue
        try:
            out = files.create(pointer, False)
        except Exception as e:  # noqa: BLE001 - what py4j makes of a Java exception
            if spark._jvm.py4j.reflection.TypeUtil.isInstanceOf(exists, getattr(e, "java_exception", None)):
                continue
            raise
        out.write(folder.encode())
        out.close()
        return number


def load_snapshot(df: DataFrame, path: str, *, empty: bool = True) -> dict[str, int]:
    """Writes ``df`` as the next version. Without rows none is made unless ``empty`` is
    allowed. ``df`` may read earlier versions."""
    spark, path = df.sparkSession, path.rstrip("/")
    folder, seen = uuid.uuid4().hex, Observation("snapshot")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/data/{folder}")
    rows = seen.get["rows"]
    if not rows and not empty:
        return {"version": 0, "rows": 0, "columns": len(df.columns)}
    return {"version": _point(spark, path, folder), "rows": rows, "columns": len(df.columns)}


def _folder(spark: SparkSession, path: str, number: int) -> str:
    files, pointer = _files(spark, f"{path}/versions/{number:0{DIGITS}d}")
    source = files.open(pointer)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The last version, or the given one."""
    path, found = path.rstrip("/"), versions(spark, path.rstrip("/"))
    if not found or version is not None and version not in found:
        raise LookupError(f"{path}: no version {version or ''}".rstrip())
    return spark.read.parquet(f"{path}/data/{_folder(spark, path, version or found[-1])}")


def drop_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Removes all but the last ``keep`` versions, pointer first, and returns their numbers.
    Queries that still read them fail, so keep as many as queries last."""
    path = path.rstrip("/")
    gone = versions(spark, path)[: -max(keep, 1)]
    for number in gone:
        folder = _folder(spark, path, number)
        for one in (f"{path}/versions/{number:0{DIGITS}d}", f"{path}/data/{folder}"):
            files, old = _files(spark, one)
            files.delete(old, True)
    return gone
