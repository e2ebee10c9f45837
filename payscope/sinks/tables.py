"""Writing: raw landing, stored failures, the flat export."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from payscope.operators.checks import KeyCheck, RowCheck, failing_rows, fused_failures
from payscope.session import scratch_path

AUDIT_SCHEMA = "failing_row string, run_id string, check_name string"


def _replace(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another. The old one goes last, and comes
    back if the new one can't be moved."""
    here, fresh = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, new))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{new}__old")
    had = files.exists(here)
    if had and not files.rename(here, old):
        raise OSError(f"{path}: can't be moved")
    if not files.rename(fresh, here):
        if had:
            files.rename(old, here)
        raise OSError(f"{new}: can't be moved to {path}")
    if had:
        files.delete(old, True)


def _discard(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def truncate_and_load(
    df: DataFrame, path: str, *, partition_by: str | None = None, empty: bool = True
) -> dict[str, int]:
    """Replace the table at ``path``, once all rows are written beside it: a load that
    fails on its last row leaves the old table as it was. So does one without rows if
    ``empty`` is not allowed. The row count is observed during the write, so nothing is
    read twice. ``df`` may read the table that it replaces."""
    spark, new = df.sparkSession, f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    seen = Observation("load")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(new)
        rows = seen.get["rows"]
        if rows or empty:
            _replace(spark, new, path)
    finally:
        _discard(spark, new)
    return {"rows": rows, "columns": len(df.columns)}


def write_spread(df: DataFrame, path: str, by: str) -> dict[str, int]:
    """Replace a table partitioned by a column of very uneven groups. Rows are brought
    together by group, and the rebalance splits a group that is too large for one task
    into even parts and joins small ones, by the sizes it measures."""
    return truncate_and_load(df.hint("rebalance", F.col(by)), path, partition_by=by)


def store_failures(checks: Mapping[str, DataFrame], folder: str, run_id: str) -> None:
    """Keep every failing row of a run under ``folder/run_id=../check_name=..``. All
    checks are written by one job, a file or a few for each; a repeated run replaces its
    own rows only."""
    _store(failing_rows(checks), folder, run_id)


def store_fused_failures(
    tables: Sequence[tuple[DataFrame, Sequence[RowCheck | KeyCheck]]], folder: str, run_id: str
) -> None:
    """``store_failures`` for checks that are declared per table: each table is scanned once,
    whatever the number of its checks."""
    _store(reduce(DataFrame.union, [fused_failures(df, checks) for df, checks in tables]), folder, run_id)


def _store(failing: DataFrame, folder: str, run_id: str) -> None:
    spread = failing.hint("rebalance", F.col("check_name"))
    spread.write.mode("overwrite").partitionBy("check_name").parquet(f"{folder}/run_id={run_id}")


def read_failures(spark: SparkSession, folder: str, run_id: str | None = None) -> DataFrame:
    """Stored failing rows; of one run, read from its folder alone."""
    stored = spark.read.schema(AUDIT_SCHEMA).parquet(folder)
    return stored if run_id is None else stored.filter(F.col("run_id") == run_id)


def recent_failures(spark: SparkSession, folder: str, since: str) -> DataFrame:
    """Stored failing rows written at or after a moment, by file modification time; what
    earlier runs or dropped checks left behind is not a current failure."""
    stored = spark.read.schema(AUDIT_SCHEMA).parquet(folder)
    return stored.filter(
        F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp")
    )


def export_csv(
    df: DataFrame,
    path: str,
    columns: Mapping[str, Column],
    order: Sequence[Column],
    *,
    single_file: bool = True,
) -> DataFrame:
    """Projection with new names, sorted, as CSV with a header.

    One file, sorted by the task that writes it, or with ``single_file=False`` the sorted
    partitions side by side, in name order, for a result too large for one task.
    """
    out = df.select(*(c.alias(n) for n, c in columns.items()))
    ordered = out.repartition(1).sortWithinPartitions(*order) if single_file else out.orderBy(*order)
    ordered.write.mode("overwrite").csv(path, header=True)
    return out


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """``df`` as a table of so many buckets by a key, sorted within them. Tables with equal
    buckets join and group on the key without a shuffle. Files lie in the shared folder; the
    catalog knows the table under ``name``, or one of its own."""
    spark, name = df.sparkSession, name or f"bucketed_{uuid.uuid4().hex}"
    # A task per bucket writes one file for it.
    placed = df.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)
