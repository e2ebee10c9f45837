"""Landing a set of sources raw: one table each, and a manifest of what happened."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from payscope.sinks.tables import truncate_and_load
from payscope.sources.archives import list_members, unpack_first_member
from payscope.sources.csv_files import read_csv
from payscope.sources.json_files import (
    missing_pages,
    read_documents,
    read_pages,
    read_raw_documents,
)

MANIFEST = "source string, status string, rows bigint, columns int, message string"


@dataclass(frozen=True)
class Source:
    """Where a raw table comes from. ``kind`` is one of csv, csv_zip, json, json_zip,
    pages; ``header_row`` counts from 0. JSON documents land whole as text, or under
    ``schema`` if one is given. ``lines`` says that no record spans lines, so that files can be split among tasks."""

    path: str
    kind: str
    header_row: int = 0
    schema: str | T.StructType | None = None
    columns: Sequence[str] | None = None
    page_size: int = 500
    lines: bool = False


def open_source(
    spark: SparkSession, source: Source
) -> tuple[DataFrame, DataFrame | None, Callable[[], str]]:
    """The raw rows, the header map where names were cleaned, and what to remark once
    they have been read."""
    path, kind, remark = source.path, source.kind, ""
    if kind.endswith("_zip"):
        remark = list_members(spark, path).first().warning or ""
        path, kind = unpack_first_member(spark, path), kind.removesuffix("_zip")
    if kind == "csv":
        scan = read_csv(spark, path, source.header_row, multiline=not source.lines)
        return scan.df, scan.renames, lambda: remark or scan.remark()
    if kind == "json" and source.schema is None:
        return read_raw_documents(spark, path, lines=source.lines), None, lambda: remark
    if kind == "json":
        return read_documents(spark, path, source.schema, lines=source.lines), None, lambda: remark
    if kind == "pages":
        seen = Observation("pages")
        rows = read_pages(
            spark, path, source.columns, page_size=source.page_size, lines=source.lines, seen=seen
        )
        return rows, None, lambda: missing_pages(seen, source.page_size)
    raise ValueError(f"unknown kind {source.kind}")


def load_source(spark: SparkSession, source: Source, target: str) -> tuple[str, int, int, str]:
    """Lands one source; (status, rows, columns, message)."""
    try:
        raw, renames, remark = open_source(spark, source)
        if not raw.columns:
            return "empty", 0, 0, "no rows, not loaded"
        counts = truncate_and_load(raw, target, empty=False)
        if not counts["rows"]:
            return "empty", 0, counts["columns"], "no rows, not loaded"
        if renames is not None:
            truncate_and_load(renames, target + "__renames")
        return "loaded", counts["rows"], counts["columns"], remark()
    except AnalysisException as e:
        missing = e.getCondition() == "PATH_NOT_FOUND"
        return "missing" if missing else "failed", 0, 0, str(e)
    except Exception as e:  # noqa: BLE001 - any broken source is recorded, the rest go on
        return "failed", 0, 0, str(e)


def ingest(
    spark: SparkSession,
    sources: Mapping[str, Source],
    folder: str,
    *,
    at_once: int = 4,
    report: Callable[[str, str], None] | None = None,
) -> DataFrame:
    """Land every source under ``folder/<name>``, replacing what was there. A source
    that is missing, empty or broken is recorded, its table stays as it was, and the
    others go on. Several are read
    at once, since a file that cannot be split keeps a single task busy."""

    def one(item: tuple[str, Source]) -> tuple:
        name, source = item
        status, rows, columns, message = load_source(spark, source, f"{folder}/{name}")
        if report:
            report(name, status)
        return name, status, rows, columns, message

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(one, sources.items()))
    return spark.createDataFrame(rows, MANIFEST)


def read_raw(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Landed tables by name, also registered as temporary views."""
    tables = {}
    for name in names:
        tables[name] = spark.read.parquet(f"{folder}/{name}")
        tables[name].createOrReplaceTempView(name)
    return tables
