"""Zip archives, unpacked by the executors."""

from __future__ import annotations

import codecs
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.session import scratch_path

_LINES_PER_BATCH = 20_000
_CHUNK = 1 << 20


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """Members of each archive; ``warning`` says when it does not hold exactly one."""

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                held = zipfile.ZipFile(io.BytesIO(content)).namelist()
                yield pd.DataFrame({"path": [where], "members": [held]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    listed = files.mapInPandas(names, "path string, members array<string>")
    return listed.withColumn(
        "warning",
        F.when(
            F.size("members") != 1,
            F.format_string("expected 1 member, found %d", F.size("members")),
        ),
    )


def _is_utf8(archive: zipfile.ZipFile, member: str) -> bool:
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        with archive.open(member) as f:
            while chunk := f.read(_CHUNK):
                decoder.decode(chunk)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return False
    return True


def _first_member_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            archive = zipfile.ZipFile(io.BytesIO(content))
            member = archive.namelist()[0]
            encoding = "utf-8" if _is_utf8(archive, member) else "latin-1"
            # newline="\n" leaves carriage returns in place.
            text = io.TextIOWrapper(archive.open(member), encoding=encoding, newline="\n")
            lines: list[str] = []
            for line in text:
                lines.append(line.removesuffix("\n"))
                if len(lines) == _LINES_PER_BATCH:
                    yield pd.DataFrame({"value": lines})
                    lines = []
            if lines:
                yield pd.DataFrame({"value": lines})


def unpack_first_member(spark: SparkSession, path: str) -> str:
    """Write the first member of one archive as UTF-8 text to the shared folder and
    return where, for the CSV and JSON scans to read.

    Deflated data cannot be split, so one task streams one archive, in bounded batches
    of lines; a collection is unpacked archive by archive.
    """
    target = scratch_path(spark, "unpacked")
    files = spark.read.format("binaryFile").load(path).select("content")
    files.mapInPandas(_first_member_lines, "value string").write.text(target)
    return target
