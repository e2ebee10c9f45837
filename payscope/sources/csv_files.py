"""All-text CSV scans: header below a preamble, encoding fallback, missing cells."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payscope.session import materialize
from payscope.sources.names import clean_names, rename_map

# Cell texts that mean a missing value.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# One column more than the header names; anything in it is a cell too many.
_OVERFLOW, _FILE = "_overflow", "_file"

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"


@dataclass(frozen=True)
class Scan:
    """Text rows, the map of changed names, and the files (column ``file``) that were not
    valid UTF-8 and are read as Latin-1 as a whole. Bytes are never repaired."""

    df: DataFrame
    renames: DataFrame
    fallback: DataFrame

    def remark(self) -> str:
        n, first = self.fallback.agg(F.count(F.lit(1)), F.min("file")).first()
        return f"read as Latin-1: {first}" + (f" and {n - 1} more" if n > 1 else "") if n else ""


#: Bytes fetched from a file at a time until its header is complete.
HEAD_BLOCK = 1 << 16
#: File systems that tasks open through Arrow; heads of files elsewhere come by the driver.
ARROW_SCHEMES = ("file", "hdfs", "s3", "s3a", "s3n", "gs")


def header_at(read: Callable[[int, int], bytes], header_row: int, encoding: str | None) -> tuple[list[str] | None, int]:
    """The record at ``header_row`` (blank lines not counted) and the byte after it, or None
    and the file's length. ``read(start, n)`` gives up to n bytes; no more blocks are
    fetched than it takes."""

    def parsed(lines: list[bytes]) -> list[str] | None:
        for charset in (encoding or "utf-8", "latin-1"):
            try:
                text = [line.rstrip(b"\r\n").decode(charset) for line in lines]
                break
            except UnicodeDecodeError:
                continue
        text[0] = text[0].removeprefix("\ufeff")
        records = [r for r in csv.reader(t + "\n" for t in text) if r]
        return records[header_row] if len(records) > header_row else None

    data, held, used, quotes, over = b"", [], 0, 0, False
    while not over:
        block = read(used + len(data), HEAD_BLOCK)
        over, data = not block, data + block
        lines = data.splitlines(keepends=True)
        # A line may go on in the next block, as may its end of two signs.
        whole = lines if over else lines[:-1]
        for line in whole:
            held.append(line)
            used += len(line)
            quotes += line.count(b'"')
            # A record that ends with an odd number of quotes goes on in the next line.
            if len(held) > header_row and quotes % 2 == 0 and (header := parsed(held)) is not None:
                return header, used
        data = b"" if over else b"".join(lines[-1:])
    return None, used


def _open_head(path: str) -> Callable[[int, int], bytes]:
    """Reads a file that a task names as Hadoop does."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        system, at = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        host, _, inside = rest.lstrip("/").partition("/")
        system, top = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{host}/")
        at = f"{top.rstrip('/')}/{inside}"
    source = system.open_input_file(at)

    def read(start: int, n: int) -> bytes:
        source.seek(start)
        return source.read(n)

    return read


def _open_on_driver(spark: SparkSession, path: str) -> Callable[[int, int], bytes]:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)

    def read(start: int, n: int) -> bytes:
        source.seek(start)
        return bytes(source.readNBytes(n))

    return read


def file_validity(spark: SparkSession, path: str) -> DataFrame:
    """Per file, whether every line of it is valid UTF-8."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("utf8"))
    return lines.groupBy("file").agg(F.every("utf8").alias("utf8"))


def file_headers(spark: SparkSession, path: str, header_row: int = 0, encoding: str | None = None) -> DataFrame:
    """Per file (``file``) the record at ``header_row`` (blank lines not counted) as an
    array, the byte after it (``offset``), and whether every line is valid UTF-8 (``utf8``,
    taken for granted if the encoding is given).

    Headers come from the first bytes of each file alone, read by tasks that have file names
    as rows. Validity is an aggregate over the lines, which stay in the JVM."""
    # The listing opens no file, as the content is not asked for.
    listed = spark.read.format("binaryFile").load(path).filter("length > 0").select(F.col("_metadata.file_path").alias("file"), "path")
    schemes = [r[0] for r in listed.select(F.substring_index("path", ":", 1)).distinct().limit(len(ARROW_SCHEMES) + 1).collect()]

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, paths = (c.to_pylist() for c in batch.columns)
            found = [header_at(_open_head(p), header_row, encoding) for p in paths]
            columns = [pa.array(files), pa.array([h for h, _ in found], pa.list_(pa.string())), pa.array([o for _, o in found], pa.int64())]
            yield pa.record_batch(columns, ["file", "header", "offset"])

    schema = "file string, header array<string>, offset long"
    if set(schemes) <= set(ARROW_SCHEMES):
        heads = listed.mapInArrow(look, schema)
    else:
        heads = spark.createDataFrame([(r.file, *header_at(_open_on_driver(spark, r.path), header_row, encoding)) for r in listed.collect()], schema)
    if encoding is not None:
        return heads.withColumn("utf8", F.lit(True))
    return heads.join(file_validity(spark, path), "file", "left").withColumn("utf8", F.coalesce("utf8", F.lit(True)))


def read_csv(
    spark: SparkSession,
    path: str,
    header_row: int = 0,
    *,
    encoding: str | None = None,
    multiline: bool = True,
    missing: Sequence[str] = MISSING_CELLS,
) -> Scan:
    """A CSV file, or a folder of files with one header, as text columns under clean
    names. Short rows are filled with NULL, a row longer than the header is an error, and
    so is a file whose header differs.

    ``header_row`` counts the records above the header, which are dropped with it from
    every file. A quoted line break is only safe when one task reads a whole file; files
    known to have none are split among tasks with ``multiline=False``. A given
    ``encoding`` takes the place of the test for UTF-8, which reads all lines once; else
    only the heads of the files are read before the rows. Rows go through Python only where
    records above the header have to be dropped.
    """
    files = materialize(file_headers(spark, path, header_row, encoding), "headers")
    # Two headers say enough, whatever the number of files.
    headers = files.groupBy("header").agg(F.min("file").alias("file"), F.count_if(~F.col("utf8")).alias("latin"), F.count(F.lit(1)).alias("n")).limit(2).collect()
    if not headers:
        raise ValueError(f"{path}: no file with a line")
    if any(h.header is None for h in headers):
        raise ValueError(f"{next(h.file for h in headers if h.header is None)}: no record {header_row} to take as header")
    if len(headers) > 1:
        raise ValueError(f"header differs: {headers[0].file} and {headers[1].file}")
    header, latin, n = list(headers[0].header), headers[0].latin, headers[0].n
    names = clean_names(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _OVERFLOW]])
    charset = encoding or (UTF8 if not latin else LATIN1)
    rows = spark.read.schema(schema).csv(
        path, header=header_row == 0, multiLine=multiline, quote='"', escape='"', encoding=charset,
    )
    if header_row:
        rows = _below_header(rows, header, header_row, mixed=bool(latin))
    elif 0 < latin < n:
        rows = rows.withColumn(_FILE, F.col("_metadata.file_path"))
    too_long = F.raise_error(F.lit(f"{path}: a row has more cells than the header"))
    rows = rows.filter(F.when(F.col(_OVERFLOW).isNotNull(), too_long.cast("boolean")).otherwise(True))
    if 0 < latin < n:
        # Latin-1 keeps every byte, so cells of the files in UTF-8 can still be decoded.
        rows = rows.join(files.select(F.col("file").alias(_FILE), "utf8"), _FILE, "left")
        decode = lambda c: F.decode(F.encode(F.col(c), LATIN1), UTF8)
        rows = rows.select(*(F.when(F.col("utf8"), decode(f"`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in names))

    # As text, since a header may have thousands of names.
    listed = ", ".join("'" + m.replace("'", "\\'") + "'" for m in missing)
    cells = [f"CASE WHEN `{n}` NOT IN ({listed}) THEN `{n}` END AS `{n}`" for n in names]
    df = rows.selectExpr(*cells) if missing else rows.select(*(F.col(f"`{n}`") for n in names))
    return Scan(df, rename_map(spark, header, names), files.filter(~F.col("utf8")).select("file"))


def _below_header(rows: DataFrame, header: list[str], header_row: int, mixed: bool) -> DataFrame:
    """The rows below the header of each file, in one scan of all. Rows of a file come in
    order, and its first block has the preamble. The scan has to find the header where
    the text has it; it does not where lines end in more than one way and records are
    joined."""
    cells = len(header) + 1
    last = {header[-1] or None}
    if mixed:  # bytes of UTF-8 that were read as Latin-1
        last.add((header[-1] or "").encode().decode("latin-1") or None)
    placed = rows.select("*", F.col("_metadata.file_path").alias(_FILE), (F.col("_metadata.file_block_start") == 0).alias("_top"))

    def drop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in batches:
            names = pc.run_end_encode(batch.column(cells)) if batch.num_rows else None
            start = 0
            for end, name in zip(names.run_ends.to_pylist(), names.values.to_pylist()) if names else ():
                part, start = batch.slice(start, end - start), end
                if name != now:
                    now, at = name, 0
                if part.column(cells + 1)[0].as_py() and at <= header_row:
                    here = header_row - at
                    at += part.num_rows
                    if here < part.num_rows and (part.column(cells - 2)[here].as_py() not in last or part.column(cells - 1)[here].as_py() is not None):
                        raise ValueError(f"{name}: mixed line ends, the header is not a record of its own")
                    part = part.slice(min(here + 1, part.num_rows))
                if part.num_rows:
                    yield part.select(range(cells + 1))

    return placed.mapInArrow(drop, T.StructType([*rows.schema.fields, T.StructField(_FILE, T.StringType())]))
