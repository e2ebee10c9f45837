"""What the operators share: reading tables, whole texts, and Arrow batches in tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.session import materialize

#: Bytes of text that a task works on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Lets this session's Python workers import this package from where the driver has
    it, whatever their working folder. A cluster that ships the package has it anyway."""
    top, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, top])


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_WORD = 32768  # bits in a row of bitmap_construct_agg


def marked(df: DataFrame, slot: Column, asked: DataFrame, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: whether its slot's bit is set by a slot in
    ``asked`` (column ``slot``; slots lie below a fixed number of bits). The bitmap, an
    eighth of that in bytes at most however many rows ask, is broadcast."""
    bits = asked.groupBy(F.expr(f"slot div {_WORD}").alias("_word")).agg(
        F.expr(f"bitmap_construct_agg(slot % {_WORD})").alias("_bits")
    )
    taken = fresh(df, "_slot")
    at = f"`{taken}`"
    word, held = fresh(df, "_word"), fresh(df, "_bits")
    bits = bits.select(F.col("_word").alias(word), F.col("_bits").alias(held))
    byte = f"conv(hex(substring(`{held}`, cast({at} % {_WORD} div 8 as int) + 1, 1)), 16, 10)"
    bit = F.expr(f"shiftright(cast({byte} as int), cast({at} % 8 as int)) & 1") == 1
    return (
        df.withColumn(taken, slot)
        .withColumn(word, F.expr(f"{at} div {_WORD}"))
        .join(F.broadcast(bits), word, "left")
        .withColumn(name, F.coalesce(bit, F.lit(False)))
        .drop(taken, word, held)
        .select(*df.columns, name)
    )


#: Bits of the bitmap that tells rows which are surely kept (8 MiB).
KEPT_BITS = 1 << 26


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a number for each row, written. How Spark splits a scan depends on the
    cores it has at that moment, so rows that are numbered anew in a later job can have
    other numbers; the written ones stay."""
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def without_rows(docs: DataFrame, dropped: DataFrame, row: str) -> DataFrame:
    """``docs``, as ``numbered`` under the name ``row``, without the rows whose numbers are
    in ``dropped`` (column ``row``) and without the numbers, other columns as they were.

    Only rows whose bit in a bitmap of the dropped ones is set are shuffled to be compared
    with them; the texts of all others stay where they are. With more dropped rows than
    bits more of them are compared."""
    hit = fresh(docs, "_hit")
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(KEPT_BITS))
    told = marked(docs, slot(row), dropped.select(slot("row").alias("slot")), hit)
    apart = told.filter(F.col(hit)).join(dropped.select(F.col("row").alias(row)), row, "left_anti")
    return told.filter(~F.col(hit)).unionByName(apart).drop(row, hit)


def chunks(batches: Iterable[pa.RecordBatch], column: int = -1) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one holds about ``CHUNK_BYTES`` of the string column."""
    for batch in batches:
        start = size = 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + (n or 0) > CHUNK_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def map_chunks(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """``work`` on every chunk; the last column of ``df`` is its text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield work(chunk)

    return df.mapInArrow(run, schema)
