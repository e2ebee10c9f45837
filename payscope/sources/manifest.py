"""Outcomes of ingest runs, kept: what was loaded, skipped, missing or broken, and when.

A run appends a row per source. Sources are told apart by the fingerprint of their files
(names, lengths, modification times, from a listing, no file is opened), and one that is as
it was when it last loaded is not read again.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.sources.ingest import Source, load_source

RUNS = "run_id string, source string, status string, rows bigint, columns int, message string, fingerprint string"


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """Of the files under a path; None if there are none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException:
        return None
    seen = F.xxhash64("path", "length", "modificationTime")
    n, size, mixed, total = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(seen), F.sum(F.pmod(seen, F.lit(1 << 31)))).first()
    return f"{n}-{size}-{mixed}-{total}" if n else None


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """All outcomes of all runs."""
    return spark.read.schema(RUNS).parquet(manifest)


def latest(runs: DataFrame, *statuses: str) -> DataFrame:
    """Each source's outcome in the last run (by ``run_id``) that had one of the statuses,
    any status if none is given. Ties within a run cannot be: a run has a source once."""
    kept = runs.filter(F.col("status").isin(*statuses)) if statuses else runs
    last = F.max_by(F.struct(*runs.columns), "run_id")
    return kept.groupBy("source").agg(last.alias("last")).select("last.*")


def ingest_run(
    spark: SparkSession, sources: Mapping[str, Source], folder: str, manifest: str, run_id: str, *, at_once: int = 4
) -> DataFrame:
    """Lands the sources that changed since they last loaded, appends the outcome of every
    one to the manifest, and returns these rows. Run ids have to rise from run to run; a
    run that is repeated appends again, with everything unchanged. A source that is missing
    or broken is recorded, its table stays, and the others go on."""
    try:
        before = latest(read_manifest(spark, manifest), "loaded", "empty", "unchanged")
        known = {r.source: r.fingerprint for r in before.filter(F.col("source").isin(*sources)).collect()}
    except AnalysisException:  # the first run
        known = {}

    def one(item: tuple[str, Source]) -> tuple:
        name, source = item
        now = fingerprint(spark, source.path)
        if now is not None and now == known.get(name):
            return run_id, name, "unchanged", 0, 0, "not read again", now
        return run_id, name, *load_source(spark, source, f"{folder}/{name}"), now

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(one, sources.items()))
    outcome = spark.createDataFrame(rows, RUNS)
    outcome.coalesce(1).write.mode("append").parquet(manifest)
    return outcome
