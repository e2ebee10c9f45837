"""Exact deduplication by progressive refinement.

Rows are grouped by length, then by a hash of their first characters, and only rows that
still share a group are hashed in full. Group counts are reduced in the tasks before the
shuffle. The surviving (length, prefix) groups travel back to the scan as a bitmap of
fixed size, so no text is shuffled: a row whose bit is unset is alone for certain, one
whose bit is set is hashed and settles by its full hash. With more groups than bits the
bitmap only lets more rows through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import fresh, marked, numbered, whole_text, without_rows
from payscope.session import materialize

#: Characters of the prefix hash, and bits of the bitmap (a million: 128 KiB).
PREFIX_CHARS = 256
BITMAP_BITS = 1 << 20


def _slot(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(BITMAP_BITS))


def fingerprints(docs: DataFrame, text: str = "text", digests: bool = False) -> DataFrame:
    """``docs`` with ``_len``, ``_prefix`` and ``_sha``; the last is null on rows that are
    alone after length and prefix. ``digests`` adds ``_digest``, the hash of every row."""
    body = whole_text(text)
    length, prefix = F.octet_length(body), F.xxhash64(F.substring(body, 1, PREFIX_CHARS))
    sizes = docs.select(length.alias("len"), prefix.alias("prefix")).groupBy("len", "prefix").agg(F.count("*").alias("n"))
    # A length shared by one row only can't survive by its prefix either.
    survivors = sizes.filter("n > 1").select(_slot(F.col("len"), F.col("prefix")).alias("slot"))
    told = marked(docs.withColumns({"_len": length, "_prefix": prefix}), _slot(length, prefix), survivors, "_alive")
    return (
        told.withColumns({"_digest": F.unhex(F.sha2(body, 256))} if digests else {})
        .withColumn("_sha", F.when(F.col("_alive"), F.col("_digest") if digests else F.unhex(F.sha2(body, 256))))
        .drop("_alive")
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False, number: str | None = None) -> DataFrame:
    """One row per row of ``docs``: key, ``row``, ``keep_id``, ``group_size``, ``kept``;
    with ``digests`` also ``digest``, the SHA-256 of every text, for which singles are
    hashed too.

    Of rows with equal texts that with the largest key stays (a null key is the
    smallest); of rows that are equal in both, one. Null texts are empty ones and equal
    to them. An empty table gives an empty result; other columns are left out. ``row`` is
    the column ``number``; without one rows are numbered here, and a later scan of ``docs``
    need not number them alike.
    """
    ident, row = F.col(key).alias("id"), (F.col(number) if number else F.monotonically_increasing_id()).alias("row")
    more = [F.col("_digest").alias("digest")] if digests else []
    slim = fingerprints(docs.select(ident, row, whole_text(text).alias("text")), digests=digests)
    slim = slim.select("id", "row", "_len", "_prefix", "_sha", *more)
    slim = materialize(slim, "rows")
    found = F.col("_sha").isNotNull()
    groups = (
        slim.filter(found)
        .groupBy("_len", "_prefix", "_sha")
        .agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    # Written, so that the join reads both sides through exchanges of its own and a group
    # with a third of all rows can be split between tasks.
    groups = materialize(groups, "groups")
    # Rows that are alone take no part in the join, nor do they crowd its null key.
    settled = slim.filter(found).join(groups, ["_len", "_prefix", "_sha"], "left")
    shared = settled.select(
        "id", "row",
        F.when(F.col("n") > 1, F.col("best.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
        *(["digest"] if digests else []),
    )
    alone = slim.filter(~found).select(
        "id", "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        *(["digest"] if digests else []),
    )
    return shared.unionByName(alone).withColumnRenamed("id", key)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops, all columns as they were."""
    row = fresh(docs, "_row")
    docs = numbered(docs, row)
    return without_rows(docs, materialize(exact_groups(docs, key, text, number=row).filter(~F.col("kept")).select("row"), "dropped"), row)
