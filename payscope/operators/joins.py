"""Joins at entity grain and lookups of small dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spine_join(spine: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Every spine row once, with the columns of the others where the key matches.

    Sides that come out of aggregations on ``key`` share its hash partitioning and need
    no second shuffle; small sides are broadcast by their measured size.
    """
    out = spine
    for other in others:
        out = out.join(other, key, "left")
    return out


def full_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All keys of both sides, the key taken from whichever side has it."""
    return left.join(right, key, "full")


def dimension_lookup(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Attach the columns of a dimension unique on ``key``; unmatched rows keep NULLs.

    The optimiser broadcasts a dimension that it measures as small, and splits skewed
    keys of ``df`` otherwise.
    """
    return df.join(dimension, key, "left")


def with_identity(df: DataFrame, identity: Mapping[str, str | None]) -> DataFrame:
    """Constant columns naming where the rows came from; filters on them fold away
    whole branches of a later union."""
    return df.withColumns({name: F.lit(v).cast("string") for name, v in identity.items()})


def longest_prefix(df: DataFrame, code: str, prefixes: DataFrame, label: str, lengths: Sequence[int] | None = None) -> DataFrame:
    """``df`` with the ``label`` of the longest entry of ``prefixes`` (columns ``prefix`` and
    the label) that its code begins with; NULL if none does. Of equal prefixes the least
    label counts; an empty prefix fits every code that is there.

    One equality join per length of prefix, so Spark broadcasts or shuffles them by their
    size, and no row meets more than one entry of a length. ``lengths`` are found in a pass
    over the prefixes if not given."""
    sized = prefixes.groupBy("prefix").agg(F.min(label).alias("_label")).withColumn("_size", F.length("prefix"))
    if lengths is None:
        lengths = [r[0] for r in sized.select("_size").filter("_size is not null").distinct().collect()]
    found = []
    for n in sorted(lengths, reverse=True):
        here = sized.filter(F.col("_size") == n).select(F.col("prefix").alias(f"_prefix{n}"), F.col("_label").alias(f"_label{n}"))
        fits = F.when(F.length(code) >= n, F.left(F.col(code), F.lit(n)))
        df = df.join(here, fits == F.col(f"_prefix{n}"), "left").drop(f"_prefix{n}")
        found.append(f"_label{n}")
    best = F.coalesce(*found) if found else F.lit(None).cast(prefixes.schema[label].dataType)
    return df.withColumn(label, best).drop(*found)
