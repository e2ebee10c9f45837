"""The comparable set of entities and its split by medians."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.clean import any_present


def analytic_filter(volume: str, minimum: int, flag: str, present: Sequence[str]) -> Column:
    """Enough volume, flag known and true, and all of ``present`` there."""
    keep = (F.col(volume) >= minimum) & F.coalesce(F.col(flag), F.lit(False))
    for c in present:
        keep = keep & any_present(F.col(c))
    return F.coalesce(keep, F.lit(False))


def analytic_set(
    df: DataFrame, volume: str, minimum: int, flag: str, present: Sequence[str]
) -> DataFrame:
    return df.filter(analytic_filter(volume, minimum, flag, present))


def analytic_counts(
    df: DataFrame, volume: str, minimum: int, flag: str, present: Sequence[str]
) -> DataFrame:
    """Rows, kept and excluded, in one pass."""
    keep = analytic_filter(volume, minimum, flag, present)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(keep).alias("n_kept"),
        F.count_if(~keep).alias("n_excluded"),
    )


def median_split(
    df: DataFrame,
    medians: DataFrame,
    splits: Mapping[str, tuple[str, str, str]],
    name: str,
    separator: str = " / ",
) -> DataFrame:
    """Label rows by which side of one-row thresholds they lie on.

    ``splits`` maps a threshold column of ``medians`` to (value column, label at or
    above, label below). The thresholds are a scalar subquery, not a join.
    """
    cut = medians.select(F.struct(*splits)).scalar()
    return (
        df.withColumn("_cut", cut)
        .withColumn(name, F.concat_ws(separator, *_sides(splits)))
        .drop("_cut")
    )


def _sides(splits: Mapping[str, tuple[str, str, str]]) -> Sequence[Column]:
    return [
        F.when(F.col(value) >= F.col(f"_cut.{threshold}"), above).otherwise(below)
        for threshold, (value, above, below) in splits.items()
    ]


def listing(
    df: DataFrame,
    label: str,
    wanted: str,
    order: Sequence[str],
    columns: Sequence[str],
    clip: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows of one label in order, long text cut to the given widths."""
    shown = [
        F.substring(c, 1, clip[c]).alias(c) if clip and c in clip else F.col(c) for c in columns
    ]
    return df.filter(F.col(label) == wanted).orderBy(*order).select(*shown)
