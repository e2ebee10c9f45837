"""Exact interpolated quantiles by distributed rank selection.

Equal values are counted together first, with partial counts in the tasks, so a value that
fills a third of the table is one row; these counts are written once and everything else
reads them. Counts per bucket of values, cut by their logarithm, give the bucket that holds
each wanted rank. A bucket with few different values is put in order. One with more is cut
into cells of equal width between the least and largest value left in it, their counts give
the cell with the rank, and so on until few are left; four times at most, since a bucket's
doubles differ in 48 bits. So no window sees more than ``WINDOW_ROWS`` rows or the fixed
number of buckets, whatever the values, and nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payscope.functions.statistics import relative_gap
from payscope.session import materialize

#: Most different values that are put in order in one place, and cells of a refinement.
WINDOW_ROWS = 1 << 16

# Buckets per power of two, and a number above all of a double's powers, in buckets.
_FINE = 16
_FAR = 1100 * _FINE


def _bucket(value: Column) -> Column:
    """Number of the bucket, which never falls as the value rises; infinities have their
    own, and NaN is the largest."""
    size = F.floor(F.log2(F.abs(value)) * _FINE) + _FAR
    infinite = F.lit(float("inf"))
    return (
        F.when(value.isNull(), F.lit(None))
        .when(F.isnan(value), F.lit(4 * _FAR))
        .when(value == infinite, F.lit(3 * _FAR))
        .when(value == -infinite, F.lit(-3 * _FAR))
        .when(value == 0, F.lit(0))
        .when(value > 0, size)
        .otherwise(-size)
        .cast("bigint")
    )


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(g, c, v, n), written: how often each value of each column occurs in each group."""
    group = F.struct(*by) if by else F.lit(0)
    cells = [F.struct(F.lit(n).alias("c"), F.col(n).cast("double").alias("v")) for n in sorted(set(columns))]
    counted = df.select(group.alias("g"), F.inline(F.array(*cells))).groupBy("g", "c", "v").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted, "counts")


def _sized(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.count("v").alias("different"), F.min("v").alias("least"), F.max("v").alias("most")
    )


def _watched(targets: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """The targets, written, and whether one still has too many values to put in order."""
    targets = materialize(targets, "targets")
    return targets, (targets.agg(F.max("different")).first()[0] or 0) > limit


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, tuple[str, float]], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles with linear interpolation, NULLs skipped, one row per group.

    ``wanted`` maps an output name to (column, probability). A group of nothing but NULLs
    has NULL quantiles; without ``by`` an empty table gives one row of NULLs.
    """
    counted = value_counts(df, [c for c, _ in wanted.values()], by)
    return quantiles_of_counts(counted, wanted, by)


def quantiles_of_counts(
    counted: DataFrame, wanted: Mapping[str, tuple[str, float]], by: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """``exact_quantiles`` from the counts that ``value_counts`` wrote."""
    c, limit = F.col, limit or WINDOW_ROWS
    counted = counted.withColumn("bucket", _bucket(c("v")))
    own = Window.partitionBy("g", "c")
    held = F.when(c("bucket").isNotNull(), c("n")).otherwise(0)
    placed = _sized(counted, "g", "c", "bucket").select(
        "*",
        F.sum(held).over(own.orderBy(F.asc_nulls_first("bucket"))).alias("upto"),
        F.sum(held).over(own).alias("total"),
    )
    listed = F.array(
        *(F.struct(F.lit(n).alias("name"), F.lit(of).alias("of"), F.lit(p).alias("p")) for n, (of, p) in wanted.items())
    )
    ends = F.array(
        F.struct(F.floor("position").alias("rank"), F.lit(False).alias("upper")),
        F.struct(F.ceil("position").alias("rank"), F.lit(True).alias("upper")),
    )
    # A target per group, quantile and end, and a row without one for a group of NULLs.
    picked = (
        placed.select("*", F.inline(listed))
        .filter(c("of") == c("c"))
        .withColumn("position", F.when(c("total") > 0, c("p") * (c("total") - 1)))
        .select("*", (c("upto") - c("n")).alias("before"), F.inline(ends))
        .filter((c("total") == 0) | c("bucket").isNotNull() & (c("before") <= c("rank")) & (c("rank") < c("upto")))
        .select("g", "c", "bucket", "name", "upper", "position", "rank", "before", "different", "least", "most")
    )
    targets, open_ones = _watched(picked, limit)
    while open_ones:
        targets, open_ones = _watched(_refined(targets, counted, limit), limit)

    inside = Window.partitionBy("g", "name", "upper").orderBy("v")
    values = (
        _values_of(targets.filter(c("rank").isNotNull()), counted)
        .withColumn("upto", c("before") + F.sum("n").over(inside))
        .filter(c("upto") > c("rank"))
        .groupBy("g", "name", "position")
        .agg(F.min(F.when(~c("upper"), c("v"))).alias("v0"), F.min(F.when(c("upper"), c("v"))).alias("v1"))
    )
    lower, upper = F.floor("position"), F.ceil("position")
    value = F.when(lower == upper, c("v0")).otherwise(
        (upper - c("position")) * c("v0") + (c("position") - lower) * c("v1")
    )
    none = targets.filter(c("rank").isNull()).select("g", "name", F.lit(None).cast("double").alias("quantile"))
    found = values.select("g", "name", value.alias("quantile")).unionByName(none)
    columns = [F.max(F.when(c("name") == n, c("quantile"))).alias(n) for n in wanted]
    if not by:
        return found.agg(*columns)
    return found.groupBy("g").agg(*columns).select(*(f"g.{x}" for x in by), *wanted)


def _values_of(targets: DataFrame, counted: DataFrame) -> DataFrame:
    """Each target with the values that are left for it. NaN is alone in its bucket."""
    left = targets.join(counted.select("g", "c", "bucket", "v", "n"), ["g", "c", "bucket"])
    return left.filter((F.col("v") >= F.col("least")) & (F.col("v") <= F.col("most")))


def _refined(targets: DataFrame, counted: DataFrame, limit: int) -> DataFrame:
    """Targets with too many values narrowed to the cell that holds their rank."""
    c = F.col
    wide = F.coalesce(c("different"), F.lit(0)) > limit
    # Neither difference nor quotient ever falls as the value rises.
    cell = F.least(F.floor((c("v") - c("least")) / (c("most") - c("least")) * limit), F.lit(limit - 1))
    keys = ["g", "c", "bucket", "name", "upper", "position", "rank", "before"]
    cells = _sized(_values_of(targets.filter(wide), counted).withColumn("cell", cell).drop("least", "most"), *keys, "cell")
    upto = c("before") + F.sum("n").over(Window.partitionBy("g", "name", "upper").orderBy("cell"))
    narrowed = (
        cells.withColumn("upto", upto)
        .withColumn("before", c("upto") - c("n"))
        .filter((c("before") <= c("rank")) & (c("rank") < c("upto")))
        .select(*targets.columns)
    )
    return targets.filter(~wide).unionByName(narrowed)


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample standard deviation, min, exact quartiles, max as one row, all
    from one count of the values."""
    counted, kind = value_counts(df, [column]), df.schema[column].dataType
    quartiles = quantiles_of_counts(counted, {"q1": (column, 0.25), "median": (column, 0.5), "q3": (column, 0.75)})
    q = quartiles.select(F.struct("q1", "median", "q3")).scalar()
    # Whole numbers may be larger than a double holds; their ends are taken from the rows.
    if isinstance(kind, (T.LongType, T.DecimalType)):
        found = df.agg(F.min(column).alias("min"), F.max(column).alias("max"))
        ends = {e: found.select(e).scalar() for e in ("min", "max")}
    else:
        ends = {e: F.col(e).cast(kind) for e in ("min", "max")}
    v, n = F.col("v"), F.col("n")
    present = counted.filter(v.isNotNull())
    mean = present.agg(F.try_divide(F.sum(v * n), F.sum(n))).scalar()
    return (
        present.select(v, n, mean.alias("m"))
        .agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("count"),
            F.max("m").alias("mean"),
            F.sqrt(F.try_divide(F.sum(n * F.pow(v - F.col("m"), F.lit(2))), F.sum(n) - 1)).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )
        .withColumn("q", q)
        .withColumns(ends)
        .select("count", "mean", "std", "min", "q.q1", "q.median", "q.q3", "max")
    )


def group_medians(
    df: DataFrame, by: str, medians: Mapping[str, str]
) -> DataFrame:
    """Rows and exact medians per group (output name -> column)."""
    counted = value_counts(df, list(medians.values()), [by])
    found = quantiles_of_counts(counted, {n: (c, 0.5) for n, c in medians.items()}, [by])
    # Each column's counts add up to all rows of the group, as they hold NULL as well.
    one = min(medians.values())
    counts = counted.filter(F.col("c") == one).groupBy(F.col(f"g.{by}").alias("key")).agg(F.sum("n").alias("n"))
    return counts.join(found, F.col("key").eqNullSafe(F.col(by))).select(by, "n", *medians)


def median_gap(
    df: DataFrame, by: str, value: str, upper: str, base: str
) -> DataFrame:
    """Medians of two groups and how far the first lies above the second."""
    both = df.filter(F.col(by).isin(upper, base))
    medians = exact_quantiles(both, {"median": (value, 0.5)}, [by])
    pick = lambda name: F.max(F.when(F.col(by) == name, F.col("median")))
    return medians.agg(
        pick(upper).alias("median_upper"), pick(base).alias("median_base")
    ).withColumn("gap", relative_gap(F.col("median_upper"), F.col("median_base")))
