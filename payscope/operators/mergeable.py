"""States that are stored per part and united later: distinct counts and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's registers; the standard error is 1.04 over the root of their
#: number, here 1.6 %.
LOG_REGISTERS = 12


def error_bound(log_registers: int = LOG_REGISTERS, sigmas: float = 3.0) -> float:
    """Share by which an estimate may be off, but for one case in some hundreds (3 sigmas)."""
    return sigmas * 1.04 / 2 ** (log_registers / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], item: str, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Per group a sketch of its different items (a few kilobytes each) and its rows. Sketches
    of parts, of days or of sources can be stored and united; NULL items don't count."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(item, log_registers).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of ``distinct_sketches`` as those of larger groups, or of all."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"))


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketches' estimates in their place."""
    return sketches.withColumn("sketch", F.hll_sketch_estimate("sketch")).withColumnRenamed("sketch", "n_distinct")


STATE = ("n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy")


def co_moments(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group the centred state of two columns over rows where both are there: count,
    means, sums of squares and of products around them. Nothing is squared before it is
    centred, so large values far from zero lose no digits."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
    n = F.count(a)
    return df.groupBy(*by).agg(
        n.alias("n"), F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"),
        (F.var_pop(a) * n).alias("m2_x"), (F.var_pop(b) * n).alias("m2_y"), (F.covar_pop(a, b) * n).alias("c_xy"),
    )


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of ``co_moments`` as those of larger groups, or of all, without the rows. The
    spread of the groups' means is taken as the variance of the means, weighted by n, which
    is centred in turn."""
    held = states.filter("n > 0")
    total = F.sum("n").alias("n")
    means = held.groupBy(*by).agg(
        total, (F.sum(F.col("n") * F.col("mean_x")) / F.sum("n")).alias("all_x"), (F.sum(F.col("n") * F.col("mean_y")) / F.sum("n")).alias("all_y")
    )
    if by:
        placed = held.join(means.drop("n"), list(by))
    else:
        placed = held.withColumns({c: means.select(c).scalar() for c in ("all_x", "all_y")})
    dx, dy, n = F.col("mean_x") - F.col("all_x"), F.col("mean_y") - F.col("all_y"), F.col("n")
    return placed.groupBy(*by, "all_x", "all_y").agg(
        total, F.sum(F.col("m2_x") + n * dx * dx).alias("m2_x"), F.sum(F.col("m2_y") + n * dy * dy).alias("m2_y"),
        F.sum(F.col("c_xy") + n * dx * dy).alias("c_xy"),
    ).select(*by, "n", F.col("all_x").alias("mean_x"), F.col("all_y").alias("mean_y"), "m2_x", "m2_y", "c_xy")


def without_each(states: DataFrame, by: str) -> DataFrame:
    """Per group, the state of all rows that are not in it: the whole's less its own."""
    both = states.filter("n > 0").withColumn("w", merged(states).select(F.struct(*STATE)).scalar())
    w = lambda c: F.col(f"w.{c}")
    n, left = F.col("n"), w("n") - F.col("n")
    share = F.try_divide(n * w("n"), left)
    dx, dy = F.col("mean_x") - w("mean_x"), F.col("mean_y") - w("mean_y")
    return both.select(
        by,
        left.alias("n"),
        (w("mean_x") - F.try_divide(n, left) * dx).alias("mean_x"),
        (w("mean_y") - F.try_divide(n, left) * dy).alias("mean_y"),
        (w("m2_x") - F.col("m2_x") - share * dx * dx).alias("m2_x"),
        (w("m2_y") - F.col("m2_y") - share * dy * dy).alias("m2_y"),
        (w("c_xy") - F.col("c_xy") - share * dx * dy).alias("c_xy"),
    )


def pearson_of() -> Column:
    """The correlation of a state; NULL where a column doesn't vary or a row is alone."""
    spread = F.when((F.col("n") > 1) & (F.col("m2_x") > 0) & (F.col("m2_y") > 0), F.sqrt(F.col("m2_x")) * F.sqrt(F.col("m2_y")))
    return F.try_divide(F.col("c_xy"), spread)
