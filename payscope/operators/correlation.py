"""Correlation overall and per group, with p-values, in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.functions.statistics import pair_count, pearson, pearson_p_value

# Fixed value: fewest pairs for which a correlation is reported.
MIN_PAIRS = 6


def correlations(
    df: DataFrame,
    pairs: Mapping[str, tuple[str, str]],
    by: str | None = None,
    *,
    overall: str = "ALL",
    min_pairs: int = MIN_PAIRS,
) -> DataFrame:
    """Pearson r, p and n per pair of columns (name -> (x, y)), for all rows and, with
    ``by``, for each group. Groups with fewer than ``min_pairs`` pairs give no row.

    Output columns: pair, scope, n, r, p. The overall row is one more grouping set of
    the same aggregation, reduced before the shuffle like every group.
    """
    if by is None:
        grouped = df.groupBy(F.lit(overall).alias("scope"))
    else:
        scoped = df.withColumn("scope", F.col(by).cast("string"))
        grouped = scoped.groupingSets([["scope"], []], "scope")
    moments = grouped.agg(
        *([] if by is None else [F.grouping("scope").alias("_all")]),
        *(
            F.struct(
                F.lit(name).alias("pair"),
                pair_count(F.col(x), F.col(y)).alias("n"),
                pearson(F.col(x), F.col(y)).alias("r"),
            ).alias(f"_p{i}")
            for i, (name, (x, y)) in enumerate(pairs.items())
        ),
    )
    if by is not None:
        moments = moments.withColumn(
            "scope", F.when(F.col("_all") == 1, overall).otherwise(F.col("scope"))
        )
    rows = F.array(*(F.col(f"_p{i}") for i in range(len(pairs))))
    return (
        moments.select("scope", F.inline(rows))
        .filter(F.col("n") >= min_pairs)
        .select("pair", "scope", "n", "r", pearson_p_value(F.col("r"), F.col("n")).alias("p"))
    )


def headline(
    found: DataFrame, *, direction_cutoff: float = 0.1, significant: float = 0.001
) -> DataFrame:
    """Reading of each correlation: sign, direction at the cut-off, p as it is quoted,
    and a sentence with all three. Every part is computed from r, p and n."""
    r, p = F.col("r"), F.col("p")
    return (
        found.withColumn("sign", F.when(r > 0, "positive").otherwise("negative or zero"))
        .withColumn(
            "direction",
            F.when(r > direction_cutoff, "rises together")
            .when(r < -direction_cutoff, "moves opposite")
            .otherwise("little or no linear link"),
        )
        .withColumn(
            "p_text",
            F.when(p < significant, F.lit(f"p<{significant:g}")).otherwise(
                F.concat(F.lit("p="), F.format_number(p, 4))
            ),
        )
        .withColumn(
            "statement",
            F.concat_ws(
                " ",
                F.concat(F.lit("r="), F.format_number(r, 2)),
                F.concat(F.lit("("), F.col("p_text"), F.lit(")")),
                F.concat(F.lit("n="), F.col("n").cast("string")),
                F.col("direction"),
            ),
        )
    )
