"""Aggregations to one row per entity, and profiles of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.clean import trimmed


def dependent_attributes(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One value per key of columns that depend on it: the least non-null one, so the
    answer does not change with the order of rows.

    ``min`` over strings aggregates by sorting its whole input. Grouping by the
    combinations first is a hash aggregate, and leaves that sort one row or a few per
    key. The count keeps the optimiser from folding the two steps into one.
    """
    combinations = df.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        combinations.groupBy(key)
        .agg(*(F.min(a).alias(a) for a in attributes), F.sum("_rows").alias("_rows"))
        .filter("_rows > 0")
        .drop("_rows")
    )


def with_attributes(
    df: DataFrame, source: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Put the dependent attributes of ``source`` beside a result with one row per key.
    A NULL key is a group like any other."""
    found = dependent_attributes(source, key, attributes)
    others = [c for c in df.columns if c != key]
    joined = found.join(df, found[key].eqNullSafe(df[key]))
    return joined.select(found[key], *attributes, *others)


def cost_by_entity(
    df: DataFrame,
    key: str,
    value: str,
    weight: str,
    item: str,
    *,
    attributes: Sequence[str] = (),
    also_mean: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
    digits: int = 2,
) -> DataFrame:
    """Volume-weighted and simple means per entity over rows with a value and a
    positive weight.

    Output: key, attributes, then ``n_items``, ``total_weight``, ``weighted_value``,
    ``simple_value`` (renamed through ``names``) and one mean per ``also_mean`` entry
    (output name -> column). Attributes depend on the key; the least non-null one is
    taken, so the answer does not change with the order of rows. The table is read once:
    sums per key, attributes and item are rolled up to the key, so ``min`` over strings,
    which sorts its input, sees these few rows.
    """
    usable = df.filter(
        F.col(value).isNotNull() & F.col(weight).isNotNull() & (F.col(weight) > 0)
    )
    names = names or {}
    label = lambda n: names.get(n, n)
    means = {label("simple_value"): value, **(also_mean or {})}
    sums = {"_weight": F.col(weight), "_weighted": F.col(value) * F.col(weight)}
    parts = usable
    if attributes:
        sums |= {f"_s{i}": F.col(c) for i, c in enumerate(means.values())}
        parts = usable.groupBy(key, *attributes, item).agg(
            *(F.sum(c).alias(n) for n, c in sums.items()),
            *(F.count(c).alias(f"_n{i}") for i, c in enumerate(means.values())),
        )
        mean = [F.try_divide(F.sum(f"_s{i}"), F.sum(f"_n{i}")) for i in range(len(means))]
    else:
        parts = usable.withColumns(sums)
        mean = [F.avg(c) for c in means.values()]
    return parts.groupBy(key).agg(
        *(F.min(a).alias(a) for a in attributes),
        F.count_distinct(item).alias(label("n_items")),
        F.sum("_weight").cast("bigint").alias(label("total_weight")),
        F.round(F.try_divide(F.sum("_weighted"), F.sum("_weight")), digits).alias(label("weighted_value")),
        *(F.round(m, digits).alias(n) for n, m in zip(means, mean)),
    )


def pivot_mean(
    df: DataFrame,
    key: str,
    measure: str,
    value: str,
    columns: Mapping[str, str],
    *,
    extra: Sequence[Column] = (),
    digits: int = 4,
) -> DataFrame:
    """Mean of ``value`` per named measure, one column each (output name -> measure).
    The names are listed, so no pass is spent on finding them."""
    return df.groupBy(key).agg(
        *extra,
        *(
            F.round(F.avg(F.when(F.col(measure) == m, F.col(value))), digits).alias(name)
            for name, m in columns.items()
        ),
    )


def measures_by_entity(
    df: DataFrame,
    key: str,
    measure: str,
    value: str,
    core: Mapping[str, str],
    *,
    value_name: str = "avg_value",
    digits: int = 4,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Measure rows to one row per entity: distinct measures, mean value, number of rows
    among the core measures, and one mean per core measure. A row without a value counts
    for none of them; an entity with such rows only has no mean."""
    held = F.col(value).isNotNull()
    return pivot_mean(
        df,
        key,
        measure,
        value,
        core,
        extra=[
            F.count_distinct(F.when(held, F.col(measure))).alias("n_measures"),
            F.round(F.avg(value), digits).alias(value_name),
            F.count_if(held & F.col(measure).isin(*core.values())).alias("n_core_measures"),
            *extra,
        ],
        digits=digits,
    )


def summary_row_max(
    df: DataFrame, key: str, measure: str, summary: str, value: str, name: str
) -> DataFrame:
    """The value of one designated summary row per entity (the largest if repeated)."""
    return (
        df.filter((F.col(measure) == summary) & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.max(value).alias(name))
    )


def threshold_counts(df: DataFrame, column: str, thresholds: Sequence[int]) -> DataFrame:
    """Rows at or above each threshold, all counted in one pass."""
    counted = df.agg(
        *(F.count_if(F.col(column) >= t).alias(f"at_least_{t}") for t in thresholds)
    )
    pairs = F.array(
        *(
            F.struct(F.lit(t).cast("bigint").alias("threshold"), F.col(f"at_least_{t}").alias("n"))
            for t in thresholds
        )
    )
    return counted.select(F.inline(pairs))


def category_counts(df: DataFrame, category: str, name: str = "n") -> DataFrame:
    """Rows per category, most frequent first; ties by category."""
    return (
        df.groupBy(category)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), category)
    )


def value_profile(df: DataFrame, text: str, listed: Sequence[str]) -> DataFrame:
    """Rows and share of each listed placeholder, of NULL, and of everything else."""
    found = trimmed(F.col(text))
    label = (
        F.when(found.isNull(), "(null)")
        .when(found == "", "(blank)")
        .when(found.isin(*listed), found)
        .otherwise("(value)")
    )
    counted = df.groupBy(label.alias("placeholder")).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counted.agg(F.sum("n_rows")).scalar()
    return counted.select(
        "placeholder", "n_rows", F.round(F.col("n_rows") / total, 6).alias("share")
    )


def key_coverage(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct keys per source (name -> (table, key column))."""
    parts = [
        df.agg(
            F.lit(name).alias("source"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(key).alias("n_keys"),
        )
        for name, (df, key) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cell_mean_gap(
    df: DataFrame, category: str, value: str, low: str, high: str
) -> DataFrame:
    """Means of two cells, their difference, and the difference in percent of the low
    cell. No row when either cell is empty."""
    cell = lambda name: F.when(F.col(category) == name, F.col(value))
    return (
        df.agg(
            F.count(cell(low)).alias("n_low"),
            F.count(cell(high)).alias("n_high"),
            F.avg(cell(low)).alias("mean_low"),
            F.avg(cell(high)).alias("mean_high"),
        )
        .filter((F.col("n_low") > 0) & (F.col("n_high") > 0))
        .withColumn("gap", F.col("mean_high") - F.col("mean_low"))
        .withColumn("gap_pct", F.try_divide(F.col("gap"), F.col("mean_low")) * 100)
    )
