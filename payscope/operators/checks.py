"""Data checks. A check is a DataFrame of failing rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# Sample rows kept per failed check, and the kinds of failure.
SAMPLE_ROWS = 15
UNCLEAR, SOURCE, DATA, CONFIG = (
    "unclear",
    "upstream-source-change",
    "genuine-data-issue",
    "test-config-too-strict",
)


def _scoped(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.filter(where)


def not_null(df: DataFrame, column: str, where: Column | str | None = None) -> DataFrame:
    return _scoped(df, where).filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str, where: Column | str | None = None) -> DataFrame:
    """Non-null keys that occur more than once, with their row count."""
    present = _scoped(df, where).dropna(subset=list(columns))
    return (
        present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def accepted_range(
    df: DataFrame,
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Rows outside the bounds, which are inclusive and both optional. NULL passes."""
    outside = F.lit(False)
    if minimum is not None:
        outside = outside | (F.col(column) < minimum)
    if maximum is not None:
        outside = outside | (F.col(column) > maximum)
    return _scoped(df, where).filter(outside)


def accepted_values(
    df: DataFrame, column: str, values: Sequence, where: Column | str | None = None
) -> DataFrame:
    """Unlisted values with their row count. NULL passes."""
    return (
        _scoped(df, where)
        .filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def implies(
    df: DataFrame, premise: Column, conclusion: Column, columns: Sequence[str]
) -> DataFrame:
    """Rows where the premise holds and the conclusion does not."""
    return df.filter(premise & ~F.coalesce(conclusion, F.lit(False))).select(*columns)


def row_preservation(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of each (raw, staged) pair and whether they agree."""
    n = F.count(F.lit(1))
    parts = [
        raw.agg(F.lit(name).alias("table"), n.alias("n_raw")).withColumn(
            "n_staged", staged.agg(n).scalar()
        )
        for name, (raw, staged) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("n_raw") == F.col("n_staged"), "OK").otherwise("MISMATCH")
    )


class StageCounts:
    """Rows that go through each stage of a job, observed while it runs: no stage is
    scanned again to be counted."""

    def __init__(self):
        self._observed: dict[str, tuple[DataFrame, Observation]] = {}

    def through(self, stage: str, df: DataFrame) -> DataFrame:
        """``df``, whose rows are counted as ``stage`` by the next action on it."""
        seen = Observation()
        self._observed[stage] = df, seen
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def preserved(self, spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
        """``row_preservation`` of (earlier, later) stages, after the action. A stage whose
        tasks ran again, since an executor was lost, may be observed twice; so stages that
        don't agree are counted by a scan, and what agrees needs none."""
        seen = {stage: o.get["n"] for stage, (_, o) in self._observed.items()}
        for stage in {s for a, z in pairs if seen[a] != seen[z] for s in (a, z)}:
            seen[stage] = self._observed[stage][0].count()
        rows = [(f"{a} to {z}", seen[a], seen[z], "OK" if seen[a] == seen[z] else "MISMATCH") for a, z in pairs]
        return spark.createDataFrame(rows, "table string, n_raw long, n_staged long, status string")


def key_integrity(df: DataFrame, key: str, required: str) -> DataFrame:
    """Rows, distinct keys, missing keys, missing required values, and uniqueness."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.count_if(F.col(key).isNull()).alias("n_null_key"),
        F.count_if(F.col(required).isNull()).alias("n_null_required"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def totals_match(
    df: DataFrame, key: str, expected_rows: int, expected_keys: int, tolerance: float = 0.0
) -> DataFrame:
    """Rows and distinct keys against expectation; rows may differ by a share."""
    off = F.abs(F.col("n_rows") - expected_rows)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys")
    ).withColumn(
        "matches",
        (off <= F.lit(tolerance * expected_rows)) & (F.col("n_keys") == expected_keys),
    )


def reproduces(
    found: DataFrame, expected: Mapping[str, tuple[float, float]], tolerance: float
) -> DataFrame:
    """Each correlation against its expected r and largest or smallest p.

    ``expected`` maps a pair to (r, p bound); a bound below 0.05 must not be exceeded,
    a larger one must be reached (the pair is expected not to be significant).
    """
    rows = found.filter(F.col("pair").isin(*expected))
    r = F.lit(None).cast("double")
    p_holds = F.lit(None).cast("boolean")
    for pair, (want, bound) in expected.items():
        here = F.col("pair") == pair
        r = F.when(here, F.lit(want)).otherwise(r)
        holds = F.col("p") <= bound if bound < 0.05 else F.col("p") >= bound
        p_holds = F.when(here, holds).otherwise(p_holds)
    return (
        rows.withColumn("expected_r", r)
        .withColumn("r_matches", F.abs(F.col("r") - F.col("expected_r")) <= tolerance)
        .withColumn("p_matches", p_holds)
    )


def inventory(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """Tables and views per database, from the catalog. A few rows per database."""
    rows = [(d, len(spark.catalog.listTables(d))) for d in databases]
    return spark.createDataFrame(rows, "database string, n_objects bigint")


def failing_rows(checks: Mapping[str, DataFrame]) -> DataFrame:
    """All failing rows of all checks as one table: check_name, failing_row (JSON)."""
    parts = [
        df.select(F.lit(name).alias("check_name"), F.to_json(F.struct("*")).alias("failing_row"))
        for name, df in checks.items()
    ]
    return reduce(DataFrame.union, parts)


@dataclass(frozen=True)
class RowCheck:
    """A row fails where ``fails`` holds; of it ``columns`` are kept."""

    name: str
    fails: Column
    columns: tuple[str, ...]


@dataclass(frozen=True)
class KeyCheck:
    """A key of ``columns`` without NULL fails where it is in ``scope`` (all rows if None)
    and occurs at least ``least`` times; it is kept with its number of rows."""

    name: str
    columns: tuple[str, ...]
    least: int = 2
    scope: Column | None = None


def missing(name: str, column: str, columns: Sequence[str], where: Column | None = None) -> RowCheck:
    """``not_null`` as a row check."""
    return RowCheck(name, _within(where, F.col(column).isNull()), tuple(columns))


def outside(
    name: str, column: str, minimum: float | None, maximum: float | None, columns: Sequence[str], where: Column | None = None
) -> RowCheck:
    """``accepted_range`` as a row check."""
    bounds = [F.col(column) < minimum] if minimum is not None else []
    bounds += [F.col(column) > maximum] if maximum is not None else []
    return RowCheck(name, _within(where, reduce(Column.__or__, bounds, F.lit(False))), tuple(columns))


def repeated(name: str, *columns: str, where: Column | None = None) -> KeyCheck:
    """``unique`` as a key check."""
    return KeyCheck(name, columns, 2, where)


def unlisted(name: str, column: str, values: Sequence, where: Column | None = None) -> KeyCheck:
    """``accepted_values`` as a key check."""
    return KeyCheck(name, (column,), 1, _within(where, ~F.col(column).isin(*values)))


def _within(where: Column | None, fails: Column) -> Column:
    return fails if where is None else where & fails


def fused_failures(df: DataFrame, checks: Sequence[RowCheck | KeyCheck]) -> DataFrame:
    """``failing_rows`` of any number of checks from one scan and one aggregate of a table.

    Each row becomes the array of what it says to the checks: the failing row itself, or
    its key. Keys are counted before the shuffle; failing rows go through the same
    aggregate under a number of their own, so equal ones stay apart."""
    said = []
    for check in checks:
        kept = F.to_json(F.struct(*check.columns))
        if isinstance(check, RowCheck):
            holds, own, least = check.fails, F.monotonically_increasing_id(), F.lit(1)
        else:
            present = reduce(Column.__and__, [F.col(c).isNotNull() for c in check.columns])
            holds, own, least = _within(check.scope, present), F.lit(None).cast("long"), F.lit(check.least)
        entry = F.struct(F.lit(check.name).alias("check_name"), kept.alias("kept"), own.alias("row"), least.alias("least"))
        said.append(F.when(F.coalesce(holds, F.lit(False)), entry))
    entries = df.select(F.explode(F.array_compact(F.array(*said))).alias("e")).select("e.*")
    counted = entries.groupBy("check_name", "kept", "row", "least").agg(F.count(F.lit(1)).alias("n")).filter("n >= least")
    with_count = F.concat(F.left("kept", F.length("kept") - 1), F.lit(',"n_rows":'), "n", F.lit("}"))
    return counted.select("check_name", F.when(F.col("row").isNull(), with_count).otherwise(F.col("kept")).alias("failing_row"))


def collect_failures(failing: DataFrame, samples: int = SAMPLE_ROWS) -> DataFrame:
    """Per failed check its row count and its first rows in text order.

    The row number limit is applied within each task before the shuffle, so a check
    that fails on a third of a table still moves ``samples`` rows per task.
    """
    counts = failing.groupBy("check_name").agg(F.count(F.lit(1)).alias("n_failing"))
    order = Window.partitionBy("check_name").orderBy("failing_row")
    first = (
        failing.withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") <= samples)
        .groupBy("check_name")
        .agg(F.array_sort(F.collect_list("failing_row")).alias("samples"))
    )
    return counts.join(first, "check_name")


# Fixed value: as much of a name as has to be found in the other one.
NAME_START = 30


def _stretches(name: str) -> Column:
    """All parts of a name that a start of at most ``NAME_START`` signs can equal."""
    starts = F.sequence(F.lit(1), F.length(name))
    parts = F.transform(
        starts,
        lambda a: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(NAME_START), F.length(name) - a + 1)),
            lambda n: F.substring(F.col(name), a, n),
        ),
    )
    return F.array_distinct(F.flatten(parts))


def match_messages(names: DataFrame, messages: DataFrame) -> DataFrame:
    """(check_name, message) for every name that has one: the start of either name occurs
    in the other. The same name comes first, then the least. Starts are joined on
    equality with the parts of the other names; names are few, one per check."""
    own = names.select("check_name").filter("check_name <> ''").distinct()
    said = messages.select(F.col("check_name").alias("said"), "message").filter("said <> ''")
    start = lambda c: F.left(c, F.lit(NAME_START))
    in_said = own.withColumn("part", start(F.col("check_name"))).join(
        said.withColumn("part", F.explode(_stretches("said"))), "part"
    )
    in_own = own.withColumn("part", F.explode(_stretches("check_name"))).join(
        said.withColumn("part", start(F.col("said"))), "part"
    )
    order = F.struct(F.col("check_name") != F.col("said"), "said", "message")
    best = in_said.unionByName(in_own).groupBy("check_name").agg(F.min(order).alias("best"))
    return best.select("check_name", "best.message")


def triage_packet(
    failures: DataFrame,
    messages: DataFrame | Column | None = None,
    checked_rows: DataFrame | None = None,
    *,
    broken_share: float = 0.5,
    stray_share: float = 0.05,
) -> DataFrame:
    """What a reviewer needs per failed check: name, run message, count, sample rows as
    JSON, and the text that puts them together.

    ``messages`` (check_name, message) are matched by ``match_messages``, or are an
    expression over the failures; ``checked_rows`` (check_name, n_rows) by the full name.
    ``failure_type`` follows the share of checked rows that fail: most of them points at
    the source, stray ones at the data, anything between at the bounds of the check;
    unknown without a row count.
    """
    if messages is None:
        out = failures.withColumn("message", F.lit(None).cast("string"))
    elif isinstance(messages, Column):
        out = failures.withColumn("message", messages)
    else:
        out = failures.join(match_messages(failures, messages), "check_name", "left")
    if checked_rows is None:
        out = out.withColumn("n_rows", F.lit(None).cast("bigint"))
    else:
        out = out.join(checked_rows.select("check_name", "n_rows"), "check_name", "left")
    share = F.try_divide(F.col("n_failing"), F.col("n_rows"))
    return out.withColumn(
        "failure_type",
        F.when(share.isNull(), UNCLEAR)
        .when(share >= broken_share, SOURCE)
        .when(share <= stray_share, DATA)
        .otherwise(CONFIG),
    ).withColumn(
        "packet",
        F.format_string(
            "check: %s\nmessage: %s\nfailing rows: %d\nsample:\n%s",
            F.col("check_name"),
            F.coalesce("message", F.lit("(not available)")),
            F.col("n_failing"),
            F.concat(F.lit("["), F.array_join("samples", ",\n"), F.lit("]")),
        ),
    )
