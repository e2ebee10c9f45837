"""The analyses on the mart: does cost or satisfaction follow readmissions?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.operators.aggregate import category_counts, cell_mean_gap, threshold_counts
from payscope.operators.correlation import correlations, headline
from payscope.operators.quantiles import describe, exact_quantiles, group_medians, median_gap
from payscope.operators.segments import (
    analytic_counts,
    analytic_set,
    listing,
    median_split,
)

# Fixed values of the analysis.
THRESHOLDS = (100, 250, 500, 1000)
BEST, WORST = "low_cost / good_quality", "high_cost / poor_quality"
NAME_WIDTH = 44


@dataclass(frozen=True)
class Columns:
    """Which mart columns play which part."""

    key: str = "ccn"
    name: str = "hospital_name"
    group: str = "region"
    cost: str = "volume_weighted_avg_payment"
    outcome: str = "avg_excess_readmission_ratio"
    rating: str = "hcahps_summary_star"
    volume: str = "total_discharges"
    flag: str = "has_core_readmissions"
    minimum: int = 500
    thresholds: Sequence[int] = field(default=THRESHOLDS)

    @property
    def reliability(self) -> tuple[str, int, str, list[str]]:
        return self.volume, self.minimum, self.flag, [self.outcome, self.cost]

    @property
    def pairs(self) -> dict[str, tuple[str, str]]:
        return {
            "rating_vs_outcome": (self.rating, self.outcome),
            "cost_vs_outcome": (self.cost, self.outcome),
        }


def reliable_set(mart: DataFrame, of: Columns = Columns()) -> DataFrame:
    return analytic_set(mart, *of.reliability)


def quadrants(reliable: DataFrame, of: Columns = Columns()) -> DataFrame:
    """Each row on its side of the median cost and the median outcome. Both medians
    are needed before any row is labelled, so pass a materialised set when large."""
    medians = exact_quantiles(
        reliable, {"cost_median": (of.cost, 0.5), "outcome_median": (of.outcome, 0.5)}
    )
    return median_split(
        reliable,
        medians,
        {
            "cost_median": (of.cost, "high_cost", "low_cost"),
            "outcome_median": (of.outcome, "poor_quality", "good_quality"),
        },
        "quadrant",
    )


def cost_quality_report(mart: DataFrame, of: Columns = Columns()) -> dict[str, DataFrame]:
    """Every table of the core analysis, by name. Values that quantiles need are counted
    and written when this is called; all else is lazy."""
    reliable = reliable_set(mart, of)
    split = quadrants(reliable, of)
    shown = [of.key, of.name, of.cost, of.outcome, of.rating]
    order = [of.cost, of.key]
    return {
        "volume_distribution": describe(mart, of.volume),
        "volume_thresholds": threshold_counts(mart, of.volume, of.thresholds),
        "analytic_counts": analytic_counts(mart, *of.reliability),
        "headline": headline(correlations(reliable, of.pairs)),
        "quadrant_counts": category_counts(split, "quadrant"),
        "best_value": listing(split, "quadrant", BEST, order, shown, {of.name: NAME_WIDTH}),
        "worst_value": listing(split, "quadrant", WORST, order, shown, {of.name: NAME_WIDTH}),
        "quadrant_gap": cell_mean_gap(split, "quadrant", of.cost, BEST, WORST),
    }


def robustness_report(
    mart: DataFrame, upper: str, base: str, of: Columns = Columns()
) -> dict[str, DataFrame]:
    """Regional medians, the gap between two regions, and correlations within each."""
    reliable = reliable_set(mart, of)
    medians: Mapping[str, str] = {
        "median_cost": of.cost,
        "median_outcome": of.outcome,
        "median_rating": of.rating,
    }
    by_group = group_medians(reliable, of.group, medians)
    found = correlations(reliable, of.pairs, of.group)
    return {
        "group_medians": by_group.select(
            of.group, "n", *(F.bround(c, 3).alias(c) for c in medians)
        ).orderBy(of.group),
        "median_gap": median_gap(reliable, of.group, of.cost, upper, base),
        "correlations": found.orderBy("pair", "scope"),
        "headline": headline(found.filter(F.col("scope") == "ALL")),
    }
