"""From raw tables to mart, stored checks, analyses and, if asked for, prices."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from payscope.operators.checks import collect_failures
from payscope.plans import hospital, prices
from payscope.plans.analysis import cost_quality_report, robustness_report
from payscope.sinks.tables import (
    export_csv,
    read_failures,
    store_failures,
    truncate_and_load,
    write_spread,
)


@dataclass
class Build:
    mart: DataFrame
    failures: DataFrame
    prices: DataFrame | None = None
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    run_id: str,
    *,
    include_price: bool = False,
) -> Build:
    """Staging stays inline; the mart and the unified prices are written as tables,
    since everything after them reads them more than once."""
    counts = {}
    mart = hospital.mart_from_raw(raw)
    counts["mart"] = truncate_and_load(mart, f"{folder}/mart")
    mart = spark.read.schema(mart.schema).parquet(f"{folder}/mart")

    checks = hospital.model_checks(
        hospital.stage(raw["hospital_readmissions"], hospital.READMISSIONS),
        hospital.stage(raw["hospital_hcahps"], hospital.SURVEY),
        hospital.stage(raw["medicare_inpatient_utilization"], hospital.INPATIENT),
        mart,
    )
    store_failures(checks, f"{folder}/audit", run_id)
    failures = collect_failures(read_failures(spark, f"{folder}/audit", run_id))

    unified = None
    if include_price:
        unified = prices.unify_prices(raw)
        path = f"{folder}/prices"
        counts["prices"] = write_spread(unified, path, "source_hospital")
        # A partition column reads back last; the contract has it first.
        unified = spark.read.schema(prices.CONTRACT).parquet(path).select(prices.CONTRACT.names)
    return Build(mart, failures, unified, counts)


def analyse(mart: DataFrame) -> dict[str, DataFrame]:
    """Both reports on a written mart."""
    robust = robustness_report(mart, "NYC", hospital.OTHER_REGION)
    return {
        **cost_quality_report(mart),
        **{f"robustness_{name}": table for name, table in robust.items()},
    }


def export(mart: DataFrame, path: str) -> DataFrame:
    return export_csv(mart, path, hospital.export_columns(), hospital.export_order())
