"""The hospital cost and quality model: staging, one row per hospital, mart, checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.clean import (
    PLACEHOLDERS,
    SURVEY_PLACEHOLDERS,
    blank_to_null,
    classify_prefix,
    is_suppressed,
    reliable,
    safe_date,
    safe_double,
    safe_int,
)
from payscope.operators import checks
from payscope.operators.aggregate import (
    cost_by_entity,
    measures_by_entity,
    pivot_mean,
    summary_row_max,
    with_attributes,
)
from payscope.operators.joins import full_join, spine_join

# Fixed values of the model.
STATE = "NY"
STAR_MEASURE = "H_STAR_RATING"
CORE_MEASURES = {
    "readm_pneumonia": "READM-30-PN-HRRP",
    "readm_heart_failure": "READM-30-HF-HRRP",
    "readm_copd": "READM-30-COPD-HRRP",
}
OUTCOME_MEASURES = {"patient_safety_psi90": "PSI_90", "mortality_30_pneumonia": "MORT_30_PN"}
REGIONS = {
    "NYC": ("100", "101", "102", "103", "104", "111", "112", "113", "114", "116"),
    "Downstate suburbs": ("105", "106", "107", "108", "109", "115", "117", "118", "119"),
}
OTHER_REGION = "Upstate"
MIN_DISCHARGES = 500


@dataclass(frozen=True)
class Layout:
    """Staged columns in order: (raw name, staged name, kind), with kind one of text,
    int, double, date, note, and flag for the suppression flag of a raw column."""

    columns: tuple[tuple[str, str, str], ...]
    placeholders: tuple[str, ...] = ()


# The columns of the four raw tables and their staged names and types.
READMISSIONS = Layout(
    (
        ("facility_id", "ccn", "text"),
        ("facility_name", "hospital_name", "text"),
        ("state", "state", "text"),
        ("measure_name", "measure_name", "text"),
        ("number_of_discharges", "number_of_discharges", "int"),
        ("excess_readmission_ratio", "excess_readmission_ratio", "double"),
        ("predicted_readmission_rate", "predicted_readmission_rate", "double"),
        ("expected_readmission_rate", "expected_readmission_rate", "double"),
        ("number_of_readmissions", "number_of_readmissions", "int"),
        ("excess_readmission_ratio", "is_suppressed", "flag"),
        ("footnote", "footnote_code", "note"),
        ("start_date", "measure_start_date", "date"),
        ("end_date", "measure_end_date", "date"),
    ),
    PLACEHOLDERS,
)
COMPLICATIONS = Layout(
    (
        ("facility_id", "ccn", "text"),
        ("facility_name", "hospital_name", "text"),
        ("state", "state", "text"),
        ("citytown", "city", "text"),
        ("zip_code", "zip_code", "text"),
        ("measure_id", "measure_id", "text"),
        ("measure_name", "measure_name", "text"),
        ("compared_to_national", "compared_to_national", "text"),
        ("denominator", "denominator", "int"),
        ("score", "score", "double"),
        ("lower_estimate", "lower_estimate", "double"),
        ("higher_estimate", "higher_estimate", "double"),
        ("score", "is_suppressed", "flag"),
        ("footnote", "footnote_code", "note"),
        ("start_date", "measure_start_date", "date"),
        ("end_date", "measure_end_date", "date"),
    ),
    PLACEHOLDERS,
)
SURVEY = Layout(
    (
        ("facility_id", "ccn", "text"),
        ("facility_name", "hospital_name", "text"),
        ("state", "state", "text"),
        ("citytown", "city", "text"),
        ("zip_code", "zip_code", "text"),
        ("hcahps_measure_id", "measure_id", "text"),
        ("hcahps_question", "question", "text"),
        ("hcahps_answer_description", "answer_description", "text"),
        ("patient_survey_star_rating", "star_rating", "int"),
        ("hcahps_answer_percent", "answer_percent", "double"),
        ("hcahps_linear_mean_value", "linear_mean_value", "double"),
        ("number_of_completed_surveys", "completed_surveys", "int"),
        ("survey_response_rate_percent", "response_rate_percent", "double"),
        ("patient_survey_star_rating", "is_suppressed", "flag"),
        ("patient_survey_star_rating_footnote", "star_rating_footnote", "note"),
        ("start_date", "measure_start_date", "date"),
        ("end_date", "measure_end_date", "date"),
    ),
    SURVEY_PLACEHOLDERS,
)
INPATIENT = Layout(
    (
        ("Rndrng_Prvdr_CCN", "ccn", "text"),
        ("Rndrng_Prvdr_Org_Name", "hospital_name", "text"),
        ("Rndrng_Prvdr_City", "city", "text"),
        ("Rndrng_Prvdr_State_Abrvtn", "state", "text"),
        ("Rndrng_Prvdr_Zip5", "zip_code", "text"),
        ("Rndrng_Prvdr_RUCA_Desc", "rural_urban_desc", "text"),
        ("DRG_Cd", "drg_code", "text"),
        ("DRG_Desc", "drg_description", "text"),
        ("Tot_Dschrgs", "total_discharges", "int"),
        ("Avg_Submtd_Cvrd_Chrg", "avg_submitted_charge", "double"),
        ("Avg_Tot_Pymt_Amt", "avg_total_payment", "double"),
        ("Avg_Mdcr_Pymt_Amt", "avg_medicare_payment", "double"),
    )
)

# Column of the flat export -> mart column.
EXPORT = {
    "ccn": "ccn",
    "hospital_name": "hospital_name",
    "city": "city",
    "region": "region",
    "total_discharges": "total_discharges",
    "avg_payment_per_discharge": "volume_weighted_avg_payment",
    "readmission_ratio": "avg_excess_readmission_ratio",
    "patient_satisfaction_star": "hcahps_summary_star",
    "patient_safety_psi90": "patient_safety_psi90",
    "mortality_30_pneumonia": "mortality_30_pneumonia",
    "has_core_readmissions": "has_core_readmissions",
}


def stage(raw: DataFrame, layout: Layout, date_formats: Sequence[str] = ()) -> DataFrame:
    """Rename, cast and flag, one staged row per raw row."""
    kinds: dict[str, Callable[[Column], Column]] = {
        "text": lambda c: c,
        "int": safe_int,
        "double": safe_double,
        "date": lambda c: safe_date(c, date_formats),
        "note": blank_to_null,
        "flag": lambda c: is_suppressed(c, layout.placeholders),
    }
    return raw.select(*(kinds[kind](F.col(c)).alias(n) for c, n, kind in layout.columns))


def cost_by_hospital(inpatient: DataFrame, state: str = STATE) -> DataFrame:
    return cost_by_entity(
        inpatient.filter(F.col("state") == state),
        "ccn",
        "avg_total_payment",
        "total_discharges",
        "drg_code",
        attributes=["hospital_name", "state", "city", "zip_code"],
        also_mean={"simple_avg_medicare_payment": "avg_medicare_payment"},
        names={
            "n_items": "n_drgs",
            "total_weight": "total_discharges",
            "weighted_value": "volume_weighted_avg_payment",
            "simple_value": "simple_avg_payment",
        },
    )


def readmissions_by_hospital(
    readmissions: DataFrame, state: str = STATE, named: bool = True
) -> DataFrame:
    """``named`` adds the hospital name, at the price of one more narrow scan."""
    usable = readmissions.filter(
        (F.col("state") == state)
        & ~F.col("is_suppressed")
        & F.col("excess_readmission_ratio").isNotNull()
    )
    measures = measures_by_entity(
        usable,
        "ccn",
        "measure_name",
        "excess_readmission_ratio",
        CORE_MEASURES,
        value_name="avg_excess_readmission_ratio",
    )
    if not named:
        return measures
    return with_attributes(measures, usable, "ccn", ["hospital_name"])


def quality_by_hospital(
    survey: DataFrame, complications: DataFrame, state: str = STATE, named: bool = True
) -> DataFrame:
    in_state = survey.filter(F.col("state") == state)
    stars = summary_row_max(
        in_state, "ccn", "measure_id", STAR_MEASURE, "star_rating", "hcahps_summary_star"
    )
    if named:
        rated = in_state.filter(
            (F.col("measure_id") == STAR_MEASURE) & F.col("star_rating").isNotNull()
        )
        stars = with_attributes(stars, rated, "ccn", ["hospital_name"])
    outcomes = pivot_mean(
        complications.filter(
            (F.col("state") == state) & ~F.col("is_suppressed") & F.col("score").isNotNull()
        ),
        "ccn",
        "measure_id",
        "score",
        OUTCOME_MEASURES,
    )
    return full_join(stars, outcomes, "ccn")


def build_mart(
    inpatient: DataFrame,
    readmissions: DataFrame,
    survey: DataFrame,
    complications: DataFrame,
    state: str = STATE,
) -> DataFrame:
    """One row per hospital with cost; quality columns are NULL where unknown. Takes
    staged tables; nothing runs until the result is written or read."""
    cost = cost_by_hospital(inpatient, state)
    readm = readmissions_by_hospital(readmissions, state, named=False)
    quality = quality_by_hospital(survey, complications, state, named=False)
    region = classify_prefix(F.col("zip_code"), 3, REGIONS, OTHER_REGION)
    return spine_join(cost, "ccn", readm, quality).select(
        "ccn",
        "hospital_name",
        "state",
        "city",
        "zip_code",
        region.alias("region"),
        "volume_weighted_avg_payment",
        "simple_avg_payment",
        "total_discharges",
        "n_drgs",
        "avg_excess_readmission_ratio",
        *CORE_MEASURES,
        (F.col("n_core_measures") == len(CORE_MEASURES)).alias("has_core_readmissions"),
        "hcahps_summary_star",
        *OUTCOME_MEASURES,
    )


def mart_from_raw(raw: Mapping[str, DataFrame], date_formats: Sequence[str] = ()) -> DataFrame:
    """The mart from the four raw tables by name."""
    return build_mart(
        stage(raw["medicare_inpatient_utilization"], INPATIENT),
        stage(raw["hospital_readmissions"], READMISSIONS, date_formats),
        stage(raw["hospital_hcahps"], SURVEY, date_formats),
        stage(raw["hospital_complications"], COMPLICATIONS, date_formats),
    )


def export_columns(minimum: int = MIN_DISCHARGES) -> dict[str, Column]:
    """Columns of the flat export: renamed mart columns and the reliability flag."""
    columns = {name: F.col(c) for name, c in EXPORT.items()}
    columns["is_analytic"] = reliable(
        F.col("total_discharges"), F.col("has_core_readmissions"), minimum
    )
    return columns


def export_order() -> list[Column]:
    return [F.desc_nulls_last("avg_payment_per_discharge"), F.asc("ccn")]


def model_checks(
    readmissions: DataFrame, survey: DataFrame, inpatient: DataFrame, mart: DataFrame
) -> dict[str, DataFrame]:
    """The thirteen checks of the model, by name."""
    present = lambda c: F.col(c).isNotNull()
    return {
        "not_null_readmissions_ccn": checks.not_null(readmissions, "ccn"),
        "range_readmissions_ratio": checks.accepted_range(
            readmissions, "excess_readmission_ratio", 0, 3, present("excess_readmission_ratio")
        ),
        "not_null_survey_ccn": checks.not_null(survey, "ccn"),
        "values_survey_star": checks.accepted_values(
            survey, "star_rating", [1, 2, 3, 4, 5], present("star_rating")
        ),
        "not_null_inpatient_ccn": checks.not_null(inpatient, "ccn"),
        "range_inpatient_payment": checks.accepted_range(
            inpatient, "avg_total_payment", 0, where=present("avg_total_payment")
        ),
        "not_null_mart_ccn": checks.not_null(mart, "ccn"),
        "unique_mart_ccn": checks.unique(mart, "ccn"),
        "not_null_mart_payment": checks.not_null(mart, "volume_weighted_avg_payment"),
        "range_mart_payment": checks.accepted_range(mart, "volume_weighted_avg_payment", 0),
        "values_mart_region": checks.accepted_values(mart, "region", [*REGIONS, OTHER_REGION]),
        "range_mart_ratio": checks.accepted_range(
            mart, "avg_excess_readmission_ratio", 0, 3, present("avg_excess_readmission_ratio")
        ),
        "mart_core_has_cost": checks.implies(
            mart,
            F.coalesce(F.col("has_core_readmissions"), F.lit(False)),
            present("volume_weighted_avg_payment"),
            ["ccn", "hospital_name", "has_core_readmissions", "volume_weighted_avg_payment"],
        ),
    }
