"""The price module: eight files in three layouts to one table with thirteen columns.

Off unless asked for; the mart never needs it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payscope.functions.clean import missing_to_null, safe_double
from payscope.operators.contract import contract_union
from payscope.operators.joins import with_identity
from payscope.operators.reshape import (
    ColumnGroups,
    discover_groups,
    explode_nested,
    explode_records,
    first_element,
    keep_any_present,
    melt_groups,
)
from payscope.sources.ingest import Source
from payscope.sources.json_files import parse_documents

# Source, layout, CCN, hospital name, raw file.
HOSPITALS = {
    "rochester_general": (
        "tall", "330125", "Rochester General Hospital",
        "330125_rochester-general_standardcharges.csv",
    ),
    "montefiore": (
        "tall", "330059", "Montefiore Medical Center",
        "330059_montefiore-medical-center_standardcharges.csv",
    ),
    "brooklyn_hospital": (
        "wide", "330056", "The Brooklyn Hospital Center",
        "330056_brooklyn-hospital-center_standardcharges.csv",
    ),
    "flushing_hospital": (
        "wide", "330193", "Flushing Hospital Medical Center",
        "330193_flushing-hospital_standardcharges.zip",
    ),
    "albany_medical": (
        "wide", "330013", "Albany Medical Center",
        "330013_albany-medical-center_standardcharges.csv",
    ),
    "nyu_langone": (
        "wide", "330214", "NYU Langone Tisch Hospital",
        "330214_nyu-langone-tisch_standardcharges.csv",
    ),
    "mount_sinai": (
        "json_first", "330024", "The Mount Sinai Hospital",
        "330024_mount-sinai-hospital_standardcharges.json",
    ),
    "newyork_presbyterian": (
        "json_payers", "330101", "NewYork-Presbyterian Hospital",
        "330101_newyork-presbyterian_standardcharges.json.zip",
    ),
}

# Fixed value: record of the CSV files that holds the header, counted from 0.
HEADER_ROW = 2

# The names wide headers are made of.
GROUP_PREFIX = "standard_charge_"
GROUP_SUFFIXES = (
    "negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology",
)
WIDE_IDS = (
    "code_1", "code_1_type", "description", "standard_charge_gross",
    "standard_charge_discounted_cash", "setting",
)

# Fixed value: the schema every source is brought to.
CONTRACT = T.StructType(
    [
        T.StructField(name, T.DoubleType() if kind == "double" else T.StringType())
        for name, kind in (
            ("source_hospital", "string"),
            ("ccn", "string"),
            ("hospital_name", "string"),
            ("code", "string"),
            ("code_type", "string"),
            ("description", "string"),
            ("setting", "string"),
            ("payer_name", "string"),
            ("plan_name", "string"),
            ("gross_charge", "double"),
            ("discounted_cash_charge", "double"),
            ("negotiated_dollar", "double"),
            ("negotiated_algorithm", "string"),
        )
    ]
)

# Fixed value: the nested document. Numbers are read as text, so a stray word in one becomes NULL in its own cell.
CHARGE = """
    struct<
        description: string,
        code_information: array<struct<code: string, type: string>>,
        standard_charges: array<struct<
            setting: string, billing_class: string, gross_charge: string,
            discounted_cash: string,
            payers_information: array<struct<
                payer_name: string, plan_name: string, standard_charge_dollar: string,
                standard_charge_algorithm: string, methodology: string>>>>>
"""
DOCUMENT = f"standard_charge_information array<{CHARGE}>"


def hospital_dimension(spark: SparkSession) -> DataFrame:
    """source_hospital -> ccn, hospital_name: eight rows."""
    rows = [(s, ccn, name) for s, (_, ccn, name, _) in HOSPITALS.items()]
    return spark.createDataFrame(rows, "source_hospital string, ccn string, hospital_name string")


def raw_sources(folder: str) -> dict[str, Source]:
    """The eight raw files under a folder, ready to be ingested."""
    out = {}
    for source, (layout, _, _, file) in HOSPITALS.items():
        kind = "json" if layout.startswith("json") else "csv"
        out[f"price_tx_{source}"] = Source(
            f"{folder}/{file}",
            f"{kind}_zip" if file.endswith(".zip") else kind,
            header_row=HEADER_ROW if kind == "csv" else 0,
        )
    return out


def _double(c: str) -> Column:
    return safe_double(F.col(c))


def _text(c: str) -> Column:
    return missing_to_null(F.col(c))


def stage_tall(raw: DataFrame) -> DataFrame:
    """One row per payer and plan already; rows without a dollar amount are kept."""
    billing = F.col("billing_class") if "billing_class" in raw.columns else F.lit(None)
    return raw.select(
        F.col("code_1").alias("code"),
        F.col("code_1_type").alias("code_type"),
        "description",
        billing.cast("string").alias("billing_class"),
        "setting",
        "payer_name",
        "plan_name",
        _double("standard_charge_gross").alias("gross_charge"),
        _double("standard_charge_discounted_cash").alias("discounted_cash_charge"),
        _double("standard_charge_negotiated_dollar").alias("negotiated_dollar"),
        _double("standard_charge_negotiated_percentage").alias("negotiated_percentage"),
        _text("standard_charge_negotiated_algorithm").alias("negotiated_algorithm"),
        F.col("standard_charge_methodology").alias("methodology"),
    )


def wide_groups(raw: DataFrame, originals: Mapping[str, str] | None = None) -> ColumnGroups:
    return discover_groups(raw.columns, GROUP_PREFIX, GROUP_SUFFIXES, originals)


def stage_wide(raw: DataFrame, originals: Mapping[str, str] | None = None) -> DataFrame:
    """Payer-plan columns to rows; the label stays whole as the plan name. Rows with
    neither amount, percentage nor algorithm are dropped. ``originals`` (clean name ->
    header) tells plans apart whose names are alike once cleaned."""
    have = set(raw.columns)
    melted = melt_groups(raw, WIDE_IDS, wide_groups(raw, originals), "payer_plan")
    pick = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    staged = melted.select(
        pick("code_1").alias("code"),
        pick("code_1_type").alias("code_type"),
        pick("description").alias("description"),
        pick("setting").alias("setting"),
        "payer_plan",
        F.lit(None).cast("string").alias("payer_name"),
        F.col("payer_plan").alias("plan_name"),
        safe_double(pick("standard_charge_gross")).alias("gross_charge"),
        safe_double(pick("standard_charge_discounted_cash")).alias("discounted_cash_charge"),
        _double("negotiated_dollar").alias("negotiated_dollar"),
        _double("negotiated_percentage").alias("negotiated_percentage"),
        _text("negotiated_algorithm").alias("negotiated_algorithm"),
        "methodology",
    )
    return keep_any_present(
        staged, ["negotiated_dollar", "negotiated_percentage", "negotiated_algorithm"]
    )


def _charge_fields() -> dict:
    codes, charges = F.col("record.code_information"), F.col("record.standard_charges")
    return {
        "code": first_element(codes, "code"),
        "code_type": first_element(codes, "type"),
        "description": F.col("record.description"),
        "setting": first_element(charges, "setting"),
    }


def _documents(raw: DataFrame) -> DataFrame:
    """Documents that were landed whole, under the fields needed here."""
    return parse_documents(raw, DOCUMENT) if "document" in raw.columns else raw


def stage_json_first(raw: DataFrame) -> DataFrame:
    """One row per charge, with its first code and its first price entry."""
    raw = _documents(raw)
    charges = F.col("record.standard_charges")
    return explode_records(
        raw,
        F.col("standard_charge_information"),
        {
            **_charge_fields(),
            "billing_class": first_element(charges, "billing_class"),
            "gross_charge": safe_double(first_element(charges, "gross_charge")),
            "discounted_cash_charge": safe_double(first_element(charges, "discounted_cash")),
        },
    )


def stage_json_payers(raw: DataFrame) -> DataFrame:
    """One row per charge and payer of its first price entry; rows with neither amount
    nor algorithm are dropped."""
    raw = _documents(raw)
    exploded = explode_nested(
        raw,
        F.col("standard_charge_information"),
        _charge_fields(),
        first_element(F.col("record.standard_charges"), "payers_information"),
        {
            "payer_name": F.col("item.payer_name"),
            "plan_name": F.col("item.plan_name"),
            "negotiated_dollar": safe_double(F.col("item.standard_charge_dollar")),
            "negotiated_algorithm": F.col("item.standard_charge_algorithm"),
            "methodology": F.col("item.methodology"),
        },
    )
    return keep_any_present(exploded, ["negotiated_dollar", "negotiated_algorithm"])


STAGES = {
    "tall": stage_tall,
    "wide": stage_wide,
    "json_first": stage_json_first,
    "json_payers": stage_json_payers,
}


def stage_prices(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged price rows per hospital, with its identity as constants."""
    staged = {}
    for source, (layout, ccn, name, _) in HOSPITALS.items():
        if f"price_tx_{source}" in raw:
            rows = STAGES[layout](raw[f"price_tx_{source}"])
            staged[source] = with_identity(rows, {"ccn": ccn, "hospital_name": name})
    return staged


def unify_prices(raw: Mapping[str, DataFrame]) -> DataFrame:
    """All hospitals under the contract."""
    return contract_union(stage_prices(raw), CONTRACT, "source_hospital")
