"""The operators as queries over the star-schema test tables.

Suppliers stand in for hospitals: returned line items are their costs, with the price as
payment and the quantity as volume; events of the user with the same number are their
measure rows. Raw text with placeholders is derived from the events, every row of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.functions.clean import (
    blank_to_null,
    classify_prefix,
    is_suppressed,
    reliable,
    safe_date,
    safe_double,
    safe_int,
    trimmed,
)
from payscope.operators import aggregate, checks
from payscope.operators.contract import contract_union
from payscope.operators.correlation import correlations, headline
from payscope.operators.joins import dimension_lookup, full_join, spine_join, with_identity
from payscope.operators.quantiles import describe, exact_quantiles, group_medians, median_gap
from payscope.operators.reshape import dropped_groups, recover_parts
from payscope.operators.segments import analytic_counts, analytic_set, listing
from payscope.plans import analysis, prices
from payscope.session import materialize, scratch_path
from payscope.sinks.tables import (
    read_failures,
    recent_failures,
    store_failures,
    truncate_and_load,
)
from payscope.sources.csv_files import read_csv
from payscope.sources.json_files import (
    CATALOG,
    first_downloads,
    read_documents,
    read_pages,
    read_raw_documents,
    typed_fields,
)
from payscope.sources.names import sanitize_columns

MEASURE_COLUMNS = {
    "outcome_click": "click",
    "outcome_view": "view",
    "outcome_purchase": "purchase",
}
COLUMNS = analysis.Columns(
    key="entity_id",
    name="entity_name",
    group="region",
    cost="weighted_payment",
    outcome="avg_outcome",
    rating="star",
    volume="total_volume",
    flag="has_core",
    minimum=5000,
    thresholds=(4000, 4500, 5000, 5500),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- raw text derived from the events -----------------------------------------------


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An all-text table as a public file would hold it."""
    k = F.col("k").cast("int")
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    stars = (F.least(F.lit(4), F.floor(F.col("value") / 25)) + 1).cast("string")
    # json_tuple parses once per row; an extracted column would be parsed again in every
    # filter that the optimiser moves below it.
    events = table(spark, sf_dir, "events").select("*", F.json_tuple("props", "k").alias("k"))
    return events.select(
        "event_id",
        F.col("user_id").alias("entity_id"),
        F.col("event_type").alias("measure"),
        F.when(k < 8, "N/A")
        .when(k < 16, " Not Available\t")
        .when(k < 22, "  ")
        .when(k < 28, F.lit(None))
        .when(k < 32, "Too Few To Report")
        .when(k < 34, "Not Applicable")
        .when(k < 36, "nan")
        .when(k < 38, F.concat(cents, F.lit("d")))
        .otherwise(cents)
        .alias("score"),
        F.when(k < 16, " 5 ")
        .when(k < 28, "")
        .when(k < 32, "1")
        .otherwise("  ")
        .alias("footnote"),
        F.when(F.col("event_type") != "signup", "Not Applicable")
        .when(k < 10, "Not Available")
        .otherwise(stars)
        .alias("rating"),
        F.when(k < 10, F.date_format("ts", "MM/dd/yyyy"))
        .when(k < 20, F.date_format("ts", "yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("start_date"),
    )


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).select(
        "event_id",
        "entity_id",
        "measure",
        safe_double(F.col("score")).alias("score"),
        safe_int(F.col("score")).alias("score_int"),
        safe_int(F.col("rating")).alias("rating"),
        is_suppressed(F.col("score")).alias("is_suppressed"),
        blank_to_null(F.col("footnote")).alias("footnote_code"),
        safe_date(F.col("start_date"), ["MM/dd/yyyy"]).cast("string").alias("start_date"),
    )


def usable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_events(spark, sf_dir).filter(~F.col("is_suppressed") & F.col("score").isNotNull())


def measure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity and measure grain: what the last event says, which may be a placeholder,
    and the best rating. All states have a fixed width, so this is a hash aggregate."""
    return staged_events(spark, sf_dir).groupBy("entity_id", "measure").agg(
        F.max_by("score", "event_id").alias("outcome"),
        F.max_by("is_suppressed", "event_id").alias("is_suppressed"),
        F.max("rating").alias("rating"),
    )


# --- the mart ------------------------------------------------------------------------


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in whole cents, whose sums are exact in any order."""
    cents = F.round(F.col("l_extendedprice") * 100)
    return table(spark, sf_dir, "lineitem").withColumn("payment", cents)


def returned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_items(spark, sf_dir).filter(F.col("l_returnflag") == "R")


def outcomes_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and the summary row's rating from one pass over the events."""
    usable = F.when(~F.col("is_suppressed"), F.col("outcome"))
    rows = measure_rows(spark, sf_dir).withColumn("outcome", usable)
    star = F.max(F.when(F.col("measure") == "signup", F.col("rating"))).alias("star")
    return aggregate.measures_by_entity(
        rows, "entity_id", "measure", "outcome", MEASURE_COLUMNS, value_name="avg_outcome", extra=[star]
    )


def ratings_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_events(spark, sf_dir)
    return aggregate.summary_row_max(staged, "entity_id", "measure", "signup", "rating", "star")


def spend_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.pivot_mean(
        table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "entity_id"),
        "entity_id",
        "o_orderpriority",
        "o_totalprice",
        {"urgent_mean": "1-URGENT", "low_mean": "5-LOW"},
        digits=6,
    )


def quality_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from the events and spending from the orders, either of which may lack an
    entity the other has."""
    return full_join(ratings_by_entity(spark, sf_dir), spend_by_entity(spark, sf_dir), "entity_id")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier to region. Nations and regions are fixed lists and are broadcast by
    their size."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("entity_id"),
            F.col("s_name").alias("entity_name"),
            F.col("r_name").alias("region"),
        )
    )


def entity_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = aggregate.cost_by_entity(
        returned_items(spark, sf_dir).withColumnRenamed("l_suppkey", "entity_id"),
        "entity_id",
        "payment",
        "l_quantity",
        "l_partkey",
        names={
            "total_weight": "total_volume",
            "weighted_value": "weighted_payment",
            "simple_value": "simple_payment",
        },
    )
    joined = spine_join(
        cost,
        "entity_id",
        suppliers(spark, sf_dir),
        full_join(outcomes_by_entity(spark, sf_dir), spend_by_entity(spark, sf_dir), "entity_id"),
    )
    return joined.select(
        "entity_id",
        "entity_name",
        "region",
        "weighted_payment",
        "simple_payment",
        "total_volume",
        "n_items",
        "avg_outcome",
        *MEASURE_COLUMNS,
        (F.col("n_core_measures") == len(MEASURE_COLUMNS)).alias("has_core"),
        "star",
        "urgent_mean",
        "low_mean",
    )


def written_mart(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """For whatever reads the mart more than once: the columns it needs, computed once."""
    return materialize(entity_mart(spark, sf_dir).select(*columns), "mart")


def reliable_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.reliable_set(entity_mart(spark, sf_dir), COLUMNS)


def written_reliable(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return materialize(reliable_mart(spark, sf_dir).select(*columns), "reliable")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- cleaning ------------------------------------------------------------------------


def safe_cast_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of a number or date against every cast."""
    value = table(spark, sf_dir, "events").select(
        "event_id",
        F.json_tuple("props", "k").alias("k"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("cents"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    spellings = (
        (8, F.concat(F.lit(" "), "cents", F.lit("\t"))),
        (16, F.concat(F.lit("+"), "cents")),
        (24, F.concat("cents", F.lit(".5"))),
        (32, F.concat("cents", F.lit("e1"))),
        (40, F.concat("cents", F.lit("f"))),
        (44, F.lit("NaN")),
        (48, F.lit("-Infinity")),
        (52, F.lit("0x1F")),
        (56, F.concat("cents", F.lit(" %"))),
        (60, F.lit("")),
        (64, F.lit("1,234")),
        (72, F.col("day")),
        (76, F.substring("day", 1, 4)),
        (80, F.concat("day", F.lit("T00:00:00"))),
        (84, F.lit("2024-02-30")),
        (88, F.concat(F.lit("-"), "cents")),
    )
    text = F.col("cents")
    for bound, spelled in reversed(spellings):
        text = F.when(F.col("k").cast("int") < bound, spelled).otherwise(text)
    texts = value.withColumn("text", text)
    return texts.select(
        "event_id",
        safe_int(F.col("text")).alias("as_int"),
        safe_double(F.col("text")).alias("as_double"),
        safe_date(F.col("text")).cast("string").alias("as_date"),
    )


def suppression_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ["N/A", "Not Available", "Not Applicable", "Too Few To Report"]
    return aggregate.value_profile(raw_events(spark, sf_dir), "score", listed)


def key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return aggregate.key_coverage(
        {
            "events": (t("events"), "user_id"),
            "lineitem": (t("lineitem"), "l_suppkey"),
            "orders": (t("orders"), "o_custkey"),
        }
    )


def prefix_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = {"urgent": ("1", "2"), "routine": ("3", "4")}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        classify_prefix(F.col("o_orderpriority"), 1, classes, "other").alias("priority_class"),
    )


def string_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim, slice, replace, prefix and suffix tests, quote escaping."""
    quoted = F.concat(F.lit("'"), F.replace(F.col("name"), F.lit("'"), F.lit("''")), F.lit("'"))
    return (
        table(spark, sf_dir, "part")
        .withColumn("name", F.concat(F.lit(" "), "p_name", F.lit("'s ")))
        .select(
            "p_partkey",
            trimmed(F.col("name")).alias("name"),
            F.substring("p_type", 1, 3).alias("type_code"),
            F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")).alias("brand"),
            F.startswith("p_type", F.lit("E")).alias("starts_e"),
            F.endswith("p_brand", F.lit("7")).alias("ends_7"),
            quoted.alias("literal"),
        )
    )


def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.get_json_object("props", "$.list[0].k").alias("absent"),
    )


# --- aggregation ---------------------------------------------------------------------


def weighted_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = returned_items(spark, sf_dir).withColumn("percent", F.round(F.col("l_discount") * 100))
    return aggregate.cost_by_entity(
        items, "l_suppkey", "payment", "l_quantity", "l_partkey",
        also_mean={"simple_discount": "percent"},
    )


def entity_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = line_items(spark, sf_dir).withColumns(
        {
            "name": F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")),
            "status": F.concat("l_returnflag", "l_linestatus"),
        }
    )
    return aggregate.cost_by_entity(
        items, "l_suppkey", "payment", "l_quantity", "l_partkey",
        attributes=["name", "status"],
    )


def measure_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.measures_by_entity(
        usable_events(spark, sf_dir), "entity_id", "measure", "score", MEASURE_COLUMNS
    )


def lookup_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return with_identity(
        dimension_lookup(customers, nation, "c_nationkey"), {"source": "customer", "note": None}
    )


# --- statistics ----------------------------------------------------------------------


def quantiles_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {
        "p05": ("l_extendedprice", 0.05),
        "median": ("l_extendedprice", 0.5),
        "p99": ("l_extendedprice", 0.99),
        "quantity": ("l_quantity", 0.75),
    }
    found = exact_quantiles(table(spark, sf_dir, "lineitem"), wanted, ["l_returnflag"])
    return rounded(found, 6, *wanted)


def describe_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = describe(table(spark, sf_dir, "orders").select("o_totalprice"), "o_totalprice")
    return rounded(found, 4, "mean", "std", "q1", "median", "q3")


def describe_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = describe(written_mart(spark, sf_dir, "total_volume"), "total_volume")
    return rounded(found, 4, "mean", "std", "q1", "median", "q3")


def export_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = entity_mart(spark, sf_dir)
    return mart.select(
        "entity_id",
        "entity_name",
        "region",
        "total_volume",
        F.col("weighted_payment").alias("avg_payment"),
        F.col("avg_outcome").alias("outcome"),
        "has_core",
        reliable(F.col("total_volume"), F.col("has_core"), COLUMNS.minimum).alias("is_analytic"),
    ).orderBy(F.desc_nulls_last("avg_payment"), "entity_id")


def medians_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = {
        "median_cost": "weighted_payment",
        "median_outcome": "avg_outcome",
        "median_star": "star",
    }
    kept = written_reliable(spark, sf_dir, "region", *medians.values())
    found = group_medians(kept, "region", medians)
    return rounded(found, 6, *medians)


def regional_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = written_mart(spark, sf_dir, "region", "weighted_payment")
    found = median_gap(mart, "region", "weighted_payment", "ASIA", "EUROPE")
    return rounded(found, 6, "median_upper", "median_base", "gap")


def _tested(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "r", "p")


def pearson_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tested(correlations(reliable_mart(spark, sf_dir), COLUMNS.pairs))


def pearson_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tested(correlations(reliable_mart(spark, sf_dir), COLUMNS.pairs, "region"))


def pearson_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One correlation per user over all events: odd and even counts, and a large one."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "value", F.get_json_object("props", "$.k").cast("int").alias("k")
    )
    return _tested(correlations(events, {"k_vs_value": ("k", "value")}, "user_id"))


def quadrants(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    kept = written_reliable(spark, sf_dir, "weighted_payment", "avg_outcome", *columns)
    return analysis.quadrants(kept, COLUMNS)


def quadrant_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quadrants(spark, sf_dir, "entity_id")


def quadrant_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregate.cell_mean_gap(
        quadrants(spark, sf_dir), "quadrant", "weighted_payment", analysis.BEST, analysis.WORST
    )
    return rounded(found, 6, "mean_low", "mean_high", "gap", "gap_pct")


def quadrant_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(
        quadrants(spark, sf_dir, "entity_id", "entity_name", "star"),
        "quadrant",
        analysis.BEST,
        ["weighted_payment", "entity_id"],
        ["entity_id", "entity_name", "weighted_payment", "avg_outcome", "star"],
        {"entity_name": 12},
    )


def headline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = correlations(reliable_mart(spark, sf_dir), COLUMNS.pairs)
    return headline(found).select("pair", "n", "sign", "direction", "p_text", "statement")


# --- reshape and union ---------------------------------------------------------------


def wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a wide price file under its own headers: one group of four text columns
    per return flag, one more plan under nearly the same name, an incomplete group, and
    gaps where an order has nothing to report."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    columns = []
    for flag in ("A", "N", "R"):
        here = F.col("l_returnflag") == flag
        price = F.sum(F.when(here, cents))
        volume = F.sum(F.when(here, F.col("l_quantity")))
        discount = F.max(F.when(here, F.col("l_discount")))
        lines = F.count_if(here)
        texts = {
            "negotiated_dollar": F.when(
                volume >= 40, price.cast("string")
            ).when(lines > 0, "nan"),
            "negotiated_percentage": F.when(
                discount >= 0.08, F.round(discount * 100).cast("bigint").cast("string")
            ),
            "negotiated_algorithm": F.when(lines >= 2, F.concat(lines.cast("string"), F.lit(" lines"))),
            "methodology": F.when(lines > 0, "fee"),
        }
        plan = f"plan {flag.lower()}/1"
        columns += [c.alias(f"standard_charge|{flag}|{plan}|{n}") for n, c in texts.items()]
    # Another plan of the first payer, whose headers come out alike once cleaned.
    columns += [
        F.max(cents).cast("string").alias("standard_charge|A|plan a 1|negotiated_dollar"),
        F.lit(None).cast("string").alias("standard_charge|A|plan a 1|negotiated_percentage"),
        F.lit(None).cast("string").alias("standard_charge|A|plan a 1|negotiated_algorithm"),
        F.lit("top").alias("standard_charge|A|plan a 1|methodology"),
    ]
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(cents).cast("string").alias("standard_charge|gross"),
            F.lit("x").alias("standard_charge|B|none|methodology"),
            *columns,
        )
        .withColumns({"code|1": F.col("l_orderkey").cast("string"), "code|1|type": F.lit("LOCAL")})
        .drop("l_orderkey")
    )


def _clean_wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str], DataFrame]:
    raw = wide_raw(spark, sf_dir)
    clean, renames = sanitize_columns(raw)
    return clean, dict(zip(clean.columns, raw.columns)), renames


def recovered_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payer and plan taken back from the headers the names were cleaned from."""
    raw, originals, renames = _clean_wide(spark, sf_dir)
    suffix = prices.GROUP_SUFFIXES[0]
    parts = ["payer_name", "plan_name"]
    staged = prices.stage_wide(raw, originals)
    found = recover_parts(staged, "payer_plan", renames, prices.GROUP_PREFIX, suffix, parts)
    return found.select("code", "payer_plan", *parts, "negotiated_dollar")


def wide_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, originals, _ = _clean_wide(spark, sf_dir)
    return prices.stage_wide(raw, originals).select(
        "code", "code_type", "setting", "payer_plan", "gross_charge",
        "negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology",
    )


def lost_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the melt leaves out, with the cells it would have held."""
    raw, originals, _ = _clean_wide(spark, sf_dir)
    return dropped_groups(raw, prices.wide_groups(raw, originals))


def tall_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("code_1"),
        F.lit("LOCAL").alias("code_1_type"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("description"),
        F.col("l_linestatus").alias("setting"),
        F.col("l_returnflag").alias("payer_name"),
        F.col("l_suppkey").cast("string").alias("plan_name"),
        cents.alias("standard_charge_gross"),
        F.when(F.col("l_tax") > 0.05, cents).otherwise("N/A").alias(
            "standard_charge_discounted_cash"
        ),
        F.when(F.col("l_discount") > 0.05, cents).alias("standard_charge_negotiated_dollar"),
        F.round(F.col("l_discount") * 100).cast("bigint").cast("string").alias(
            "standard_charge_negotiated_percentage"
        ),
        F.when(F.col("l_discount") <= 0.05, "formula").otherwise("None").alias(
            "standard_charge_negotiated_algorithm"
        ),
        F.lit("fee schedule").alias("standard_charge_methodology"),
    )


def tall_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.stage_tall(tall_raw(spark, sf_dir))


def charge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per line item: two charges, the first with a payer list that
    may be empty, the second without prices or codes. Built within the row."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    payer = lambda name, dollar, algorithm: F.struct(
        F.lit(name).alias("payer_name"),
        F.col("l_linestatus").alias("plan_name"),
        dollar.cast("string").alias("standard_charge_dollar"),
        algorithm.cast("string").alias("standard_charge_algorithm"),
        F.lit("fee").alias("methodology"),
    )
    payers = F.array(
        payer("list", cents, F.lit(None)),
        payer("deal", F.when(F.col("l_discount") > 0.05, cents), F.lit(None)),
        payer("rule", F.lit("varies"), F.when(F.col("l_tax") > 0.05, "share")),
    )
    codes = F.array(
        F.struct(F.col("l_partkey").cast("string").alias("code"), F.lit("CPT").alias("type")),
        F.struct(F.lit("0").alias("code"), F.lit("RC").alias("type")),
    )
    prices_of = F.array(
        F.struct(
            F.col("l_linestatus").alias("setting"),
            F.lit("facility").alias("billing_class"),
            cents.alias("gross_charge"),
            F.when(F.col("l_tax") > 0.05, cents).alias("discounted_cash"),
            F.slice(payers, 1, F.when(F.col("l_returnflag") == "N", 0).otherwise(3)).alias(
                "payers_information"
            ),
        )
    )
    charge = lambda known, description: F.struct(
        description.alias("description"),
        F.when(F.lit(known), codes).alias("code_information"),
        F.when(F.lit(known), prices_of).alias("standard_charges"),
    )
    charges = F.array(
        charge(True, F.concat_ws("-", "l_orderkey", "l_linenumber")),
        charge(False, F.lit("bare")),
    )
    return table(spark, sf_dir, "lineitem").select(charges.alias("standard_charge_information"))


def nested_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.stage_json_first(charge_documents(spark, sf_dir))


def nested_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.stage_json_payers(charge_documents(spark, sf_dir))


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, line items and events under the price contract."""
    text = lambda c: F.col(c).cast("string")
    inputs = {
        "orders": table(spark, sf_dir, "orders").select(
            text("o_orderkey").alias("code"),
            F.col("o_orderstatus").alias("setting"),
            F.col("o_orderpriority").alias("payer_plan"),
            F.col("o_totalprice").alias("gross_charge"),
        ),
        "lineitem": table(spark, sf_dir, "lineitem").select(
            text("l_partkey").alias("code"),
            F.lit("PART").alias("code_type"),
            F.col("l_returnflag").alias("payer_name"),
            F.col("l_extendedprice").alias("negotiated_dollar"),
        ),
        "events": table(spark, sf_dir, "events").select(
            text("event_id").alias("code"),
            F.col("event_type").alias("description"),
            F.col("value").alias("discounted_cash_charge"),
            F.col("props").alias("negotiated_algorithm"),
        ),
    }
    folds = {"orders": {"plan_name": "payer_plan"}}
    return contract_union(inputs, prices.CONTRACT, "source_hospital", folds)


def contract_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contract_rows(spark, sf_dir)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("source_hospital").alias("n_sources")
    )


# --- scans of files written from the tables ------------------------------------------


def scan_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items through an all-text CSV folder with awkward headers and back."""
    path = scratch_path(spark, "csv")
    (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_suppkey").alias("supp|key"),
            F.col("l_quantity").alias("l quantity"),
            F.col("l_returnflag").alias("1 flag"),
        )
        .write.csv(path, header=True)
    )
    scan = read_csv(spark, path, multiline=False, encoding="UTF-8").df
    return scan.groupBy(safe_int(F.col("supp_key")).alias("supplier"), "col_1_flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(safe_double(F.col("l_quantity"))).alias("quantity")
    )


def scan_paged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through saved pages of 500 rows, one page per line. The key is unique,
    so a page holds 500 rows at most."""
    path = scratch_path(spark, "pages")
    size = 500
    page = F.floor(F.col("c_custkey") / size)
    row = F.struct("c_custkey", "c_name", "c_mktsegment")
    (
        table(spark, sf_dir, "customer")
        .groupBy(page.alias("number"))
        .agg(F.collect_list(row).alias("results"))
        .write.json(path)
    )
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    rows = read_pages(spark, path, columns, page_size=size, number="number", lines=True)
    return rows.withColumn("c_custkey", safe_int(F.col("c_custkey")))


#: Documents a compressed file holds at most, as one task has to read it whole.
FILE_DOCUMENTS = 25_000


def _landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge documents with a field that no schema lists, landed whole. Their files are
    compressed: as text they take many times what the table does."""
    path = scratch_path(spark, "documents")
    extra = F.col("standard_charge_information")[0]["description"].alias("extra")
    documents = charge_documents(spark, sf_dir).select("*", F.struct(extra).alias("unlisted"))
    documents.write.option("maxRecordsPerFile", FILE_DOCUMENTS).json(path, compression="gzip")
    return read_raw_documents(spark, path, lines=True)


def scan_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents under their schema, through the double explode."""
    return (
        prices.stage_json_payers(_landed_documents(spark, sf_dir))
        .groupBy("code", "payer_name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("negotiated_dollar")).cast("bigint").alias("dollars"),
        )
    )


def scan_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unlisted field of every landed document."""
    return typed_fields(_landed_documents(spark, sf_dir), {"extra": ("$.unlisted.extra", "string")})


def _preamble_files(df: DataFrame, path: str, preamble: list[str], encoding: str = "utf-8") -> None:
    """Lines of text (column ``value``) as files that each begin with the preamble."""

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array([p.encode(encoding) for p in preamble], pa.binary())], ["value"])
        for batch in batches:
            lines = [v.encode(encoding) for v in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(lines, pa.binary())], ["value"])

    df.select("value").mapInArrow(put, "value binary").select(F.col("value").cast("string")).write.mode("append").text(path)


def scan_preamble_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items through a folder of CSV files with two records above the header."""
    path = scratch_path(spark, "preamble")
    items = table(spark, sf_dir, "lineitem")
    quoted = F.concat(F.lit('"'), "l_linestatus", F.lit(', ""x"""'))
    lines = items.select(F.concat_ws(",", "l_suppkey", "l_quantity", quoted).alias("value"))
    _preamble_files(lines, path, ["name,date", '"a, b",2024-01-01,more', "supp|key,l quantity,note"])
    rows = read_csv(spark, path, 2).df
    return rows.groupBy(safe_int(F.col("supp_key")).alias("supplier"), "note").agg(
        F.count(F.lit(1)).alias("n"), F.sum(safe_double(F.col("l_quantity"))).alias("quantity")
    )


def scan_latin1_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through a folder in which some files are UTF-8 and some Latin-1."""
    path = scratch_path(spark, "encodings")
    line = F.concat_ws(",", "c_custkey", F.concat(F.lit("é "), "c_mktsegment")).alias("value")
    customers = table(spark, sf_dir, "customer")
    for odd, encoding in ((0, "utf-8"), (1, "latin-1")):
        _preamble_files(customers.filter(F.col("c_custkey") % 2 == odd).select(line), path, ["key,segment"], encoding)
    return read_csv(spark, path).df.select(safe_int(F.col("key")).alias("c_custkey"), "segment")


def catalog_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalogs with an entry per line item: the download of the first entry
    that holds an id."""
    path = scratch_path(spark, "catalogs")
    ident = F.concat(F.lit("http://x/"), F.col("l_partkey").cast("string"))
    address = lambda end: F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber", F.lit(end)).alias("downloadURL"))
    entry = F.struct(
        F.col("l_linenumber").alias("at"),
        ident.alias("identifier"),
        F.when(F.col("l_linenumber") != 2, F.array(address(".json"), address(".CSV"), address(".csv"))).alias("distribution"),
    )
    (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(entry)).alias("dataset"))
        .write.json(path)
    )
    catalogs = read_documents(spark, path, "l_orderkey bigint, " + CATALOG, lines=True)
    return first_downloads(catalogs, "/1", by=["l_orderkey"])


def load_and_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items loaded, loaded again, then once with a broken row and once empty: the
    table is that of the second load."""
    path = scratch_path(spark, "table")
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", "l_quantity")
    truncate_and_load(items.withColumn("l_quantity", F.lit(0.0)), path)
    truncate_and_load(items, path)
    broken = F.when(F.col("l_linenumber") < 2, F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("l_quantity"))
    try:
        truncate_and_load(items.withColumn("l_quantity", broken), path)
    except PySparkException:
        truncate_and_load(items.filter("l_quantity < 0"), path, empty=False)
    loaded = spark.read.parquet(path)
    return loaded.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


# --- checks --------------------------------------------------------------------------


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null(entity_mart(spark, sf_dir), "has_core").select("entity_id", "region")


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return checks.unique(items, "l_orderkey", "l_linenumber")


def check_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_events(spark, sf_dir)
    return checks.accepted_range(staged, "score", 100, 20000, "NOT is_suppressed").select(
        "event_id", "score"
    )


def check_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return checks.accepted_values(events, "event_type", ["click", "view"], F.col("value") > 50)


def check_singular(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = entity_mart(spark, sf_dir)
    known = F.coalesce(F.col("has_core"), F.lit(False))
    return checks.implies(mart, known, F.col("total_volume") >= 5000, ["entity_id", "total_volume"])


def row_preservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return checks.row_preservation(
        {
            "events": (events, staged_events(spark, sf_dir)),
            "usable_events": (events, usable_events(spark, sf_dir)),
            "lineitem": (table(spark, sf_dir, "lineitem"), tall_stage(spark, sf_dir)),
        }
    )


def key_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_integrity(entity_mart(spark, sf_dir), "entity_id", "avg_outcome")


def _failing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "unique_lineitem": check_unique(spark, sf_dir),
        "values_event_type": check_values(spark, sf_dir),
        "range_quantity": checks.accepted_range(
            table(spark, sf_dir, "lineitem"), "l_linenumber", 1, 9
        ).select("l_orderkey"),
        "status_orders": table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select("o_orderkey", "o_orderstatus"),
    }


def failure_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing rows stored, read back for the run, counted and sampled."""
    folder = scratch_path(spark, "audit")
    store_failures(_failing(spark, sf_dir), folder, "run1")
    found = checks.collect_failures(read_failures(spark, folder, "run1"))
    return found.select("check_name", "n_failing", F.array_join("samples", "|").alias("samples"))


def triage_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "audit")
    store_failures(_failing(spark, sf_dir), folder, "run1")
    found = checks.collect_failures(read_failures(spark, folder, "run1"))
    messages = F.format_string("Got %d results", F.col("n_failing"))
    n = F.count(F.lit(1)).alias("n_rows")
    checked = (
        table(spark, sf_dir, "lineitem").agg(F.lit("unique_lineitem").alias("check_name"), n)
        .unionByName(table(spark, sf_dir, "orders").agg(F.lit("status_orders").alias("check_name"), n))
    )
    return checks.triage_packet(found, messages, checked).select(
        "check_name", "message", "n_failing", "n_rows", "failure_type", "packet"
    )


def recent_failures_by_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "audit")
    store_failures(_failing(spark, sf_dir), folder, "run1")
    recent = recent_failures(spark, folder, "2000-01-01 00:00:00")
    stale = recent_failures(spark, folder, "2999-01-01 00:00:00").agg(F.count(F.lit(1))).scalar()
    return recent.groupBy("check_name").agg(F.count(F.lit(1)).alias("n_failing")).withColumn("n_stale", stale)


def headline_reproduces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each correlation against an expected one: the first found another way, the second
    next to it, outside the tolerance."""
    kept = written_reliable(spark, sf_dir, *{c for pair in COLUMNS.pairs.values() for c in pair})
    r = {
        name: F.round(F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)), 6)
        for name, (x, y) in ((n, [F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c)) for c in (a, b)]) for n, (a, b) in COLUMNS.pairs.items())
    }
    real = kept.agg(*(F.coalesce(c, F.lit(0.0)).alias(n) for n, c in r.items())).first()
    expected = {
        "rating_vs_outcome": (real["rating_vs_outcome"], 0.01),
        "cost_vs_outcome": (real["cost_vs_outcome"] + 0.02, 0.05),
    }
    found = checks.reproduces(correlations(kept, COLUMNS.pairs), expected, 0.01)
    return found.select("pair", "n", F.round("expected_r", 6).alias("expected_r"), "r_matches", "p_matches")


def totals_against(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against what the orders let expect, and their keys against suppliers."""
    items, n = table(spark, sf_dir, "lineitem"), F.count(F.lit(1))
    expected = [table(spark, sf_dir, t).agg(n).first()[0] for t in ("orders", "supplier")]
    return checks.totals_match(items, "l_suppkey", 4 * expected[0], expected[1], tolerance=0.1)


QUERIES = {
    "stage_suppressed_measures": staged_events,
    "safe_cast_matrix": safe_cast_matrix,
    "suppression_profile": suppression_profile,
    "footnote_counts": lambda s, d: aggregate.category_counts(staged_events(s, d), "footnote_code"),
    "key_coverage": key_coverage,
    "prefix_region": prefix_region,
    "string_helpers": string_helpers,
    "json_scalar": json_scalar,
    "weighted_cost": weighted_cost,
    "entity_attributes": entity_attributes,
    "measure_pivot": measure_pivot,
    "summary_row_max": ratings_by_entity,
    "quality_full_outer": quality_full_outer,
    "dimension_lookup": lookup_nation,
    "entity_mart": entity_mart,
    "analytic_set": lambda s, d: analytic_set(entity_mart(s, d), *COLUMNS.reliability),
    "analytic_counts": lambda s, d: analytic_counts(entity_mart(s, d), *COLUMNS.reliability),
    "export_projection": export_projection,
    "exact_quantiles": quantiles_by_flag,
    "describe_volume": describe_volume,
    "describe_mart": describe_mart,
    "threshold_counts": lambda s, d: aggregate.threshold_counts(
        entity_mart(s, d), "total_volume", COLUMNS.thresholds
    ),
    "group_medians": medians_by_region,
    "median_gap": regional_gap,
    "pearson_overall": pearson_overall,
    "pearson_by_group": pearson_by_group,
    "pearson_pvalue": pearson_pvalue,
    "quadrant_split": quadrant_split,
    "quadrant_counts": lambda s, d: aggregate.category_counts(quadrants(s, d), "quadrant"),
    "quadrant_gap": quadrant_gap,
    "quadrant_listing": quadrant_listing,
    "headline_report": headline_report,
    "wide_melt": wide_melt,
    "recovered_plans": recovered_plans,
    "tall_stage": tall_stage,
    "nested_first": nested_first,
    "nested_explode": nested_explode,
    "contract_union": contract_rows,
    "contract_totals": contract_totals,
    "scan_csv_text": scan_csv_text,
    "scan_paged_json": scan_paged_json,
    "scan_nested_json": scan_nested_json,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_range": check_range,
    "check_values": check_values,
    "check_singular": check_singular,
    "row_preservation": row_preservation,
    "key_integrity": key_integrity,
    "failure_collection": failure_collection,
    "triage_packet": triage_packet,
    "dropped_groups": lost_groups,
    "scan_raw_json": scan_raw_json,
    "scan_preamble_csv": scan_preamble_csv,
    "scan_latin1_csv": scan_latin1_csv,
    "catalog_resolve": catalog_resolve,
    "load_and_reload": load_and_reload,
    "recent_failures": recent_failures_by_check,
    "headline_reproduces": headline_reproduces,
    "totals_match": totals_against,
}
