import random

import pytest
from pyspark.sql import functions as F

from payscope.operators.reshape import (
    discover_groups,
    dropped_groups,
    explode_nested,
    explode_records,
    first_element,
    melt_groups,
    recover_parts,
)
from payscope.plans import prices
from payscope.sources.names import clean_names, rename_map, sanitize_columns

SUFFIXES = prices.GROUP_SUFFIXES


def wide_columns(*plans):
    return [f"standard_charge_{p}_{s}" for p in plans for s in SUFFIXES]


def test_group_discovery():
    columns = ["code_1", "standard_charge_gross", *wide_columns("P", "Q"), *wide_columns("R")[:3]]
    columns += ["standard_charge_P_negotiated_dollar_1", "standard_charge__methodology"]
    found = discover_groups(columns, "standard_charge_", SUFFIXES)
    assert list(found.groups) == ["P", "Q"]
    assert found.incomplete == {"P_1": (columns[-2],), "R": tuple(wide_columns("R")[:3])}
    assert found.groups["P"] == tuple(wide_columns("P"))
    # Names that match no suffix are reported.
    assert found.ignored == ("standard_charge_gross", "standard_charge__methodology")
    with pytest.raises(ValueError, match="no complete group"):
        discover_groups(["standard_charge_gross"], "standard_charge_", SUFFIXES)


def test_plans_alike_once_cleaned(spark, rows):
    header = ["code|1"] + [f"standard_charge|P|{p}|{s}" for p in ("a b", "a/b") for s in SUFFIXES]
    del header[2]  # the first plan lacks a suffix, so numbers alone would mix the two up
    names = clean_names(header)
    groups = discover_groups(names, "standard_charge_", SUFFIXES, dict(zip(names, header)))
    assert list(groups.groups) == ["P_a_b_1"] and list(groups.incomplete) == ["P_a_b"]
    assert [header[names.index(c)].split("|")[2] for c in groups.groups["P_a_b_1"]] == ["a/b"] * 4
    lost = dropped_groups(spark.createDataFrame([("1", *"2345678"), ("1", *"2345", None, None, None)], names), groups)
    assert {(r.label, r.reason, r.n_cells) for r in lost.collect()} == {("P_a_b", "incomplete group", 2)} and lost.count() == 3
    header = ["code|1"] + [f"standard_charge|P|{p}|{s}" for p in ("a b", "a/b") for s in SUFFIXES]
    names = clean_names(header)
    raw = spark.createDataFrame([("1", *"12345678")], names)
    for originals in (None, dict(zip(names, header))):
        staged = prices.stage_wide(raw, originals).select("payer_plan", "negotiated_dollar", "methodology")
        assert rows(staged) == [("P_a_b", 1.0, "4"), ("P_a_b_1", 5.0, "8")]


def test_wide_stage(spark, rows):
    columns = ["code_1", *wide_columns("P", "Q"), *wide_columns("R")[:3]]
    none = [None] * 4
    data = [
        ("1", "100", None, None, None, *none, *none[:3]),
        ("2", *none, None, None, "74% of BC", None, *none[:3]),
        ("3", *none, None, None, None, "fee", *none[:3]),
        ("4", "nan", "None", "nan", None, *none, "5", "5", "5"),
    ]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
    groups = prices.wide_groups(raw)
    melted = melt_groups(raw.filter("code_1 < '4'"), ["code_1", "absent"], groups, "payer_plan")
    assert [r[:2] for r in rows(melted)] == [("1", "P"), ("2", "Q"), ("3", "Q")]
    staged = prices.stage_wide(raw)
    assert rows(staged.select("code", "plan_name", "payer_name", "negotiated_dollar", "negotiated_algorithm")) == [
        ("1", "P", None, 100.0, None), ("2", "Q", None, None, "74% of BC"),
    ]


def test_melt_is_one_scan_and_matches_brute_force(spark, rows):
    rng = random.Random(5)
    plans = [f"plan {i}`" for i in range(40)]
    suffixes = ("a", "b")
    columns = ["id", *(f"x_{p}_{s}" for p in plans for s in suffixes)]
    data = [
        (str(i), *(rng.choice([None, None, str(rng.randint(0, 9))]) for _ in columns[1:]))
        for i in range(50)
    ]
    df = spark.createDataFrame(data, columns)
    groups = discover_groups(columns, "x_", suffixes)
    melted = melt_groups(df, ["id"], groups, "plan")
    want = []
    for r in data:
        cells = dict(zip(columns, r, strict=True))
        for p in plans:
            pair = cells[f"x_{p}_a"], cells[f"x_{p}_b"]
            if pair != (None, None):
                want.append((r[0], p, *pair))
    assert rows(melted) == sorted(want, key=lambda t: [str(v) for v in t])
    plan = melted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 1


def test_hundreds_of_groups(spark, tmp_path):
    plans = [f"p{i:03}" for i in range(413)]
    columns = wide_columns(*plans)
    raw = spark.range(20).select(
        F.col("id").cast("string").alias("code_1"),
        *(F.when(F.col("id") % 2 == 0, F.lit("1")).alias(c) for c in columns),
    )
    raw.write.parquet(str(tmp_path / "wide"))
    staged = prices.stage_wide(spark.read.parquet(str(tmp_path / "wide")))
    assert staged.agg(F.count("*"), F.sum("negotiated_dollar")).first()[:] == (4130, 4130.0)


NAMES = [
    (
        "standard_charge|Cigna|CIGNA MANAGED CARE/POS 1046|negotiated_dollar",
        "standard_charge_Cigna_CIGNA_MANAGED_CARE_POS_1046_negotiated_dollar",
    ),
    ("code|1|type", "code_1_type"),
    ("1199 plan", "col_1199_plan"),
    ("||", "unnamed_column"),
    ("a b", "a_b"),
    ("a/b", "a_b_1"),
    ("A", "A"),
    ("a", "a_1"),
    ("x" * 310, "x" * 300),
    ("x" * 305, "x" * 298 + "_1"),
    ("_lead__ing_", "lead_ing"),
    ("café", "caf"),
    ("a_b_1", "a_b_1_1"),
]


def test_names(spark):
    assert clean_names([n for n, _ in NAMES]) == [c for _, c in NAMES]
    df, renames = sanitize_columns(spark.createDataFrame([(1, 2)], ["a|b", "ok"]))
    assert df.columns == ["a_b", "ok"]
    assert [tuple(r) for r in renames.collect()] == [(0, "a|b", "a_b")]


def test_recover_payer_and_plan(spark, rows):
    header = [f"standard_charge|Cigna|POS 10/46|{s}" for s in SUFFIXES] + ["standard_charge|gross"]
    renames = rename_map(spark, header, clean_names(header))
    df = spark.createDataFrame([("Cigna_POS_10_46", 1.0, None), ("other", 2.0, None)], "payer_plan string, v double, payer_name string")
    got = recover_parts(df, "payer_plan", renames, "standard_charge_", "negotiated_dollar", ["payer_name", "plan_name"])
    assert rows(got.select("payer_plan", "v", "payer_name", "plan_name")) == [
        ("Cigna_POS_10_46", 1.0, "Cigna", "POS 10/46"), ("other", 2.0, None, None),
    ]


def test_explode(spark, rows):
    df = spark.createDataFrame(
        [(1, [("a", [1, 2]), ("b", [])]), (2, [("c", None)]), (3, []), (4, None)],
        "id int, recs array<struct<n: string, xs: array<int>>>",
    )
    one = explode_records(
        df, F.col("recs"), {"n": F.col("record.n"), "x": first_element(F.col("record.xs"))}, ["id"]
    )
    assert rows(one) == [(1, "a", 1), (1, "b", None), (2, "c", None)]
    two = explode_nested(
        df, F.col("recs"), {"n": F.col("record.n")}, F.col("record.xs"), {"x": F.col("item")}, ["id"]
    )
    assert rows(two) == [(1, "a", 1), (1, "a", 2)]
