import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payscope.operators import checks
from payscope.operators.aggregate import (
    category_counts,
    cell_mean_gap,
    cost_by_entity,
    dependent_attributes,
    key_coverage,
    measures_by_entity,
    summary_row_max,
    threshold_counts,
    value_profile,
)
from payscope.operators.contract import conform, contract_union
from payscope.operators.joins import dimension_lookup, full_join, spine_join, with_identity
from payscope.operators.segments import analytic_counts, analytic_set, listing, median_split


def test_weighted_cost(spark, rows):
    df = spark.createDataFrame(
        [
            ("H", "d1", 10000.0, 90, "b"), ("H", "d2", 50000.0, 10, "a"),
            ("H", "d3", 7000.0, 0, "0"), ("H", "d4", None, 5, "0"), ("H", "d5", 9000.0, None, "0"),
            (None, "d1", 1.0, 2, None), ("G", "d1", 2.0, 1, None), ("G", "d1", 4.0, 1, "x"),
        ],
        "k string, drg string, v double, w int, name string",
    )
    plain = cost_by_entity(df, "k", "v", "w", "drg")
    assert rows(plain) == [("G", 1, 2, 3.0, 3.0), ("H", 2, 100, 14000.0, 30000.0), (None, 1, 2, 1.0, 1.0)]
    # The name comes from counted rows only, and is the least of them.
    named = cost_by_entity(df.dropna(subset=["k"]), "k", "v", "w", "drg", attributes=["name"])
    assert [r[:2] for r in rows(named)] == [("G", "x"), ("H", "a")]


def test_dependent_attributes_do_not_sort_the_input(spark):
    df = spark.range(100).select(
        (F.col("id") % 3).alias("k"), F.concat(F.lit("n"), F.col("id") % 3).alias("name")
    )
    out = dependent_attributes(df, "k", ["name"])
    assert sorted(tuple(r) for r in out.collect()) == [(0, "n0"), (1, "n1"), (2, "n2")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # The aggregation next to the scan hashes; only its small result is sorted.
    assert plan.rindex(" HashAggregate") > plan.rindex("SortAggregate")


def test_measures_and_summary(spark, rows):
    df = spark.createDataFrame(
        [("A", "m1", 1.0), ("A", "m1", 2.0), ("A", "m2", 4.0), ("A", "zz", 9.0), ("B", "zz", 0.5)],
        "k string, m string, v double",
    )
    got = measures_by_entity(df, "k", "m", "v", {"one": "m1", "two": "m2"})
    # Core rows are counted, not core measures.
    assert rows(got) == [("A", 3, 4.0, 3, 1.5, 4.0), ("B", 1, 0.5, 0, None, None)]
    best = summary_row_max(df.withColumn("v", F.col("v").cast("int")), "k", "m", "m1", "v", "top")
    assert rows(best) == [("A", 2)]


def test_joins(spark, rows):
    make = lambda data, schema: spark.createDataFrame(data, schema)
    stars = make([("A", 5), ("D", 3)], "k string, star int")
    outcomes = make([("B", 0.1), ("D", 0.2), ("E", 0.3)], "k string, psi double")
    both = full_join(stars, outcomes, "k")
    assert rows(both) == [("A", 5, None), ("B", None, 0.1), ("D", 3, 0.2), ("E", None, 0.3)]
    cost = make([("A", 1.0), ("B", 2.0), ("C", 3.0)], "k string, cost double")
    core = make([("A", 3), ("B", 2)], "k string, core int")
    joined = spine_join(cost, "k", core, both).select("k", (F.col("core") == 3).alias("has"), "star")
    assert rows(joined) == [("A", True, 5), ("B", False, None), ("C", None, None)]


def test_lookup_and_identity(spark, rows):
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "s string")
    dim = spark.createDataFrame([("x", "1"), ("y", "2")], "s string, ccn string")
    assert rows(dimension_lookup(df, dim, "s")) == [("x", "1"), ("y", "2"), ("z", None)]
    tagged = with_identity(df.limit(1), {"ccn": "330125", "note": None})
    assert tagged.schema["note"].dataType == T.StringType() and tagged.first()[1:] == ("330125", None)


def test_analytic_set_leaves_out_the_unknown(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", 500, True, 1.0, 1.0), ("b", 499, True, 1.0, 1.0), ("c", 900, None, 1.0, 1.0),
            ("d", 900, False, 1.0, 1.0), ("e", 900, True, None, 1.0), ("f", None, True, 1.0, 1.0),
        ],
        "k string, v int, f boolean, r double, c double",
    )
    rule = ("v", 500, "f", ["r", "c"])
    assert [r.k for r in analytic_set(df, *rule).collect()] == ["a"]
    assert tuple(analytic_counts(df, *rule).first()) == (6, 1, 5)


def test_median_split_listing_and_gap(spark, rows):
    df = spark.createDataFrame(
        [("a", "long name here", 1.0, 2.0), ("b", "n", 2.0, 1.0), ("c", "n", 3.0, 1.0), ("d", "n", 3.0, 3.0)],
        "k string, name string, cost double, ratio double",
    )
    cut = spark.createDataFrame([(2.5, 1.5)], "c double, r double")
    split = median_split(
        df, cut, {"c": ("cost", "high", "low"), "r": ("ratio", "poor", "good")}, "quadrant"
    )
    assert [(r.k, r.quadrant) for r in split.orderBy("k").collect()] == [
        ("a", "low / poor"), ("b", "low / good"), ("c", "high / good"), ("d", "high / poor"),
    ]
    counts = category_counts(split, "quadrant").collect()
    assert sum(r.n for r in counts) == 4
    shown = listing(split, "quadrant", "low / poor", ["cost"], ["k", "name"], {"name": 4}).collect()
    assert [tuple(r) for r in shown] == [("a", "long")]
    gap = cell_mean_gap(split, "quadrant", "cost", "low / good", "high / poor").first()
    assert tuple(gap) == (1, 1, 2.0, 3.0, 1.0, 50.0)
    assert cell_mean_gap(split, "quadrant", "cost", "low / good", "none").count() == 0


def test_profiles(spark, rows):
    df = spark.createDataFrame([("N/A",), (" N/A ",), (None,), ("",), ("5",), ("6",), ("7",), ("8",)], "x string")
    assert rows(value_profile(df, "x", ["N/A"])) == [
        ("(blank)", 1, 0.125), ("(null)", 1, 0.125), ("(value)", 4, 0.5), ("N/A", 2, 0.25),
    ]
    assert rows(key_coverage({"t": (df, "x")})) == [("t", 8, 7)]
    numbers = spark.createDataFrame([(50,), (100,), (600,), (None,)], "v int")
    assert rows(threshold_counts(numbers, "v", [100, 500])) == [(100, 2), (500, 1)]


CONTRACT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("plan", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def test_contract_union(spark, rows):
    wide = spark.createDataFrame([("p1", 1.0, "x"), ("p1", 1.0, "x")], "label string, price double, extra string")
    bare = spark.createDataFrame([("p2",)], "plan string")
    got = contract_union({"w": wide, "b": bare}, CONTRACT, "source", {"w": {"plan": "label"}})
    assert got.schema == CONTRACT or [f.name for f in got.schema] == ["source", "plan", "price"]
    # Duplicates stay.
    assert rows(got) == [("b", "p2", None), ("w", "p1", 1.0), ("w", "p1", 1.0)]
    with pytest.raises(TypeError, match="price"):
        conform(spark.createDataFrame([("1",)], "price string"), CONTRACT)


def test_filter_on_the_label_prunes_branches(spark):
    a, b = spark.range(5).toDF("n"), spark.range(7).toDF("n")
    contract = T.StructType([T.StructField("source", T.StringType()), T.StructField("n", T.LongType())])
    kept = contract_union({"a": a, "b": b}, contract, "source").filter("source = 'a'")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 5 and plan.count("Range") == 1


def test_checks(spark, rows):
    keys = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "k string")
    assert checks.not_null(keys, "k").count() == 1
    assert rows(checks.unique(keys, "k")) == [("A", 2)]
    values = spark.createDataFrame([(-0.1,), (0.0,), (3.0,), (3.1,), (None,)], "x double")
    assert checks.accepted_range(values, "x", 0, 3, "x is not null").count() == 2
    assert checks.accepted_range(values, "x", maximum=3).count() == 1
    stars = spark.createDataFrame([(1,), (5,), (6,), (None,)], "s int")
    assert rows(checks.accepted_values(stars, "s", [1, 2, 3, 4, 5], "s is not null")) == [(6, 1)]
    mart = spark.createDataFrame([("a", True, None), ("b", True, 1.0), ("c", None, None)], "k string, f boolean, v double")
    known = F.coalesce(F.col("f"), F.lit(False))
    assert [r.k for r in checks.implies(mart, known, F.col("v").isNotNull(), ["k"]).collect()] == ["a"]
    assert tuple(checks.key_integrity(keys, "k", "k").first()) == (4, 2, 1, 1, False)
    assert rows(checks.row_preservation({"ok": (keys, keys), "bad": (keys, stars.limit(1))})) == [
        ("bad", 4, 1, "MISMATCH"), ("ok", 4, 4, "OK"),
    ]
    assert checks.totals_match(keys, "k", 5, 2, 0.25).first().matches is True
    assert checks.totals_match(keys, "k", 5, 2).first().matches is False


def test_reproduces(spark):
    found = spark.createDataFrame(
        [("rating", 90, -0.4035, 8e-05), ("cost", 90, -0.0612, 0.567), ("other", 9, 0.1, 0.2)],
        "pair string, n long, r double, p double",
    )
    got = {
        r.pair: (r.r_matches, r.p_matches)
        for r in checks.reproduces(found, {"rating": (-0.40, 0.001), "cost": (0.06, 0.05)}, 0.01).collect()
    }
    assert got == {"rating": (True, True), "cost": (False, True)}


def test_inventory(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    assert checks.inventory(spark, ["default"]).first().n_objects >= 1


def test_failures_and_packet(spark):
    failing = {
        "range_ratio": spark.range(68).select(F.col("id").alias("ccn"), (F.col("id") * 1.5).alias("ratio")),
        "passes": spark.range(0).toDF("x"),
        "values": spark.createDataFrame([("odd", 2)], "v string, n_rows int"),
    }
    found = checks.collect_failures(checks.failing_rows(failing))
    got = {r.check_name: r for r in found.collect()}
    assert set(got) == {"range_ratio", "values"}
    assert got["range_ratio"].n_failing == 68 and len(got["range_ratio"].samples) == 15
    messages = spark.createDataFrame([("range_ratio", "Got 68 results")], "check_name string, message string")
    checked = spark.createDataFrame([("range_ratio", 70)], "check_name string, n_rows long")
    packet = {r.check_name: r for r in checks.triage_packet(found, messages, checked).collect()}
    assert packet["range_ratio"].failure_type == "upstream-source-change"
    assert packet["values"].failure_type == "unclear" and "(not available)" in packet["values"].packet
    assert packet["range_ratio"].packet.startswith(
        "check: range_ratio\nmessage: Got 68 results\nfailing rows: 68\nsample:\n[{"
    )
    wide = checked.withColumn("n_rows", F.lit(680))
    assert checks.triage_packet(found, None, wide).filter("check_name = 'range_ratio'").first()[
        "failure_type"
    ] == "test-config-too-strict"


def test_messages_match_by_the_start_of_a_name(spark):
    long = "not_null_hospital_readmissions_facility"
    names = spark.createDataFrame([(n,) for n in ("range_ratio", long, "alone", "")], "check_name string")
    said = spark.createDataFrame(
        [("test.pkg.range_ratio.ab12", "b"), ("range_ratio_x", "a"), ("other", "c"), (long[:30] + "_cut", "d"), ("", "e"), (None, "f")],
        "check_name string, message string",
    )
    got = {r.check_name: r.message for r in checks.match_messages(names, said).collect()}
    assert got == {"range_ratio": "a", long: "d"}
    brute = {n: sorted(m for k, m in (("test.pkg.range_ratio.ab12", "b"), ("range_ratio_x", "a"), ("other", "c"), (long[:30] + "_cut", "d")) if n[:30] in k or k[:30] in n) for n in ("range_ratio", long, "alone")}
    assert brute == {"range_ratio": ["a", "b"], long: ["d"], "alone": []}
