import pytest
from pyspark.sql import functions as F

from payscope.functions.clean import (
    SURVEY_PLACEHOLDERS,
    any_present,
    blank_to_null,
    classify_prefix,
    is_suppressed,
    missing_to_null,
    reliable,
    safe_date,
    safe_double,
    safe_int,
    trimmed,
)
from payscope.plans.hospital import OTHER_REGION, REGIONS

# raw, footnote -> value, suppressed, suppressed in the survey, footnote code
CASES = [
    ("0.9804", " ", 0.9804, False, False, None),
    ("N/A", " 5 ", None, True, True, "5"),
    ("Not Available", "", None, True, True, None),
    ("  ", "1", None, True, True, "1"),
    (None, None, None, True, True, None),
    ("Too Few To Report", "1", None, False, False, "1"),
    ("Not Applicable", None, None, False, True, None),
    ("nan", None, None, False, False, None),
    ("None", None, None, False, False, None),
    ("1d", None, None, False, False, None),
    ("1f", None, None, False, False, None),
    ("0x1p3", None, None, False, False, None),
    ("Infinity", None, None, False, False, None),
    ("-inf", None, None, False, False, None),
    ("\t1.5e2 ", " 7\n", 150.0, False, False, "7"),
    (" N/A\t", None, None, True, True, None),
    ("+.5", None, 0.5, False, False, None),
]


def test_cast_and_suppression(spark):
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(CASES)], "i int, x string, f string")
    got = df.orderBy("i").select(
        safe_double(F.col("x")),
        is_suppressed(F.col("x")),
        is_suppressed(F.col("x"), SURVEY_PLACEHOLDERS),
        blank_to_null(F.col("f")),
    )
    assert [tuple(r) for r in got.collect()] == [c[2:] for c in CASES]


@pytest.mark.parametrize(
    ("text", "want"),
    [("12", 12), (" -7 ", -7), ("12.0", None), ("1e3", None), ("", None), ("nan", None), ("9" * 30, None)],
)
def test_safe_int(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(safe_int(F.col("x"))).first()[0] == want


def test_safe_date(spark):
    df = spark.createDataFrame(
        [("2021-07-01",), ("07/01/2021",), ("2021",), ("2021-02-30",), (" 2021-7-1",), (None,)], "x string"
    )
    plain = [str(r[0]) for r in df.select(safe_date(F.col("x"))).collect()]
    assert plain == ["2021-07-01", "None", "None", "None", "2021-07-01", "None"]
    wider = [str(r[0]) for r in df.select(safe_date(F.col("x"), ["MM/dd/yyyy"])).collect()]
    assert wider == ["2021-07-01", "2021-07-01", "None", "None", "2021-07-01", "None"]


def test_missing_text_is_null_and_only_that(spark):
    df = spark.createDataFrame([("nan",), ("None",), ("none",), (None,), ("x",)], "x string")
    assert [r[0] for r in df.select(missing_to_null(F.col("x"))).collect()] == [None, None, "none", None, "x"]


def test_trim_takes_all_whitespace(spark):
    df = spark.createDataFrame([(" \t a b \n",)], "x string")
    assert df.select(trimmed(F.col("x"))).first()[0] == "a b"


def test_regions(spark):
    cases = {
        "10016": "NYC", "11213": "NYC", "11691": "NYC", "10591": "Downstate suburbs",
        "11743": "Downstate suburbs", "11901": "Downstate suburbs", "12208": "Upstate",
        "14621": "Upstate", "": "Upstate",
    }
    df = spark.createDataFrame([*cases.items(), (None, "Upstate")], "zip string, want string")
    got = df.withColumn("got", classify_prefix(F.col("zip"), 3, REGIONS, OTHER_REGION))
    assert got.filter("got <> want").count() == 0


def test_reliable_is_three_valued(spark):
    df = spark.createDataFrame(
        [("A", 500, True), ("B", 600, False), ("C", 600, None), ("C2", 499, None)],
        "k string, v int, f boolean",
    )
    got = {r.k: r.x for r in df.select("k", reliable(F.col("v"), F.col("f"), 500).alias("x")).collect()}
    assert got == {"A": True, "B": False, "C": None, "C2": False}


def test_any_present_over_types(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a"), (None, None)], "a double, b string")
    assert [r[0] for r in df.select(any_present(F.col("a"), F.col("b"))).collect()] == [True, True, False]
