import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from payscope.operators import quantiles
from payscope.operators.quantiles import describe, exact_quantiles, group_medians, median_gap, quantiles_of_counts, value_counts

WANTED = {"q1": ("x", 0.25), "med": ("x", 0.5), "top": ("x", 1.0), "low": ("x", 0.0), "z": ("y", 0.9)}


def brute(values, p):
    kept = [v for v in values if v is not None]
    return float(np.quantile(kept, p)) if kept else None


def skewed(n, seed=0):
    """A third of all rows hold one value and half of all rows are in one group."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        g = "hot" if rng.random() < 0.5 else None if rng.random() < 0.1 else f"g{i % 5}"
        x = 7.0 if rng.random() < 1 / 3 else float(rng.lognormal(0, 4))
        y = None if g == "g1" or rng.random() < 0.2 else float(round(rng.normal(), 2))
        out.append((g, x, y))
    return out


def test_groups_match_brute_force(spark):
    data = skewed(9000)
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = {r.g: r for r in exact_quantiles(df, WANTED, ["g"]).collect()}
    assert set(got) == {g for g, _, _ in data}
    for g, r in got.items():
        mine = [(x, y) for h, x, y in data if h == g]
        for name, (c, p) in WANTED.items():
            want = brute([x if c == "x" else y for x, y in mine], p)
            assert r[name] == (pytest.approx(want, rel=1e-12) if want is not None else None)


def test_same_to_the_digit_however_rows_are_spread(spark):
    df = spark.createDataFrame(skewed(20000, 3), "g string, x double, y double")
    spread = exact_quantiles(df.repartition(13), WANTED).collect()
    assert spread == exact_quantiles(df, WANTED).collect()
    shares = [0.25, 0.5, 1.0, 0.0]
    direct = df.agg(F.percentile("x", F.array(*map(F.lit, shares))).alias("x")).first().x
    assert list(spread[0])[:4] == direct


def test_far_values(spark):
    """Buckets keep the order at the ends of what a double holds."""
    data = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 1.0000000000000002, -1.0, 2.0**-1022]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "x double")
    shares = [i / 9 for i in range(10)]
    got = exact_quantiles(df, {f"p{i}": ("x", p) for i, p in enumerate(shares)}).first()
    assert list(got) == pytest.approx(sorted(data), rel=1e-12)
    odd = spark.createDataFrame([(float("inf"),), (float("-inf"),), (3.0,), (float("nan"),)], "x double")
    r = exact_quantiles(odd, {"a": ("x", 0.0), "b": ("x", 1 / 3), "c": ("x", 2 / 3)}).first()
    assert (r.a, r.b, r.c) == (float("-inf"), 3.0, float("inf"))
    assert exact_quantiles(df.limit(0), {"a": ("x", 0.5)}).collect() == [(None,)]
    assert exact_quantiles(df.limit(0), {"a": ("x", 0.5)}, ["x"]).collect() == []


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6) | st.just(3.5), min_size=1, max_size=900))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, {"a": ("x", 0.37), "b": ("x", 0.5)}).first()
    assert got.a == pytest.approx(brute(values, 0.37), rel=1e-9, abs=1e-9)
    assert got.b == pytest.approx(brute(values, 0.5), rel=1e-9, abs=1e-9)


def test_two_values_that_fill_the_table(spark):
    data = [1.0] * 4000 + [2.0] * 4000 + [1.5] * 3
    df = spark.createDataFrame([(v,) for v in data], "x double").repartition(5)
    shares = (0.1, 0.4999, 0.5, 0.50005, 0.6)
    wanted = {f"p{i}": ("x", p) for i, p in enumerate(shares)}
    got = exact_quantiles(df, wanted).first()
    assert list(got) == [pytest.approx(brute(data, p)) for p in shares]


def test_describe(spark):
    df = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)] + [(None,)], "x double")
    got = describe(df, "x").first()
    assert tuple(got)[:2] == (4, 2.5) and tuple(got)[3:] == (1.0, 1.75, 2.5, 3.25, 4.0)
    assert got["std"] == pytest.approx(1.2909944487358056)


def test_medians_and_gap(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None), (None, 5.0)], "g string, x double"
    )
    got = {r.g: (r.n, r.m) for r in group_medians(df, "g", {"m": "x"}).collect()}
    assert got == {"a": (2, 2.0), "b": (2, 2.0), None: (1, 5.0)}
    gap = median_gap(df.filter("x is null or x < 3"), "g", "x", "b", "a").first()
    assert tuple(gap) == (2.0, 1.0, 1.0)
    assert median_gap(df, "g", "x", "b", "zzz").first().gap is None


def narrow(spark, n):
    """Different values that all begin alike."""
    return spark.range(n).select((F.lit(1.7e9) + F.col("id") * 5e5 / n).alias("x"))


def test_narrow_column_never_meets_in_one_window(spark, monkeypatch):
    """Two million values between 1.7e9 and 1.7e9 + 5e5 lie in a few buckets; what is put in
    order at the end, and the cells on the way, are no more than the stated number."""
    n, seen, kept = 2_000_000, [], quantiles.materialize

    def watch(df, name="table"):
        out = kept(df, name)
        if name == "targets":
            seen.append(out.agg(F.max("different")).first()[0])
        return out

    monkeypatch.setattr(quantiles, "materialize", watch)
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = exact_quantiles(narrow(spark, n), {f"p{i}": ("x", p) for i, p in enumerate(shares)}).first()
    assert list(got) == pytest.approx([1.7e9 + p * (n - 1) * 5e5 / n for p in shares], rel=1e-15)
    assert seen[0] > quantiles.WINDOW_ROWS >= seen[-1] and len(seen) == 2


@pytest.mark.parametrize("limit", [2, 3, 64])
def test_refinement_by_brute_force(spark, limit):
    """Small limits need several rounds, with ties, groups and values far apart."""
    data = skewed(3000, 5) + [("wide", v, v) for v in (5e-324, 1e-300, 1.0, 1.0 + 2**-52, 1.7e308, -1.7e308, -1e-5)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    wanted = {k: v for k, v in WANTED.items()}
    got = {r.g: r for r in quantiles_of_counts(value_counts(df, ["x", "y"], ["g"]), wanted, ["g"], limit).collect()}
    for g in {g for g, _, _ in data}:
        mine = [(x, y) for h, x, y in data if h == g]
        for name, (c, p) in wanted.items():
            want = brute([x if c == "x" else y for x, y in mine], p)
            assert got[g][name] == (pytest.approx(want, rel=1e-12) if want is not None else None), (g, name)


def test_all_doubles_of_one_bucket(spark):
    """Neighbouring doubles, which differ in the last bits only."""
    x = [np.nextafter(1.0, 2.0)]
    for _ in range(400):
        x.append(np.nextafter(x[-1], 2.0))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    wanted = {"a": ("x", 0.25), "b": ("x", 0.5), "c": ("x", 1.0)}
    assert list(quantiles_of_counts(value_counts(df, ["x"]), wanted, (), 4).first()) == [x[100], x[200], x[400]]


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(describe(df, "x").first()) == tuple(describe(df.limit(0), "x").first()) == (0, None, None, None, None, None, None, None)
    big = (1 << 62) + 1  # more than a double holds
    assert describe(spark.createDataFrame([(big,)], "x long"), "x").first()["max"] == big
    one = describe(spark.createDataFrame([(2.0,), (None,)], "x double"), "x").first()
    assert tuple(one) == (1, 2.0, None, 2.0, 2.0, 2.0, 2.0, 2.0)
