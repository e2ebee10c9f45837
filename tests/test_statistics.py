import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from payscope.functions.statistics import pearson, pearson_p_value, relative_gap, weighted_mean
from payscope.operators.correlation import correlations, headline

# (r, n) -> two-sided p
KNOWN = [
    (-0.40, 90, 9.380668e-05),
    (-0.06, 90, 0.5742797),
    (-0.61, 25, 0.0012051),
    (-0.50, 27, 0.0079127),
    (-0.07, 38, 0.6762342),
]


def finite_series(r, n):
    """P(|t| > ..) for whole degrees of freedom, term by term."""
    v, x = n - 2, 1 - r * r
    total, term = 0.0, 1.0
    if v % 2 == 0:
        for k in range(v // 2):
            total += term
            term *= (2 * k + 1) / (2 * k + 2) * x
        return 1 - abs(r) * total
    term = math.sqrt(x)
    for k in range((v - 1) // 2):
        total += term
        term *= (2 * k + 2) / (2 * k + 3) * x
    return 1 - 2 / math.pi * (math.atan2(abs(r), math.sqrt(x)) + abs(r) * total)


def p_values(spark, pairs):
    df = spark.createDataFrame([(i, r, n) for i, (r, n) in enumerate(pairs)], "i int, r double, n long")
    return [x[0] for x in df.orderBy("i").select(pearson_p_value(F.col("r"), F.col("n"))).collect()]


def test_known_p_values(spark):
    for p, (_, _, want) in zip(p_values(spark, [k[:2] for k in KNOWN]), KNOWN, strict=True):
        assert p == pytest.approx(want, rel=1e-5)


def test_p_value_against_the_series(spark):
    pairs = [(r, n) for r in (0.0, 1e-3, 0.07, 0.3, 0.61, 0.7, 0.9, 0.999, 0.9999999)
             for n in (3, 4, 5, 6, 7, 20, 101, 5000)]
    for p, pair in zip(p_values(spark, pairs), pairs, strict=True):
        assert p == pytest.approx(finite_series(*pair), abs=1e-10)


def test_p_value_tails_and_edges(spark):
    tiny, large, perfect, few, missing = p_values(
        spark, [(0.9, 90), (1e-5, 10**12), (-1.0, 5), (1.0, 2), (None, 10)]
    )
    # Leading order of the tail for df = 88, r = 0.9.
    assert 1e-34 < tiny < 1e-32
    assert large == pytest.approx(math.erfc(10 / math.sqrt(2)), rel=1e-6)
    assert perfect == 0.0 and few is None and missing is None


def tail(degrees, t):
    """Two-sided probability by integrating the density of t, to near full precision."""
    nodes, weights = np.polynomial.legendre.leggauss(400)
    # Past this width the density has fallen by more than e^-45.
    width = 90 / (t + 1) if t > 3 else 14 - t
    x = t + (nodes + 1) / 2 * width
    half = degrees / 2
    # log of Gamma(half + 1/2) / Gamma(half) / sqrt(half) by its asymptotic series
    ratio = -1 / (8 * half) + 1 / (192 * half**3) - 1 / (640 * half**5)
    log = ratio - math.log(2 * math.pi) / 2 - (degrees + 1) / 2 * np.log1p(x * x / degrees)
    return float(2 * np.sum(weights * np.exp(log)) * width / 2)


@pytest.mark.parametrize("n", [10**4, 10**5, 10**6, 10**9, 10**12])
def test_p_value_keeps_its_digits_at_large_n(spark, n):
    ts = [0.01, 0.5, 1.0, 1.96, 2.0, 3.3, 5.0, 9.0, 20.0, 30.0]
    degrees = n - 2
    rows = [(t, t / math.sqrt(degrees + t * t)) for t in ts]
    df = spark.createDataFrame(rows, "t double, r double").withColumn("n", F.lit(n).cast("long"))
    for row in df.withColumn("p", pearson_p_value(F.col("r"), F.col("n"))).collect():
        assert row.p == pytest.approx(tail(degrees, row.t), rel=1e-9), row


def test_pearson_pairs_and_edges(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=50), rng.normal(size=50)
    data = [(float(a), float(b)) for a, b in zip(x, y, strict=True)]
    data += [(None, 1e9), (1e9, None)]
    df = spark.createDataFrame(data, "x double, y double")
    r, back = df.select(pearson(F.col("x"), F.col("y")), pearson(F.col("y"), F.col("x"))).first()
    assert r == pytest.approx(float(np.corrcoef(x, y)[0, 1]), abs=1e-12) and r == pytest.approx(back)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert flat.select(pearson(F.col("x"), F.col("y"))).first()[0] is None
    assert flat.limit(1).select(pearson(F.col("x"), F.col("y"))).first()[0] is None
    assert flat.filter("x > 5").select(pearson(F.col("x"), F.col("y"))).first()[0] is None


def test_correlations_need_enough_pairs(spark):
    data = [("five", float(i), float(i * i), 1.0) for i in range(5)]
    data += [("six", float(i), float(-i * i), float(i % 3)) for i in range(6)]
    data += [(None, float(i), float(i % 4), 2.0) for i in range(7)] + [("five", None, 3.0, 1.0)]
    df = spark.createDataFrame(data, "g string, x double, y double, z double")
    got = {
        (r.pair, r.scope): (r.n, r.r, r.p)
        for r in correlations(df, {"xy": ("x", "y"), "xz": ("x", "z")}, "g").collect()
    }
    assert set(got) == {(p, s) for p in ("xy", "xz") for s in ("ALL", "six", None)}
    assert got["xy", "ALL"][0] == 18 and got["xz", None][1:] == (None, None)
    overall = correlations(df, {"xy": ("x", "y")}).first()
    assert (overall.n, overall.r) == (18, pytest.approx(got["xy", "ALL"][1]))


def test_headline_is_computed(spark):
    found = spark.createDataFrame(
        [("a", 90, -0.4, 9.4e-05), ("b", 90, -0.06, 0.5743)], "pair string, n long, r double, p double"
    )
    got = {r.pair: (r.sign, r.direction, r.statement) for r in headline(found).collect()}
    assert got["a"] == (
        "negative or zero", "moves opposite", "r=-0.40 (p<0.001) n=90 moves opposite",
    )
    assert got["b"][2] == "r=-0.06 (p=0.5743) n=90 little or no linear link"


def test_weighted_mean_and_gap(spark):
    df = spark.createDataFrame([(10000.0, 90), (50000.0, 10), (None, 5)], "v double, w int")
    assert df.select(weighted_mean(F.col("v"), F.col("w"))).first()[0] == pytest.approx(5e7 * 28 / 1e5 / 1.05)
    assert df.filter("w > 99").select(weighted_mean(F.col("v"), F.col("w"))).first()[0] is None
    gap = spark.range(1).select(relative_gap(F.lit(3.0), F.lit(2.0)), relative_gap(F.lit(3.0), F.lit(0.0)))
    assert tuple(gap.first()) == (0.5, None)
