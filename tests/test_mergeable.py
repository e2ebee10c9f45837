import numpy as np
import pytest
from pyspark.sql import functions as F

from payscope.operators.joins import longest_prefix
from payscope.operators.mergeable import (
    co_moments,
    distinct_sketches,
    error_bound,
    estimated,
    merged,
    pearson_of,
    united,
    without_each,
)
from payscope.sinks.tables import write_bucketed


def test_sketches_of_parts_unite(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).alias("x"), (F.col("id") % 9).alias("part"), (F.col("id") % 2).alias("half"))
    stored = distinct_sketches(df, ["half", "part"], "x")
    assert stored.count() == 18
    halves = {r.half: r for r in estimated(united(stored, ["half"])).collect()}
    whole = estimated(united(stored)).first()
    assert whole.n_rows == 200_000 and abs(whole.n_distinct - 60_000) <= 60_000 * error_bound()
    assert all(abs(r.n_distinct - 30_000) <= 30_000 * error_bound() for r in halves.values())
    # The same as one sketch of all rows, however they were parted.
    assert whole.n_distinct == estimated(distinct_sketches(df, [], "x")).first().n_distinct
    nothing = spark.createDataFrame([(None,)], "x long")
    assert tuple(estimated(distinct_sketches(nothing, [], "x")).first()) == (0, 1)


def moments(rows):
    x, y = (np.array([r[i] for r in rows if None not in r[1:]], float) for i in (1, 2))
    return len(x), np.corrcoef(x, y)[0, 1] if len(x) > 1 and x.std() > 0 and y.std() > 0 else None


def test_states_merge_and_leave_out(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{i % 4}", float(1e9 + rng.normal() + i % 4), float(rng.normal() + i % 4) if i % 7 else None) for i in range(4000)]
    rows += [("alone", 1e9, 5.0), ("empty", None, 1.0), ("flat", 1e9, 1.0), ("flat", 1e9, 2.0)]
    stored = co_moments(spark.createDataFrame(rows, "g string, x double, y double"), "x", "y", ["g"])
    r = lambda df: {row[0]: (row.n, row.r) for row in df.withColumn("r", pearson_of()).collect()}
    for found, pick in ((r(stored), lambda g, h: g == h), (r(without_each(stored, "g")), lambda g, h: g != h)):
        for g, (n, value) in found.items():
            want_n, want = moments([row for row in rows if pick(row[0], g)])
            assert n == want_n and value == (pytest.approx(want, abs=1e-7) if want is not None else None), g
    n, value = moments(rows)
    whole = merged(stored).withColumn("r", pearson_of()).first()
    assert whole.n == n and whole.r == pytest.approx(value, abs=1e-7)
    pairs = {row.h: row for row in merged(stored.withColumn("h", F.col("g") < "g2"), ["h"]).withColumn("r", pearson_of()).collect()}
    for h, row in pairs.items():
        n, value = moments([x for x in rows if (x[0] < "g2") == h])
        assert row.n == n and row.r == pytest.approx(value, abs=1e-7)
    none = merged(stored.filter("n = 0")).collect()
    assert none == [] or none[0].n is None


def test_longest_prefix(spark):
    prefixes = spark.createDataFrame([("a", "one"), ("ab", "two"), ("abcd", "four"), ("abcd", "also"), ("", "any"), (None, "x"), ("é", "accent")], "prefix string, label string")
    codes = ["a", "ab", "abc", "abcd", "abcdefg", "b", "", None, "éa", "A", "abc"]
    df = spark.createDataFrame([(i, c, "kept") for i, c in enumerate(codes)], "i int, code string, other string")
    got = {r.i: (r.code, r.other, r.label) for r in longest_prefix(df, "code", prefixes, "label").collect()}
    want = ["one", "two", "two", "also", "also", "any", "any", None, "accent", "any", "two"]
    assert [got[i] for i in range(len(codes))] == [(c, "kept", w) for c, w in zip(codes, want)]
    assert longest_prefix(df, "code", prefixes.limit(0), "label").filter("label is null").count() == len(codes)
    many = spark.range(20_000).select(F.col("id").cast("string").alias("prefix"), F.col("id").alias("label"))
    found = longest_prefix(spark.range(50_000, 50_100).select(F.col("id").cast("string").alias("code")), "code", many, "label")
    assert {r.code: r.label for r in found.collect()} == {str(i): int(str(i)[:4]) for i in range(50_000, 50_100)}


def test_bucketed_tables_join_without_a_shuffle(spark):
    tables = [write_bucketed(spark.range(1000 * n).select((F.col("id") % 500).alias("k"), F.col("id").alias(f"v{n}")), "k", 8) for n in (1, 2, 3)]
    joined = tables[0]
    for other in tables[1:]:
        joined = joined.join(other.hint("merge"), "k", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 500 * 2 * 4 * 6
    grouped = tables[1].groupBy("k").agg(F.sum("v2"))
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
