"""Versions, runs and fused checks, beyond what the queries show."""

import pytest
from pyspark.sql import functions as F

from payscope.operators import checks
from payscope.sinks import snapshots
from payscope.sinks.snapshots import drop_versions, load_snapshot, read_snapshot, versions
from payscope.sinks.tables import read_failures, store_failures, store_fused_failures
from payscope.sources.ingest import Source
from payscope.sources.manifest import fingerprint, ingest_run, latest, read_manifest


def test_versions_and_time_travel(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(LookupError):
        read_snapshot(spark, path)
    assert load_snapshot(spark.range(3), path) == {"version": 1, "rows": 3, "columns": 1}
    # A load may read the table that it goes on.
    assert load_snapshot(read_snapshot(spark, path).withColumn("b", F.lit(1)), path)["version"] == 2
    assert load_snapshot(spark.range(0), path, empty=False)["version"] == 0
    assert load_snapshot(spark.range(0), path)["version"] == 3
    assert [read_snapshot(spark, path, v).count() for v in versions(spark, path)] == [3, 3, 0]
    assert read_snapshot(spark, path).count() == 0 and read_snapshot(spark, path, 2).columns == ["id", "b"]
    with pytest.raises(LookupError):
        read_snapshot(spark, path, 4)
    assert drop_versions(spark, path, 2) == [1] and versions(spark, path) == [2, 3]
    assert read_snapshot(spark, path, 2).count() == 3 and len(list((tmp_path / "t" / "data").iterdir())) == 3


def test_two_loads_at_once_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    load_snapshot(spark.range(1), path)
    # Both saw version 1 as the last one.
    monkeypatch.setattr(snapshots, "versions", lambda *_: [1])
    assert [load_snapshot(spark.range(n), path)["version"] for n in (2, 3)] == [2, 3]
    monkeypatch.undo()
    assert [read_snapshot(spark, path, v).count() for v in (1, 2, 3)] == [1, 2, 3]


def test_readers_find_a_table_at_every_moment(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "t"), []
    load_snapshot(spark.range(5), path)
    point = snapshots._point

    def watched(*args):
        seen.append(read_snapshot(spark, path).count())
        out = point(*args)
        seen.append(read_snapshot(spark, path).count())
        return out

    monkeypatch.setattr(snapshots, "_point", watched)
    load_snapshot(spark.range(7), path)
    assert seen == [5, 7]


def test_fingerprints_follow_the_files(spark, tmp_path):
    folder = tmp_path / "in"
    assert fingerprint(spark, str(folder)) is None
    folder.mkdir()
    (folder / "a.csv").write_text("a\n1\n")
    first = fingerprint(spark, str(folder))
    assert first == fingerprint(spark, str(folder))
    (folder / "b.csv").write_text("a\n2\n")
    both = fingerprint(spark, str(folder))
    (folder / "a.csv").write_text("a\n1\n3\n")
    assert len({first, both, fingerprint(spark, str(folder))}) == 3


def test_a_run_reads_what_changed(spark, tmp_path):
    folder, land, manifest = tmp_path / "in", str(tmp_path / "land"), str(tmp_path / "runs")
    folder.mkdir()
    (folder / "a.csv").write_text("a\n1\n")
    sources = {"a": Source(str(folder / "a.csv"), "csv"), "b": Source(str(folder / "b.json"), "json")}
    status = lambda run: {r.source: r.status for r in ingest_run(spark, sources, land, manifest, run).collect()}
    assert status("1") == {"a": "loaded", "b": "missing"}
    (folder / "b.json").write_text("{broken")
    assert status("2") == {"a": "unchanged", "b": "failed"}
    (folder / "b.json").write_text('{"x": 1}')
    (folder / "a.csv").write_text("a\n1\n2\n")
    assert status("3") == {"a": "loaded", "b": "loaded"}
    assert status("4") == {"a": "unchanged", "b": "unchanged"}
    runs = read_manifest(spark, manifest)
    assert runs.count() == 8 and {(r.source, r.run_id, r.rows) for r in latest(runs, "loaded").collect()} == {("a", "3", 2), ("b", "3", 1)}
    assert {r.run_id for r in latest(runs).collect()} == {"4"}


def test_fused_checks_equal_single_ones(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, i % 3, "ab"[i % 2] if i % 11 else None, float(i)) for i in range(200)] + [(1, 1, "z", 9.0)] * 3
    spark.createDataFrame(rows, "k int, m int, s string, v double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    where = F.col("v") > 50
    fused = [
        checks.missing("null_k", "k", ["s", "v"]), checks.missing("null_s", "s", ["k", "v"], where),
        checks.outside("range_v", "v", 10, 150, ["v", "m"]), checks.outside("open_range", "m", None, 1, ["m"], where), checks.outside("none", "v", None, None, ["v"]),
        checks.repeated("unique_km", "k", "m"), checks.repeated("unique_v", "v", where=where), checks.unlisted("listed_s", "s", ["a"]),
        checks.RowCheck("rule", (F.col("m") == 1) & (F.col("k") > 3), ("k", "m")),
    ]
    single = {
        "null_k": checks.not_null(df, "k").select("s", "v"), "null_s": checks.not_null(df, "s", where).select("k", "v"),
        "range_v": checks.accepted_range(df, "v", 10, 150).select("v", "m"), "open_range": checks.accepted_range(df, "m", None, 1, where).select("m"),
        "unique_km": checks.unique(df, "k", "m"), "unique_v": checks.unique(df, "v", where=where), "listed_s": checks.accepted_values(df, "s", ["a"]),
        "rule": df.filter("m = 1 and k > 3").select("k", "m"),
    }
    store_failures(single, str(tmp_path / "single"), "r")
    store_fused_failures([(df, fused), (df.limit(0), fused)], str(tmp_path / "fused"), "r")
    read = lambda name: sorted((r.check_name, r.failing_row) for r in read_failures(spark, str(tmp_path / name), "r").collect())
    assert read("fused") == read("single") and len({n for n, _ in read("fused")}) >= 7
    plan = checks.fused_failures(df, fused)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_stages_are_counted_by_the_job_that_runs_them(spark, tmp_path):
    counts = checks.StageCounts()
    raw = counts.through("raw", spark.range(1000).withColumn("k", F.col("id") % 7).repartition(4))
    few = counts.through("few", raw.filter("k < 3"))
    named = counts.through("named", few.join(spark.range(5).withColumnRenamed("id", "k"), "k", "left"))
    none = counts.through("none", named.filter("id < 0"))
    none.write.parquet(str(tmp_path / "none"))
    # A stage observed twice over, as after a lost executor, is counted by a scan.
    counts._observed["few"] = (counts._observed["few"][0], type("Twice", (), {"get": {"n": 858}})())
    got = counts.preserved(spark, [("raw", "few"), ("few", "named"), ("named", "none"), ("none", "none")]).collect()
    assert [tuple(r) for r in got] == [
        ("raw to few", 1000, 429, "MISMATCH"), ("few to named", 429, 429, "OK"), ("named to none", 429, 0, "MISMATCH"), ("none to none", 0, 0, "OK"),
    ]
