"""Every stage of the pipeline on odd rows: nulls, empty and long texts, repeated rows,
an empty table, and further columns whose names the operators use themselves."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
EXTRA = ["_row", "row", "fp", "kept", "score", "_body", "id", "key", "item_id", "found", "_made", "seed"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    text = "plain words of a usual document that says little but says it well and at some length . "
    texts = [None, "", " \n", text * 3, text * 3, (text * 3).upper(), text * 4000, "x" * 200_000, "short", "$$$ &&& ###"]
    rows = [(None if i % 4 == 1 else i, t, None if i % 3 else "en", None, None, *EXTRA) for i, t in enumerate(texts)]
    rows += rows[2:5]
    names = ", ".join(f"{c} string" for c in EXTRA)
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stage_keeps_columns_and_whole_rows(spark, odd, name, stage):
    out = stage(spark, odd, SMALL)
    assert out.schema == odd.schema
    held, kept = {tuple(r) for r in odd.collect()}, [tuple(r) for r in out.collect()]
    assert set(kept) <= held and len(kept) <= odd.count()
    texts = [r[1] or "" for r in kept]
    if name == "exact dedup":
        assert sorted(texts) == sorted({t or "" for _, t, *_ in held})
    if name == "SimHash near-dedup":
        assert len(texts) == len({t.lower().split()[0] if t.split() else "" for t in texts})
    if name == "benchmark decontamination":
        assert len(kept) == odd.count()
    assert stage(spark, odd.limit(0), SMALL).count() == 0


def test_last_stage(spark, odd):
    out = corpus_pipeline.STAGES[-1][1](spark, odd, SMALL)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == odd.count()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pairs = lambda df: sorted((r.ids, r.decoded) for r in df.collect())
    want = sorted((ids, model.decode(ids)) for ids in (model.encode(r.text or "") for r in odd.collect()))
    assert pairs(out) == want and ([], "") in want
    assert corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), SMALL).count() == 0


def test_the_rest_works_without_this_part(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(corpus_pipeline.__file__).parent
    for name in ("payscope", "__spark_entry__.py"):
        (shutil.copytree if (top / name).is_dir() else shutil.copy)(top / name, tmp_path / name)
    (tmp_path / "payscope" / "llm").rename(tmp_path / "gone")
    code = "import __spark_entry__ as e; assert e.queries() and set(e.queries()) == set(e.oracle_sql()); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout) >= 60, done.stderr
