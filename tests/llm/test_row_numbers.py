"""Results stay right where every job splits its scans another way than the one before, as
it happens when executors come or go."""

from itertools import cycle

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from payscope.llm import exact_dedup, simhash, suffix_dedup, warc

PARTS = "spark.sql.files.minPartitionNum"
LONG = "one passage that is longer than a hundred bytes and stands in a good many of the documents of this small table, "


@pytest.fixture(params=[["1", "64"], ["1", "3", "64"]])
def shifting(spark, monkeypatch, request):
    """After every written table scans have another number of tasks."""
    write, parts = DataFrameWriter.parquet, cycle(request.param)

    def parquet(self, *args, **kwargs):
        write(self, *args, **kwargs)
        spark.conf.set(PARTS, next(parts))

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    spark.conf.set(PARTS, "64")
    yield
    spark.conf.unset(PARTS)


@pytest.fixture
def docs(spark, tmp_path):
    texts = [f"text number {i % 20} has word{i % 20} and other{i % 20} " * (1 + i % 20) for i in range(60)]
    texts = [f"{t} start{i % 20} {LONG if i % 2 else ''}" for i, t in enumerate(texts)]
    rows = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("page_id", "page_id doc_id", "html", "html text", "'u' url")
    rows.repartition(7, "page_id").write.parquet(str(tmp_path / "in"))
    return spark.read.parquet(str(tmp_path / "in"))


def test_one_row_of_each_text_stays(docs, shifting):
    kept = [r.text for r in exact_dedup.exact_dedup(docs).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == {r.text for r in docs.collect()}


def test_one_row_of_each_component_stays(docs, shifting):
    kept = [r.doc_id for r in simhash.simhash_dedup(docs).collect()]
    assert sorted(kept) == sorted({r.component_id for r in simhash.simhash_groups(docs).collect()})


def test_spans_are_cut_out_of_their_own_document(spark, docs, shifting):
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.suffix_dedup(docs, keep=True).collect()}
    raw, seen = {r.doc_id: r.text.encode() for r in docs.collect()}, set()
    for i in sorted(raw):
        text, cut = raw[i], [False] * len(raw[i])
        for a in range(len(text) - suffix_dedup.LENGTH + 1):
            piece = text[a : a + suffix_dedup.LENGTH]
            if piece in seen:
                cut[a : a + suffix_dedup.LENGTH] = [True] * suffix_dedup.LENGTH
            seen.add(piece)
        assert got[i] == bytes(c for c, gone in zip(text, cut) if not gone), i


def test_revisits_refer_to_their_own_payload(spark, docs, tmp_path, shifting):
    folder = str(tmp_path / "warc")
    got = {r.page_id: r for r in warc.read_warc(spark, folder, warc.write_warc(docs, folder)).collect()}
    raw, first = {r.page_id: r.html.encode() for r in docs.collect()}, {}
    for i in sorted(raw):
        of = first.setdefault(raw[i], i) if len(raw[i]) >= warc.LEAST_REVISIT else i
        assert got[i].refers_to == (of if of != i else None) and got[i].payload_bytes == len(raw[i])
        assert (got[i].record_type == "revisit") == (of != i)
    assert len(got) == len(raw)
