"""Every query of the subpackage against its SQL, on the smallest tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
import public_tokenizers
from parity import compare, connect
from payscope.llm.queries import QUERIES
from payscope.llm.sql import SQL

from payscope.llm import decontaminate

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return {r.doc_id: r.text or "" for r in rows}


def answer(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SMALL).collect()}


def test_op2_is_the_library(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = answer(spark, "op2_sentencepiece")
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = library.encode(t)
        digest = [hashlib.sha256(v.encode()).hexdigest() for v in (",".join(map(str, ids)), library.decode(ids))]
        assert [got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256] == [len(ids), *digest]


def test_op3_changes_private_values_and_nothing_else(spark, texts):
    got = answer(spark, "op3_pii")
    valid = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])")
    for i, t in texts.items():
        private = valid.findall(t)
        assert got[i].n_found >= len(private) and not [v for v in private if v in got[i].text]
        if not got[i].n_found:
            assert got[i].text == t
        assert len(got[i].text) == len(t) or "." in got[i].text  # parts of an address may get longer
        assert re.sub(r"[\w.@+-]*\d[\d\w.@ ()-]*|[\w.]+@\S+", "", t)[:20] == re.sub(r"[\w.@+-]*\d[\d\w.@ ()-]*|[\w.]+@\S+", "", got[i].text)[:20]


def test_op4_by_brute_force(spark, texts):
    from test_dedup import near_brute, plain_fingerprint

    got, ids = answer(spark, "op4_simhash"), sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    smallest = {}
    for i, root in zip(ids, near_brute(ids, prints)):
        smallest.setdefault(root, i)
    for i, f, root in zip(ids, prints, near_brute(ids, prints)):
        assert (int(got[i].fingerprint, 16), got[i].component_id) == (f, smallest[root])


def test_op5_by_aligning_every_pair(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    number = {}
    code = lambda t: np.array([number.setdefault(w, len(number)) for w in decontaminate.words(t)])
    passages = {i: code(t) for i, t in texts.items()}
    want = set()
    for k, item in items.items():
        coded = code(item)
        for i, p in passages.items():
            # Shared words bound the score, which spares most of the alignments.
            if len(p) and np.isin(coded, p).mean() >= decontaminate.THRESHOLD and decontaminate.align(coded, p)[0] >= decontaminate.THRESHOLD:
                want.add((i, k))
    assert {(r.doc_id, r.item_id) for r in QUERIES["op5_decontamination"](spark, SMALL).collect()} == want and want


def test_op7_learns_only_from_its_folds(spark, texts):
    got = answer(spark, "op7_quality")
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_op8_is_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = answer(spark, "op8_token_counts")
    assert set(got) == set(texts)
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 1024)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(SMALL), SMALL, name, QUERIES[name], SQL[name])
    assert ok, note


def test_pipeline_keeps_what_every_stage_keeps(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, left = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    kept = left
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= kept and now, name
        kept = now
    assert kept < left
    run = {r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()}
    assert run == kept
