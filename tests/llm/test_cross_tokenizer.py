"""Alignment against plain loops over the libraries' tokens, on texts and hostile strings."""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from test_tokenizers import hostile
from tokenizers import Tokenizer

from payscope.llm import cross_tokenizer
from payscope.llm.queries import QUERIES
from payscope.llm.token_counts import byte_letters

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(byte_letters())}

    def tokens(text):
        """(id, start, end) of either side's tokens, none where the bytes differ."""
        if not text:
            return [], []
        raw, sides = (" " + text).encode(), []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelled_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        spelled_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        for ids, spelled in ((ids_a, spelled_a), (ids_b, spelled_b)):
            if b"".join(spelled) != raw:
                return [], []
            ends = np.cumsum([len(s) for s in spelled]).tolist()
            sides.append([(i, e - len(s), e) for i, s, e in zip(ids, spelled, ends)])
        return sides

    def results(texts):
        found = []
        for text in texts:
            ta, tb = tokens(text)
            cuts = sorted({e for *_, e in ta} & {e for *_, e in tb})
            groups = [([], []) for _ in cuts]
            for side, of in enumerate((ta, tb)):
                for i, _, e in of:
                    groups[bisect_left(cuts, e)][side].append(i)
            owner = {at: y for y in tb for at in range(y[1], y[2])}
            linked = [(x[0], y[0]) for x in ta for y in dict.fromkeys(owner[at] for at in range(x[1], x[2]))]
            said = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
            found.append((ta, tb, groups, linked, hashlib.sha256(said.encode()).hexdigest() if ta else ""))
        count = Counter(p for *_, linked, _ in found for p in linked)
        best = Counter()
        for (_, b), n in count.items():
            best[b] = max(best[b], n)
        return [
            (len(ta), len(tb), len(groups), len(linked), sum(count[p] == best[p[1]] for p in linked), sum(count[p] for p in linked), said)
            for ta, tb, groups, linked, said in found
        ]

    return results


def run(spark, texts, **more):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = cross_tokenizer.cross_tokenizer(docs, JSON, MODEL, **more).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


ODD = [None, "", " ", "<|endoftext|> <s> </s>", "▁", "a▁b", "\x00", "　", "ﬁ", "é", "é", "same text", "same text", "a" * 3000, " " * 3000, "👍🏽" * 50]


def test_hostile_texts_by_brute_force(spark, plain):
    texts = ODD + hostile(400)
    assert run(spark, texts) == plain(texts)


def test_rare_pairs_by_join(spark, plain, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "COMMON_PAIRS", 20)
    monkeypatch.setattr(cross_tokenizer, "HELD_PAIRS", 30)
    texts = ODD + hostile(60, 5)
    assert run(spark, texts) == plain(texts)


def test_no_pair_is_common(spark, plain, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "COMMON_PAIRS", 0)
    assert run(spark, ODD) == plain(ODD)


def test_long_texts_enter_as_several_lanes(plain, monkeypatch):
    own = cross_tokenizer.pair(JSON, MODEL)
    plainly = lambda t: "".join(c for c in t if c.isalnum() or c in " .,|!<>\n")
    texts = [plainly(" ".join(hostile(500, s))) for s in (1, 2)] + ["x", "the same words " * 700]
    whole = cross_tokenizer.align(own, texts)
    monkeypatch.setattr(cross_tokenizer, "LANE", 1 << 40)
    single = cross_tokenizer.align(own, texts)
    assert [v.tolist() for v in whole[:4]] == [v.tolist() for v in single[:4]] and whole[4] == single[4]
    assert [list(k) for k in whole[5]] == [list(k) for k in single[5]] and min(whole[0]) > 0
    assert [tuple(v[i] for v in whole[:5]) for i in range(4)] == [r[:4] + r[6:] for r in plain(texts)]


def test_a_million_characters(spark, plain):
    texts = [" " * 1_000_000, "a" * 1_000_000, "ab " * 300_000]
    got = run(spark, texts)
    library = Tokenizer.from_file(JSON)
    assert [r[0] for r in got] == [len(library.encode(" " + t, add_special_tokens=False).ids) for t in texts]


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], "row long, n_a string, pairs string, doc_id long, text string")
    assert cross_tokenizer.cross_tokenizer(docs, JSON, MODEL).collect() == []
    docs = spark.createDataFrame([(1, "x", "y", None, "some words"), (1, "x", "y", None, "some words")], docs.schema)
    assert [tuple(r)[:2] for r in cross_tokenizer.cross_tokenizer(docs, JSON, MODEL).collect()] == [(None, 2), (None, 2)]


def test_query_by_brute_force(spark, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_cross_tokenizer"](spark, "/root/testdata/sf0.001").collect()}
    assert got == dict(zip(docs, plain(docs.values())))
