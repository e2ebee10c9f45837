"""The prefix tables against the libraries, on texts and on hostile strings."""

import hashlib
import random

import pytest

import public_tokenizers
from payscope.llm import sentencepiece_codec, token_counts
from payscope.llm.prefix_bpe import Memory, PrefixTable

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*"abcdeéß th'lls  \n\t\r0123456789.,|<>{}\x00\x1c\x1d\x85​　▁日本語ñÅ👍🏽"] + [
    "<|endoftext|>", "<s>", "<0x41>", "the ", "   ", "\n\n\n", "    x", "'ll", "'re", "ing", "Hello", "!!"
]


def hostile(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text for r in rows] + hostile(1500) + ["", " ", "a" * 5000, " " * 700, "aé" * 900, "👍" * 300]


def test_sentencepiece_ids_and_text(texts):
    own = sentencepiece_codec.codec(MODEL)
    for t in texts:
        assert own.encode(t) == own.library.encode(t), t[:60]
        assert own.decode(own.encode(t)) == own.library.decode(own.library.encode(t))


def test_byte_counts(texts):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(JSON), token_counts.counter(JSON)
    for t in texts:
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert own.count(t) == n, t[:60]
        counts = own.prefix_counts(t)
        assert counts[-1] == n and len(counts) == len(t.encode()) + 1


def test_cut_is_the_longest_prefix_within_the_budget():
    own = token_counts.counter(JSON)
    for t in hostile(300, 8):
        counts, raw = own.prefix_counts(t), t.encode()
        for limit in (0, 1, 3, 7, len(t) + 9):
            # whole characters, whole words before the one that crosses the limit
            size, n, best = 0, 0, 0
            for plain, special in own.parts(t):
                for w in [*own.words.findall(plain), *([special] if special else [])]:
                    end = size + len(w.encode())
                    if counts[end] > limit:
                        inside = [i for i in range(size, end) if (raw[i] & 0xC0) != 0x80 and counts[i] <= limit]
                        best = size if w == special else inside[-1]
                        break
                    size = best = end
                else:
                    continue
                break
            assert own.cut(t, limit) == best, (t, limit)


def test_prefix_table_is_merging():
    rng = random.Random(1)
    merges = {}
    symbols = list("abc")
    for i in range(25):
        a, b = rng.choice(symbols), rng.choice(symbols)
        if (a, b) not in merges and a + b not in symbols:
            merges[a, b] = i
            symbols.append(a + b)
    table = PrefixTable({s: i for i, s in enumerate(symbols)}, lambda a, b: merges.get((a, b)))
    for _ in range(400):
        t = "".join(rng.choices("abcd", k=rng.randint(1, 25)))
        assert table.encode(t) == table.merged(t)
        assert table.counts(t) == [0] + [len(table.merged(t[:i])) for i in range(1, len(t) + 1)]


def test_memory_is_bounded_and_right():
    made = []
    memory = Memory(lambda w: made.append(w) or len(w), 10)
    for i in range(200):
        w = "x" * (i % 25 + 1)
        assert (memory.new.get(w) or memory.missed(w)) == len(w)
        assert len(memory.new) <= 10 and len(memory.old) <= 10


def test_frames(spark):
    rows = [(1, "Hello world", 5), (None, None, 6), (2, "", 7), (1, "Hello world", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted(map(tuple, sentencepiece_codec.round_trip(docs, MODEL).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    assert [g[:3] for g in got if g[0] != 1] == [(2, 0, empty), (None, 0, empty)] and len(got) == 4
    ids = sentencepiece_codec.encode(docs, MODEL)
    assert ids.columns == ["doc_id", "ids"] and ids.filter("size(ids) = 0").count() == 2
    counts = sorted(map(tuple, token_counts.token_counts(docs, JSON, 1).collect()), key=str)
    assert counts == [(1, 11, 2, True, 5), (1, 11, 2, True, 5), (2, 0, 0, False, 0), (None, 0, 0, False, 0)]
    none = docs.limit(0)
    assert token_counts.token_counts(none, JSON, 1).count() == sentencepiece_codec.encode(none, MODEL).count() == 0
