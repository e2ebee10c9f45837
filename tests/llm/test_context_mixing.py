"""Scores against a bit-by-bit computation in plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from payscope.llm import context_mixing
from payscope.llm.context_mixing import Code, lm_scores
from payscope.llm.queries import QUERIES

MASK = (1 << 32) - 1


def plain_tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def plain_base(docs):
    """n_tokens, n_known, train_tokens and base score of each row."""
    c = Counter()
    for i, t in docs:
        if not held_out(i):
            c.update([*plain_tokens(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for _, t in docs:
        tokens = [*plain_tokens(t), None]
        out.append((len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


class PlainModel:
    """The same model, one bit after the other, in dictionaries."""

    def __init__(self, texts, most):
        c = Counter(w for t in texts for w in plain_tokens(t))
        level = lambda n: math.floor(math.log2(n) * 4)
        sizes = Counter(map(level, c.values()))
        sizes[level(len(texts))] += 1  # the end sign is counted with the words
        least, total = 256, 0
        for size in sorted(sizes, reverse=True):
            total += sizes[size]
            if total > most:
                break
            least = size
        words = sorted(w.encode() for w, n in c.items() if level(n) >= least)
        rare = {w: n for w, n in c.items() if w.encode() not in words}
        counts = np.zeros(256, np.int64)
        for w, n in rare.items():
            for v in w.encode():
                counts[v] += n
        counts[32] += sum(rare.values())
        self.code = Code(counts, words, [c[w.decode()] for w in words], sum(rare.values()), len(texts))
        self.seen = [Counter(), Counter(), Counter()]
        for t in texts:
            for bit, keys in self.bits(t):
                for table, key in zip(self.seen, keys):
                    table[key, bit] += 1

    def symbols(self, text):
        """Each symbol with its contexts."""
        one = two = 0
        for w in [*(w.encode() for w in plain_tokens(text)), b""]:
            number = self.code.number.get(w, 256)
            yield number, [0, one, (one * 0x2545F491 + two) & MASK]
            if number == 256:
                so_far = b""
                for v in w + b" ":
                    before = (b"\n" * 4 + so_far)[-4:]
                    yield v, [
                        sum(before[-1 - k] << 8 * k for k in range(3)),
                        sum(before[-1 - k] << 8 * k for k in range(4)),
                        sum(u * pow(0x01000193, j, 1 << 32) for j, u in enumerate(so_far)),
                    ]
                    so_far += bytes([v])
            one, two = number, one

    def bits(self, text):
        for symbol, contexts in self.symbols(text):
            contexts = [c * m & MASK for c, m in zip(contexts, (0xC2B2AE35, 0x27D4EB2F, 0x165667B1))]
            contexts = [c ^ c >> 15 for c in contexts]
            for s in range(self.code.start[symbol], self.code.start[symbol] + self.code.length[symbol]):
                yield int(self.code.bit[s]), [((c ^ int(self.code.node[s])) * 0x2C1B3C6D & MASK) >> 32 - bits for c, bits in zip(contexts, context_mixing.TABLE_BITS)]

    def odds(self, table, key):
        one, zero = table[key, 1], table[key, 0]
        if not one + zero:
            return 0
        raw = math.log((one + 0.4) / (zero + 0.4)) * context_mixing.SCALE
        return math.copysign(min(max(math.ceil(abs(raw)), 1), 127), raw)

    def score(self, text):
        total = 0.0
        for n, (bit, keys) in enumerate(self.bits(text)):
            if n % context_mixing.SEGMENT == 0:
                weights = [[context_mixing.WEIGHT / context_mixing.SCALE] * 4 for _ in range(3)]
            x = [*(self.odds(t, k) for t, k in zip(self.seen, keys)), context_mixing.SCALE]
            w = weights[(x[1] != 0) + (x[2] != 0)]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            error = bit - p
            total += math.log10(context_mixing.LEAST + (1 - 2 * context_mixing.LEAST) * (1 - abs(error)))
            for k in range(4):
                w[k] += error * context_mixing.RATE / context_mixing.SCALE * x[k]
        return total


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "and", "é", "日本", "data", "x\x01", "\x1c", "engine", "spark", "don't"] + [f"w{i}" for i in range(40)]
    docs = [(i, rng.choice([" ", "\t", " \n"]).join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 60)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, " \x0b\x0c"), (n + 3, "same"), (n + 3, "same"), (None, "no key")]


def run(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return sorted(lm_scores(frame).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.score))


@pytest.mark.parametrize("coded", [1 << 16, 12, 0])
def test_scores_bit_by_bit(spark, monkeypatch, coded):
    """With all words coded, some, and none."""
    monkeypatch.setattr(context_mixing, "CODED_WORDS", coded)
    docs = corpus(120, 2)
    got = run(spark, docs)
    model = PlainModel([t for i, t in docs if not held_out(i)], coded)
    want = sorted(((i, held_out(i), *b, model.score(t)) for (i, t), b in zip(docs, plain_base(docs))), key=lambda r: (r[0] is None, r[0] or 0, r[-1]))
    assert len(got) == len(want) and any(r[1] for r in want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert g.score == pytest.approx(w[6], rel=1e-4)


def test_rare_words_are_joined(spark, monkeypatch):
    docs = corpus(60, 4)
    whole = run(spark, docs)
    monkeypatch.setattr(context_mixing, "COMMON_WORDS", 5)
    for a, b in zip(whole, run(spark, docs)):
        assert tuple(a)[:5] == tuple(b)[:5] and a.base_score == pytest.approx(b.base_score, rel=1e-12)


def test_held_out_texts_teach_nothing(spark):
    docs = corpus(60, 5)
    other = [(i, "quite another text " * 30 if held_out(i) else t) for i, t in docs]
    keep = lambda rows: [tuple(r) for r in rows if not r.held_out]
    assert [r[4:] for r in keep(run(spark, docs))] == [r[4:] for r in keep(run(spark, other))]


def test_long_texts_go_in_parts_and_segments(monkeypatch):
    monkeypatch.setattr(context_mixing, "PART", 100)
    words = context_mixing.spoken("some words again and again " * 200)
    said = context_mixing.parts(words)
    assert [w for p in said for w in p] == [*words, b""] and max(map(len, said)) == 100
    # segments are mixed as if each were alone
    rng = np.random.default_rng(1)
    x, bit = rng.integers(-127, 128, (50_000, 4)).astype(np.int8), rng.integers(0, 2, 50_000).astype(np.int8)
    segment = context_mixing.SEGMENT
    whole = context_mixing.mix(x, bit, np.array([30_000, 0, 1, 19_999]))
    alone = [context_mixing.mix(x[a:z], bit[a:z], np.array([z - a])).sum() for s, e in ((0, 30_000), (30_001, 50_000)) for a in range(s, e, segment) for z in [min(a + segment, e)]]
    cut = (30_000 + segment - 1) // segment
    assert whole[[0, 3]] == pytest.approx([sum(alone[:cut]), sum(alone[cut:])], rel=1e-5) and whole[1] == 0 > whole[2]


def test_words_of_many_texts_at_once(monkeypatch):
    monkeypatch.setattr(context_mixing, "PART", 7)
    texts = [t or "" for _, t in corpus(80, 6)] + ["a\x0bB\x0cÄ\u00a0x\x85 \x1c ", " ", "one", "x" * 50 + " y" * 30]
    said = context_mixing.Said(pa.array(["before", *texts]).slice(1))
    words = [context_mixing.spoken(t) for t in texts]
    assert said.words.to_pylist() == [w for own in words for w in own]
    assert said.size.tolist() == [len(own) for own in words]
    assert said.bytes.tolist() == [sum(map(len, own)) + len(own) + 1 for own in words]
    owner, size = said.parts()
    assert [*zip(owner.tolist(), size.tolist())] == [(i, len(p)) for i, own in enumerate(words) for p in context_mixing.parts(own)]
    groups = [own for _, own in said.groups(100)]
    assert len(groups) > 5 and [w for own in groups for w in own.words.to_pylist()] == said.words.to_pylist()
    assert [n for own in groups for n in np.bincount(own.text, minlength=len(own.size)).tolist()] == said.size.tolist()


def test_counts_by_place_however_they_wait(monkeypatch):
    monkeypatch.setattr(context_mixing, "WAITING", 1000)
    rng = np.random.default_rng(4)
    tally, want = context_mixing.Tally(512), np.zeros(512, np.int64)
    for _ in range(20):
        places = rng.integers(0, 512, 300).astype(np.uint32)
        times = rng.integers(1, 9, 300).astype(np.uint32)
        tally.add(places)
        tally.add(places, times)
        want += np.bincount(places, times + 1, 512).astype(np.int64)
    tally.settle()
    assert (tally.counts == want).all()


def test_often_said_words_come_in_pieces(monkeypatch):
    """So that no task counts more than 32 bits hold, and none is lost."""
    monkeypatch.setattr(context_mixing, "COUNTED", 1000)
    words, times = [b"a", b"bcd", b"e" * 3000, b"f"], np.array([10_001, 1, 3, 499])
    got, most = Counter(), 0
    for some, n in context_mixing.pieces(pa.array(words, pa.binary()), times):
        for w, k in zip(some.to_pylist(), n.tolist()):
            got[w] += k
            assert k * (len(w) + 1) <= 1000 or k == 1
        most = max(most, sum(k * (len(w) + 1) for w, k in zip(some.to_pylist(), n.tolist()) if len(w) < 1000))
    assert got == dict(zip(words, times.tolist())) and most <= 2000
    assert [*context_mixing.pieces(pa.array([], pa.binary()), np.zeros(0, np.int64))] == []


def test_each_gate_refines_its_own_weights():
    """Lanes by gate against one bit after the other."""
    rng = np.random.default_rng(7)
    n = 3 * context_mixing.SEGMENT // 2
    x, bit = rng.integers(-60, 61, (n, 4)).astype(np.int8), rng.integers(0, 2, n).astype(np.int8)
    x[:, 1:3] *= rng.integers(0, 2, (n, 2)).astype(np.int8)
    x[:, 3] = context_mixing.SCALE
    want = 0.0
    for i in range(n):
        if i % context_mixing.SEGMENT == 0:
            w = np.full((3, 4), context_mixing.WEIGHT / context_mixing.SCALE)
        g, v = int(x[i, 1] != 0) + int(x[i, 2] != 0), x[i].astype(float)
        error = bit[i] - 1 / (1 + math.exp(-(w[g] @ v)))
        want += math.log(context_mixing.LEAST + (1 - 2 * context_mixing.LEAST) * (1 - abs(error)))
        w[g] += error * context_mixing.RATE / context_mixing.SCALE * v
    assert context_mixing.mix(x.copy(), bit, np.array([n])) == pytest.approx([want], rel=1e-5)


def test_codes_are_prefix_free_and_short():
    counts = [max(1, 10**9 >> (b // 2)) for b in range(256)]
    code = Code(np.array(counts), [b"w%d" % i for i in range(300)], [10**6 // (i + 1) for i in range(300)], 5, 7)
    for symbols in (range(256), range(256, 258 + 300)):
        assert sum(2.0 ** -int(code.length[s]) for s in symbols) == 1.0
        spelled = {"".join(map(str, code.bit[code.start[s] : code.start[s] + code.length[s]])) for s in symbols}
        assert len(spelled) == len(symbols)
    assert (np.diff(code.length[:40]) >= 0).all() and (np.diff(code.length[258:]) >= 0).all()
    nodes = [set(code.node[code.start[a] : code.start[z - 1] + code.length[z - 1]]) for a, z in ((0, 256), (256, 558))]
    assert not nodes[0] & nodes[1]


def test_blocks_of_counts_read_back():
    rng = np.random.default_rng(3)
    for top, share in ((3, 0.01), (250, 0.9), (60_000, 0.9), (1 << 31, 0.2), (1, 0.0)):
        counts = (rng.integers(1, top + 1, 2 * context_mixing.BLOCK) * (rng.random(2 * context_mixing.BLOCK) < share)).astype(np.uint32)
        body, width, sparse = context_mixing._block(counts)
        back = np.zeros(len(counts), np.int64)
        if sparse:
            n = len(body) // (2 + width)
            back[np.frombuffer(body, "<u2", n)] = np.frombuffer(body, f"<u{width}", n, 2 * n)
        else:
            back[:] = np.frombuffer(body, f"<u{width}")
        assert (back == counts).all()


def test_empty_tables_and_nothing_to_learn_from(spark):
    schema = "word string, doc_id long, c long, text string, row long"
    assert lm_scores(spark.createDataFrame([], schema)).collect() == []
    only = [i for i in range(40) if held_out(i)]
    rows = lm_scores(spark.createDataFrame([("w", i, 1, "some text", 2) for i in only], schema)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(3, 0, 0, 0.0)] * len(only)
    assert all(r.score < 0 for r in rows)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op12_lm_scores"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for (i, _), want in zip(docs, plain_base(docs)):
        assert tuple(got[i])[1:5] == (held_out(i), *want[:3]) and got[i].base_score == pytest.approx(want[3], rel=1e-9)
        assert got[i].score < 0
