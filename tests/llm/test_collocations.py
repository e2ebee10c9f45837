"""Count automata and phrases against plain counters."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from payscope.llm import collocations as module
from payscope.llm.collocations import collocations
from payscope.llm.count_automata import DEPTH, Automaton, place, summed, union


def sequences(rng, n, labels):
    out = rng.integers(1, labels + 1, (n, DEPTH))
    out[np.arange(DEPTH) >= rng.integers(1, DEPTH + 1, n)[:, None]] = 0
    return out


def as_counts(rows, weights):
    return {tuple(v for v in r if v): int(w) for r, w in zip(rows.tolist(), weights)}


def plain(rows):
    return Counter(tuple(v for v in r if v) for r in rows.tolist())


def prefixes(counts):
    out = Counter()
    for s, n in counts.items():
        for k in range(1, len(s) + 1):
            out[s[:k]] += n
    return out


@pytest.mark.parametrize("labels", [1, 2, 5, 40])
@pytest.mark.parametrize("n", [1, 30, 2000])
def test_automata_hold_sequences_prefixes_unions_and_intersections(n, labels):
    rng = np.random.default_rng(n + labels)
    one, two = sequences(rng, n, labels), sequences(rng, n, labels)
    a, b = (Automaton.of(*summed(r, np.ones(len(r), np.int64))) for r in (one, two))
    assert as_counts(*a.sequences()) == plain(one)
    assert as_counts(*Automaton.unpacked(*a.packed()).sequences()) == plain(one)
    assert as_counts(*a.heavy(3)) == {p: c for p, c in prefixes(plain(one)).items() if c >= 3}
    assert as_counts(*a.compose(b)) == {s: c for s, c in plain(one).items() if s in plain(two)}
    words = [b"%04d" % i for i in range(1, labels + 1)]
    both, whole = union([(words, a), (words[: two.max()], b)])
    assert both == words and as_counts(*whole.sequences()) == plain(one) + plain(two)
    # other words: labels move
    both, whole = union([(words, a), ([b"x" + w for w in words], b)])
    assert len(both) == 2 * labels and sum(as_counts(*whole.sequences()).values()) == 2 * n


def test_equal_states_are_one():
    rows = np.array([[i, 9, 9, 9, 9] for i in range(1, 6)])
    assert [len(f) for f in Automaton.of(rows, np.ones(5, np.int64)).final] == [1] * 6


def test_wide_labels_and_places():
    rng = np.random.default_rng(1)
    rows = sequences(rng, 500, 9)
    rows[rows == 9] = 1 << 30
    held, n = summed(rows, np.ones(len(rows), np.int64))
    assert held.tolist() == sorted(map(list, {tuple(r) for r in rows.tolist()})) and n.sum() == 500
    assert as_counts(*Automaton.of(held, n).sequences()) == plain(rows)
    for bound in ([3, 0, 0, 0, 0], [3, 2, 9, 0, 0], [0] * 5, [1 << 30, 1 << 30, 5, 0, 0]):
        assert place(held, bound) == sum(r < bound for r in held.tolist())


def test_empty_automata():
    none = Automaton.of(np.zeros((0, DEPTH), np.int64), np.zeros(0, np.int64))
    assert len(none.sequences()[0]) == len(none.heavy(1)[0]) == len(none.compose(none)[0]) == 0
    assert union([([], none), ([], none)])[0] == []


def brute(docs, least, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1))
    f = {p: c for p, c in f.items() if c >= least}
    gone = {(p[0], *p[i : i + m]) for p, c in f.items() for m in range(1, len(p) - 1) for i in range(1, len(p) - m + 1) if f[(p[0], *p[i : i + m])] <= c and m < len(p) - 1}
    rows = []
    for p, a in f.items():
        if len(p) < 3 or p in gone:
            continue
        cuts = [(1000 * a * n[p[0]] // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        rows.append((p[0], " ".join(p[1:]), a, f[p[: k + 1]], f[(p[0], *p[k + 1 :])], n[p[0]], score))
    out = []
    for lang in sorted({r[0] for r in rows}):
        best = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i + 1, *r[1:]) for i, r in enumerate(best[:top])]
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    alphabet = ["a", "b", "c", "De", "é", "日", "x\x01", "\x00", "or", "of", "the", "THE"] + [f"w{i}" for i in range(30)]
    space = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c", "?!", "\x85", " "]
    docs = []
    for _ in range(n):
        weights = [1 / (i + 1) for i in range(len(alphabet))]
        docs.append((rng.choice(["en", "fr", None, "und", "e\x01"]), "".join(rng.choices(alphabet, weights)[0] + rng.choice(space) for _ in range(rng.randint(0, 60)))))
    return docs + [("en", None), ("en", ""), (None, " . . "), ("zz", "one two"), ("en", "New York City hall " * 40), ("fr", "a " * 500)]


@pytest.mark.parametrize(("range_words", "shard_words"), [(10**9, 10**9), (200, 300), (37, 50)])
def test_phrases_by_counting(spark, range_words, shard_words):
    docs = corpus(150, range_words)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = collocations(frame, least=6, top=40, range_words=range_words, shard_words=shard_words).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, 6, 40)) and len(got) > 50


def test_scores_beyond_64_bits_are_exact(spark):
    """1000 * a * n as such fits a long here, so the division itself is tested apart."""
    a, n, l = 10**12 + 7, 10**15 + 9, 10**13 + 3
    row = spark.createDataFrame([(a, n, l)], "a long, n long, l long").selectExpr(
        "(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * 1000) div (cast(l as decimal(19,0)) * cast(a as decimal(19,0))) AS s"
    )
    assert row.first().s == 1000 * a * n // (l * a)


def test_clashing_columns_and_empty_tables(spark):
    schema = "range int, lang string, part string, f long, text string, n long, phrase string"
    assert collocations(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "en", "p", 1, "good day sir", 2, "q")] * 100
    got = [tuple(r) for r in collocations(spark.createDataFrame(rows, schema)).collect()]
    assert got == brute([("en", "good day sir")] * 100, 100, 2000) and len(got) == 1
    assert collocations(spark.createDataFrame(rows[:99], schema)).collect() == []


@pytest.mark.parametrize("least", [3, 300])
def test_windows_end_between_rare_pairs(spark, least):
    texts = ["a b c d e" for _ in range(least)] + ["c a", "b e, d a b"] * (least // 3)
    frame = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(4)
    bits = np.full(module.COMMON_BITS // 8, 255, np.uint8)
    pairs = module.common_pairs(frame, spark.sparkContext.broadcast(bits), 1, least)
    shard = module.Shard("en", bits, pairs)
    shard.add(["a b c d e c a b e"])
    own, rows, n = shard.sorted_windows()
    got = Counter({" ".join(own[i - 1].decode() for i in row if i): int(k) for row, k in zip(rows.tolist(), n.tolist())})
    assert got == Counter(["a b c d e", "b c d e", "c d e", "d e", "e", "c", "a b", "b", "e"])
