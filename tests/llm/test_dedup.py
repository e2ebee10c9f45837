"""Exact, near and suffix deduplication against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from payscope.llm import exact_dedup, simhash, suffix_dedup
from payscope.llm.components import components
from pyspark.sql import functions as F


def stored(spark, tmp_path, rows, schema, parts=4):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(str(tmp_path / "in"))
    return spark.read.parquet(str(tmp_path / "in"))


def numbered(df):
    return {r._row: r for r in df.withColumn("_row", F.monotonically_increasing_id()).collect()}


def test_exact(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "a", "A", "b" * 400, "b" * 399 + "c", "é" * 256 + "1", "é" * 256 + "2", "long " * 5000]
    rows = [(rng.choice([i, i, 5, None]), rng.choice(texts), i) for i in range(200)]
    docs = stored(spark, tmp_path, rows, "doc_id long, text string, kept int")
    lines = numbered(docs)
    groups = {}
    for n, r in lines.items():
        groups.setdefault(r.text or "", []).append((r.doc_id is not None, r.doc_id or 0, n))
    got = {r.row: r for r in exact_dedup.exact_groups(docs, digests=True).collect()}
    assert set(got) == set(lines)
    for text, members in groups.items():
        best = max(members)
        for *_, n in members:
            r = got[n]
            assert r.group_size == len(members) and r.keep_id == (best[1] if best[0] else None)
            assert r.kept == (n == best[2]) and r.digest == hashlib.sha256(text.encode()).digest()
    left = exact_dedup.exact_dedup(docs)
    assert left.schema == docs.schema and left.count() == len(groups)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "a", "a b", "A b C d", "x\x0by\x1cz w v", "Ünï cödé Ä ä", "w " * 3000, "İ I ı i k K"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def test_fingerprint_of_text_in_blocks(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abc", k=3)) for _ in range(400))
    monkeypatch.setattr(simhash, "_TEXT_BLOCK", 37)
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def near_brute(keys, prints, radius=3):
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(keys)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


@pytest.mark.parametrize("tree", [4096, 3])
def test_links_and_components(spark, tree):
    rng = random.Random(7)
    prints = {0}
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):  # chains and clusters
            prints.add(f)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(nodes, tree=tree)).collect()}
    want = near_brute(prints, prints)
    got = [roots.get(s, s) for s in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_band_layouts_lose_nothing():
    rng = random.Random(9)
    for blocks in (4, 5, 6):
        masks = simhash.bands(blocks)
        for _ in range(300):
            flips = rng.sample(range(64), 3)
            d = sum(1 << b for b in flips)
            assert any(d & m & (1 << 64) - 1 == 0 for m in masks)
    with pytest.raises(ValueError):
        simhash.bands(3)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_simhash_rows(spark, tmp_path):
    base = "one two three four five six seven eight nine ten " * 8
    texts = [base, base, base.upper(), base + "eleven", None, "", "  \n", "alone in the world", "alone in the world"]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)]
    docs = stored(spark, tmp_path, rows, "doc_id long, text string, fp string")
    found = {r.row: r for r in simhash.simhash_groups(docs).collect()}
    lines = numbered(docs)
    ids = list(lines)
    prints = [plain_fingerprint(lines[i].text) for i in ids]
    roots = near_brute(ids, prints)
    for i, f, root in zip(ids, prints, roots):
        assert found[i].fp & (1 << 64) - 1 == f
        members = [lines[n].doc_id for n, r in zip(ids, roots) if r == root]
        assert found[i].component_id == min((m for m in members if m is not None), default=None)
    left = simhash.simhash_dedup(docs)
    assert left.schema == docs.schema and left.count() == len(set(roots))
    assert simhash.simhash_dedup(docs.limit(0)).count() == 0


def suffix_brute(rows, length=100):
    seen, out = set(), []
    for key, text in rows:
        raw, end, kept, n = (text or "").encode(), 0, [], 0
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                if s > end or not n:
                    n += 1
                    kept.append(raw[end:s])
                end = s + length
            else:
                seen.add(raw[s : s + length])
        kept.append(raw[end:])
        rest = b"".join(kept)
        out.append((key, len(raw), len(raw) - len(rest), n, hashlib.sha256(rest).hexdigest(), rest))
    return out


@pytest.mark.parametrize("split", [16384, 20])
def test_suffixes(spark, tmp_path, monkeypatch, split):
    rng = random.Random(split)
    base = ["".join(rng.choices("abcdé ", k=rng.randint(50, 700))) for _ in range(10)]
    shared = "".join(rng.choices("xyz ", k=160))
    rows = []
    for i in range(240):
        t = rng.choice(base)[rng.randint(0, 200) :] + rng.choice(["", shared, "a" * 150, "ab" * 120, base[0][:150]]) + "".join(rng.choices("abé ", k=rng.randint(0, 60)))
        rows.append((rng.choice([i, i, 7, None]), rng.choice([t, t, t, t[:120] + "Q" + t[121:], None, ""]), "x"))
    docs = stored(spark, tmp_path, rows, "doc_id long, text string, row string")
    whole = suffix_dedup.removed_starts
    monkeypatch.setattr(suffix_dedup, "removed_starts", lambda d: whole(d, split))
    lines = numbered(docs)
    order = sorted(lines, key=lambda n: (lines[n].doc_id is not None, lines[n].doc_id or 0, n))
    want = sorted(map(str, suffix_brute([(lines[n].doc_id, lines[n].text) for n in order])))
    got = sorted(str((*r[:5], bytes(r[5]))) for r in suffix_dedup.suffix_dedup(docs, keep=True).collect())
    assert got == want
    assert suffix_dedup.suffix_dedup(docs.limit(0)).count() == 0


def test_long_text_in_parts():
    """A start has the same window wherever the text is cut, but at the cut itself."""
    rng = np.random.default_rng(0)
    line = rng.integers(97, 100, 5000).astype(np.uint8)
    seed, _, _, first, n = suffix_dedup.windows(line, np.array([5000]))
    whole = {s: v for v, f, m in zip(seed, first, n) for s in range(f, f + m)}
    assert sorted(whole) == list(range(4901))
    for a in (0, 1000, 2500):
        part = line[a : a + 1000 + 99]
        seed, _, _, first, n = suffix_dedup.windows(part, np.array([len(part)]))
        assert {s + a: v for v, f, m in zip(seed, first, n) for s in range(f, f + m)} == {s: whole[s] for s in range(a, a + 1000)}


def test_windows_are_asked_for_one_by_one(spark, tmp_path, monkeypatch):
    """By row and place, so that a larger corpus sends no others; a seed that one chunk has
    with several texts doesn't bring all copies of a third text from other chunks."""
    rng = random.Random(5)
    part = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage, other = part(300), part(200)
    texts = [part(200) + passage + part(200) + passage + part(200)] + [part(150) + passage + other] * 5 + [part(400)]
    by_seed, want = {}, []
    for i, text in enumerate(texts):
        seed, window, _, first, _ = suffix_dedup.windows(np.frombuffer(text.encode(), np.uint8), np.array([len(text)]))
        for s, w, at in zip(seed.tolist(), window.tolist(), first.tolist()):
            by_seed.setdefault(s, {}).setdefault(w, (i, at))  # the first of each text
    for of_text in by_seed.values():
        want += of_text.values() if len(of_text) > 1 else []
    merged, sent = suffix_dedup._merged, str(tmp_path / "sent")

    def watched(batch):
        with open(sent, "a") as file:
            file.writelines(f"{row} {at}\n" for row, at in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()))
        return merged(batch)

    monkeypatch.setattr(suffix_dedup, "_merged", watched)
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, row long, text string").repartitionByRange(7, "id")
    suffix_dedup.removed_starts(docs).collect()
    with open(sent) as file:
        assert sorted(tuple(map(int, line.split())) for line in file) == sorted(want) and len(want) > 4


def test_windows_with_little_in_common_are_not_merged(monkeypatch):
    """Texts that share a seed and no string add nothing to the transforms."""
    rng, merged = random.Random(6), []
    merge = suffix_dedup.merge
    monkeypatch.setattr(suffix_dedup, "merge", lambda shards, ends: merged.append(sum(map(len, shards))) or merge(shards, ends))
    part = lambda n: bytes(rng.choices(range(97, 123), k=n))
    seed, shared = part(32), part(100)
    texts = [part(60) + seed + part(60) for _ in range(40)]
    owner, inside, block, _ = suffix_dedup.repeated(texts, np.full(40, 53))
    assert len(owner) == len(set(block.tolist())) == 40 * 53 and merged == [0]
    texts[3:5] = [part(20) + shared + part(32), part(30) + shared + part(22)]
    owner, inside, block, _ = suffix_dedup.repeated(texts, np.full(40, 53))
    again = np.flatnonzero(np.bincount(block)[block] > 1)
    assert sorted(zip(owner[again].tolist(), inside[again].tolist())) == [(3, 20), (4, 30)]
    assert len(set(block.tolist())) == 40 * 53 - 1 and merged[1] == 12


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz"])
def test_merged_transforms_are_the_order_of_all(letters):
    """Also where the signs of all shards are more than one shard has suffixes."""
    rng = random.Random(3)
    texts = ["".join(rng.choices(letters, k=rng.randint(100, 140))).encode() for _ in range(30)]
    texts += [t[:110] + b"zzz" for t in texts[:10]] + texts[:5]
    starts = np.array([len(t) - 99 for t in texts])
    for shards in (1, 2, 5):
        owner, inside, block, hashes = suffix_dedup.repeated(texts, starts, shards)
        strings = [texts[o][i : i + 100] for o, i in zip(owner, inside)]
        assert len(strings) == starts.sum()
        assert len(set(zip(strings, block))) == len(set(strings)) == len(set(block.tolist()))
        assert len(set(hashes.tolist())) == len(set(strings))
