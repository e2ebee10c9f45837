"""Alignment of two tokenizers' tokens by lockstep merging.

Both tokenizers spell the same bytes, so their tokens are two partitions of one byte
range. One state vector holds an A and a B pointer per lane and a step advances all lanes
at once: it emits the link of the two tokens, a cut where both end, and moves on whichever
ends first. Finished lanes are compacted away. A lane is a document; a long one enters as
several lanes, which begin where a token of each side ends, so that a batch takes some
hundred steps however long its texts are.

Links counted over the whole corpus tell how usual a pair of ids is. The documents' links
are written once, as distinct pairs with their number. The counts of the commonest pairs,
a bounded number, are broadcast; rarer pairs meet their counts in a join.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import chunks, whole_text
from payscope.llm.token_counts import PATTERN, byte_letters
from payscope.session import materialize

#: A tokens after which a lane ends at the next shared end, and how far that is looked for.
LANE, LOOK = 512, 64
#: Pairs whose counts are broadcast (16 bytes each), and distinct pairs a task holds.
COMMON_PAIRS = 1 << 20
HELD_PAIRS = 1 << 21
#: A run of white space on which the library's own splitting runs out of stack.
LONG_SPACE = re.compile(r"\s{2000}")


class Pair:
    """The two vocabularies, ``json_path`` byte-level (A) and ``model_path`` pieces (B)."""

    def __init__(self, json_path: str, model_path: str):
        import sentencepiece
        import tiktoken

        with open(json_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        byte = {c: b for b, c in enumerate(byte_letters())}
        spelled = {t: bytes(byte[c] for c in t) for t in vocab if t not in special}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        split = spec.get("pre_tokenizer") or {}
        if merged != sorted(merged) or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
            raise ValueError("not a plain byte-level vocabulary whose ids are in the order of its merges")
        ranks = {raw: vocab[t] for t, raw in spelled.items()}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S"), mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(PATTERN, regex.V0)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.b_bytes = [
            bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
            for i in range(sp.get_piece_size())
        ]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        ids = lambda table: [b"%d" % i for i in range(len(table))]
        self.a_text = np.array([i + s for s in (b",", b"|") for i in ids(self.a_bytes)], object)
        self.b_text = np.array([i + s for s in (b",", b";", b"") for i in ids(self.b_bytes)], object)

    def encode_a(self, text: str) -> list[int]:
        if LONG_SPACE.search(text):
            return [i for word in self.words.findall(text) for i in self.a._encode_single_piece(word)]
        return self.a.encode_ordinary(text)

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of space+text by A and of text by B; None if either spells other bytes."""
        if not text:
            return None
        a = self.encode_a(" " + text)
        b = self.b.encode(text)
        raw = b" " + text.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw or b"".join(map(self.a_bytes.__getitem__, a)) != raw:
            return None
        return a, b


@lru_cache(maxsize=2)
def pair(json_path: str, model_path: str) -> Pair:
    """One per Python worker."""
    return Pair(json_path, model_path)


def lane_starts(a_end: np.ndarray, b_end: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A indices at which lanes begin: ``starts`` of the documents, and within long ones
    the tokens after a shared end."""
    at = np.arange(LANE, len(a_end), LANE)[:, None] + np.arange(LOOK)
    ends = a_end[np.minimum(at, len(a_end) - 1)]
    shared = b_end[np.minimum(np.searchsorted(b_end, ends), len(b_end) - 1)] == ends
    found = shared.any(1)
    inner = at[found, shared[found].argmax(1)] + 1
    return np.unique(np.concatenate([starts, inner[inner < len(a_end)]]))


def lockstep(a_end: np.ndarray, b_end: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links (A index, B index) and cuts (likewise) of tokens that end at the given byte
    offsets, which rise over all documents; ``starts`` are the documents' first A tokens."""
    a = lane_starts(a_end, b_end, starts)
    stop = np.append(a[1:], len(a_end))
    b = np.searchsorted(b_end, np.where(a > 0, a_end[a - 1], 0), side="right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        ea, eb = a_end[a], b_end[b]
        cut = ea == eb
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (ea <= eb), b + (eb <= ea)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(v or none) for v in (links_a, links_b, cuts_a, cuts_b))


def align(own: Pair, texts: list[str]) -> list[list]:
    """Columns per text: n_a, n_b, n_groups, n_links, the groups' digest, and its distinct
    linked pairs (A id times the size of B, plus B id) with how often each is linked."""
    encoded = [own.encode(t) for t in texts]
    live = [i for i, e in enumerate(encoded) if e]
    n = len(texts)
    n_a, n_b, n_groups, n_links = np.zeros((4, n), np.int64)
    digest, keys, times = [""] * n, [[] for _ in range(n)], [[] for _ in range(n)]
    if not live:
        return [n_a, n_b, n_groups, n_links, digest, keys, times]
    size_a, size_b = (np.array([len(encoded[i][s]) for i in live]) for s in (0, 1))
    ids_a, ids_b = (np.concatenate([np.array(encoded[i][s], np.int64) for i in live]) for s in (0, 1))
    del encoded
    first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(own.a_size[ids_a]), np.cumsum(own.b_size[ids_b]), first_a)
    cut_a.sort()
    cut_b.sort()
    ends_a, ends_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    ends_a[cut_a] = ends_b[cut_b] = 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    # A group is written as its A ids, then its B ids.
    place_a = np.arange(len(ids_a)) + np.append(0, cut_b + 1)[group_a]
    place_b = np.arange(len(ids_b)) + cut_a[group_b] + 1
    parts = np.empty(len(ids_a) + len(ids_b), object)
    parts[place_a] = own.a_text[ids_a + len(own.a_bytes) * ends_a]
    ends_b[np.cumsum(size_b) - 1] = 2
    parts[place_b] = own.b_text[ids_b + len(own.b_bytes) * ends_b]
    parts = parts.tolist()

    doc_a = np.repeat(np.arange(len(live)), size_a)
    linked, often = np.unique(doc_a[link_a] << 40 | ids_a[link_a] * len(own.b_bytes) + ids_b[link_b], return_counts=True)
    bound = np.searchsorted(linked >> 40, np.arange(len(live) + 1))
    linked &= (1 << 40) - 1
    n_a[live], n_b[live] = size_a, size_b
    n_groups[live] = np.bincount(doc_a[cut_a], minlength=len(live))
    n_links[live] = np.bincount(doc_a[link_a], minlength=len(live))
    for d, i in enumerate(live):
        s = first_a[d] + first_b[d]
        digest[i] = hashlib.sha256(b"".join(parts[s : s + size_a[d] + size_b[d]])).hexdigest()
        keys[i], times[i] = linked[bound[d] : bound[d + 1]], often[bound[d] : bound[d + 1]]
    return [n_a, n_b, n_groups, n_links, digest, keys, times]


def links(docs: DataFrame, json_path: str, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``row``, the counts, the digest, ``pairs`` and ``times``; written."""
    kind = docs.schema[key].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(json_path, model_path)
        for batch in chunks(batches):
            *numbers, digest, keys, times = align(own, batch.column(2).to_pylist())
            columns = [*(pa.array(v) for v in numbers), pa.array(digest, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], NAMES)

    schema = f"key {kind.simpleString()}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    slim = docs.select(F.col(key), F.monotonically_increasing_id(), whole_text(text))
    return materialize(slim.mapInArrow(run, schema), "links")


NAMES = ["key", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def _flat(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many links hold each pair, and whether no pair of its B id has
    more. Tasks add up before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [], 0
        for batch in batches:
            held.append((_flat(batch.column(0)), _flat(batch.column(1)).astype(np.int64)))
            seen += len(held[-1][0])
            if seen > HELD_PAIRS:
                held = [summed(held)]
                seen = len(held[0][0])
                if seen > HELD_PAIRS // 2:
                    yield pa.record_batch(list(held[0]), ["pair", "n"])
                    held, seen = [], 0
        if held:
            yield pa.record_batch(list(summed(held)), ["pair", "n"])

    counts = linked.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pairs")
    best = counts.groupBy(F.expr(f"pair % {width}").alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", F.expr(f"pair % {width}")).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(v) for v in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def commonest(counts: DataFrame) -> DataFrame:
    """Those pairs whose count's order of magnitude leaves at most ``COMMON_PAIRS``."""
    level = F.floor(F.log2("n"))
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # at most 64 rows
    least, total = 64, 0
    for size in sizes:
        total += size["count"]
        if total > COMMON_PAIRS:
            break
        least = size["level"]
    return counts.filter(level >= least)


def cross_tokenizer(docs: DataFrame, json_path: str, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs`` its key, tokens of either side, groups between shared ends,
    links of overlapping tokens, ``n_best`` of which are to the commonest partner of their
    B id (ties included), the links' corpus-wide counts added up, and a digest of the
    groups. Null and empty texts, and those that a side doesn't spell back, have no tokens:
    zeros and an empty digest. A repeated row counts again; other columns are left out; an
    empty table gives an empty result."""
    spark = docs.sparkSession
    width = len(pair(json_path, model_path).b_bytes)
    linked = links(docs, json_path, model_path, key, text)
    counts = materialize(pair_counts(linked, width), "counts")
    common = commonest(counts).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(common.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for batch in batches:
            own, times = _flat(batch.column(1)), _flat(batch.column(2)).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            hit = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            add = lambda v: np.bincount(doc[hit], v, batch.num_rows)
            # Sums of a document stay below 2^53, where doubles are exact, or are added as integers.
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, doc[hit], times[hit] * n[at[hit]])
            yield pa.record_batch(
                [batch.column(0), pa.array(total), pa.array(add(times[hit] * best[at[hit]]).astype(np.int64)), *rare(doc[~hit], own[~hit], times[~hit], batch.num_rows)],
                ["row", "count_sum", "n_best", "pairs", "times"],
            )

    schema = "row long, count_sum long, n_best long, pairs array<long>, times array<int>"
    told = materialize(linked.select("row", "pairs", "times").mapInArrow(run, schema), "told")
    left = told.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    more = left.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    whole = linked.drop("pairs", "times").join(told.drop("pairs", "times"), "row").join(more, "row", "left")
    return whole.select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def rare(doc: np.ndarray, pairs: np.ndarray, times: np.ndarray, rows: int) -> list[pa.Array]:
    offsets = pa.array(np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))]
