"""SimHash near-deduplication with BK-trees.

Each text gets a 64-bit fingerprint of its word shingles; equal fingerprints are one node
from then on. Two fingerprints that differ in at most r bits agree on at least b - r of b
blocks of bits, so nodes are dealt to shards by every choice of b - r blocks, and each
shard holds a BK-tree: children hang on a node by their Hamming distance to it, and a
search follows only edges within the radius of the query's own distance. A tree goes to
the tasks that hold its shard's queries. It holds a bounded number of nodes; a larger
shard becomes several trees, and each meets each block of the shard's queries, so
no link is lost however many texts share a block. Trees and queries of a task's many
shards are walked level by level in numpy. A shard hands on a spanning forest of its
links, not all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import fresh, map_chunks, numbered, whole_text, without_rows
from payscope.llm.components import components
from payscope.session import materialize

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Blocks of bits. More blocks make smaller shards and more copies: 4 suit some 10^8
#: different texts, 6 (20 copies, 32 agreeing bits) some 10^11.
BLOCKS = 4
#: Nodes of one tree, and pairs that a task looks at together.
TREE, PAIRS = 4096, 2_000_000
_TEXT_BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def shingle_hashes(raw: bytes, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of the word k-grams of a text in blocks; ``bytes`` methods know only the
    ASCII letters and spaces."""
    raw, start, held, total = raw.lower(), 0, [], 0
    digest = xxhash.xxh64_intdigest
    while start < len(raw):
        end = start + _TEXT_BLOCK
        cut = _SPACE.search(raw, end) if end < len(raw) else None
        end = cut.end() if cut else len(raw)
        words = held + raw[start:end].split()
        total += len(words) - len(held)
        if len(words) >= k:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.concatenate(([0], ends[:-1] + 1))
            pairs = zip(begins[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
            yield np.array([digest(line[a:b], SEED) for a, b in pairs], np.uint64)
        held, start = words[-(k - 1) :] if k > 1 else [], end
    if 0 < total < k:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def fingerprint(raw: bytes, k: int = SHINGLE) -> int:
    """Bit i is set where over half of the hashes have it; zero without words."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(raw, k):
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].astype("<u8")
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0]) if n else 0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, number: str | None = None) -> DataFrame:
    """(key, row, fp): the fingerprint of each row's text as a signed long."""
    kind = docs.schema[key].dataType

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([fingerprint(t.encode(), k) for t in batch.column(2).to_pylist()], pa.int64())
        return pa.record_batch([batch.column(0), batch.column(1), found], ["id", "row", "fp"])

    row = F.col(number) if number else F.monotonically_increasing_id()
    slim = docs.select(F.col(key).alias("id"), row.alias("row"), whole_text(text))
    return map_chunks(slim, work, f"id {kind.simpleString()}, row long, fp long")


def bands(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """A mask of bits, as a signed long, for each choice of blocks that have to agree."""
    if not radius < blocks <= 64:
        raise ValueError("there have to be more blocks of bits than bits may differ")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class Forest:
    """BK-trees over shards: ``group`` numbers the shard of each node, in order."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.fp = fp
        n = len(fp)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
        self.root = dict(zip(group[first].tolist(), first.tolist()))
        left = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = first[np.searchsorted(group[first], group[left])]
        edges, children = [], []
        while len(left):
            key = at * 65 + np.bitwise_count(fp[left] ^ fp[at])
            order = np.argsort(key, kind="stable")
            left, key = left[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]
            edges.append(key[new])
            children.append(left[new])
            at = left[new][np.cumsum(new) - 1][~new]
            left = left[~new]
        key = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.edge = key[order]
        self.child = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def near(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (position among the queries, node) within the radius, level by level."""
        q, node = np.arange(len(queries)), roots
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right")
            width = hi - lo
            q = np.repeat(q, width)
            inside = np.arange(len(q)) - np.repeat(np.cumsum(width) - width, width)
            node = self.child[np.repeat(lo, width) + inside]


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of each pair; ``label`` points to a smaller member or itself."""
    while True:
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def shard_links(group: np.ndarray, role: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in each shard. Roles: 0 node and query, 1 node only,
    2 query only; rows are ordered by shard."""
    nodes = np.flatnonzero(role != 2)
    asks = np.flatnonzero(role != 1)
    forest = Forest(group[nodes], fp[nodes])
    root = np.array([forest.root.get(g, -1) for g in group[asks].tolist()], np.int64)
    asks, root = asks[root >= 0], root[root >= 0]
    sizes = np.bincount(group[nodes], minlength=int(group.max()) + 1 if len(group) else 0)
    cost = np.cumsum(sizes[group[asks]]) if len(asks) else np.zeros(0, np.int64)
    label = np.arange(len(fp))
    start = 0
    while start < len(asks):
        stop = max(start + 1, int(np.searchsorted(cost, (cost[start - 1] if start else 0) + PAIRS, "right")))
        part = asks[start:stop]
        for q, node in forest.near(fp[part], root[start:stop], radius):
            _unite(label, part[q], nodes[node])
        start = stop
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return linked, label[linked]


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree: int = TREE) -> DataFrame:
    """``nodes`` (fp, distinct) to edges (a, b) that connect all fingerprints which
    differ in at most ``radius`` bits, directly or through others."""
    masks = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in bands(blocks, radius)])
    dealt = nodes.select("fp", F.posexplode(masks).alias("band", "bits"))
    sizes = dealt.groupBy("band", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    own, parts = F.col("own"), F.col("parts")
    shared = (
        dealt.join(sizes, ["band", "bits"])
        .withColumn("parts", F.ceil(F.col("n") / tree).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
    )
    # Tree i meets query block j for i <= j; a row is node and query where they are one.
    seq = F.sequence(F.lit(0), parts - 1)
    places = F.transform(
        seq,
        lambda k: F.struct(
            F.least(k, own).alias("tree"),
            F.greatest(k, own).alias("block"),
            F.when(k == own, 0).when(k > own, 1).otherwise(2).alias("role"),
        ),
    )
    keys = ["band", "bits", "tree", "block"]
    rows = shared.select("fp", "band", "bits", F.inline(places)).select(*keys, "role", "fp")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            new = np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0)
            group = np.r_[0, np.cumsum(new)] if len(columns[0]) else np.zeros(0, np.int64)
            fp = columns[5].astype(np.int64).view(np.uint64)
            a, b = shard_links(group, columns[4], fp, radius)
            return pa.record_batch([pa.array(columns[5][a]), pa.array(columns[5][b])], ["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = new if held is None else [np.concatenate(p) for p in zip(held, new)]
            if len(held[0]) >= 1 << 16:
                change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in held[:4]], axis=0))
                if len(change):  # the last shard may go on in the next batch
                    cut = change[-1] + 1
                    yield found([c[:cut] for c in held])
                    held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield found(held)

    return rows.mapInArrow(work, "a long, b long")


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, tree: int = TREE,
    number: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: key, ``row``, ``fp``, ``component_id`` (the smallest key
    in its component, null only if all are) and ``kept`` (one row of each component).

    Null texts are empty ones; texts without words have the fingerprint zero and link
    like any other. Repeated rows share a component and one of them is kept. An empty
    table gives an empty result; other columns are left out. ``row`` is the column
    ``number``; without one rows are numbered here, and a later scan of ``docs`` need not
    number them alike.
    """
    rows = materialize(fingerprints(docs, key, text, k, number), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    nodes = materialize(rows.groupBy("fp").agg(F.min(order).alias("best")), "nodes")
    roots = components(links(nodes.select("fp"), radius, blocks, tree))
    tied = materialize(roots.select(F.col("node").alias("fp"), "root"), "roots")
    best = tied.join(nodes, "fp").groupBy("root").agg(F.min("best").alias("best"))
    classes = (
        nodes.join(tied.join(best, "root").select("fp", F.col("best").alias("of")), "fp", "left")
        .select("fp", F.coalesce("of", "best").alias("of"))
    )
    # Written, so that a fingerprint that very many rows share is split over tasks.
    found = rows.join(materialize(classes, "classes"), "fp")
    return found.select(F.col("id").alias(key), "row", "fp", F.col("of.id").alias("component_id"), (F.col("of.row") == F.col("row")).alias("kept"))


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were."""
    row = fresh(docs, "_row")
    docs = numbered(docs, row)
    found = simhash_groups(docs, key, text, number=row, **more)
    return without_rows(docs, materialize(found.filter(~F.col("kept")).select("row"), "dropped"), row)
