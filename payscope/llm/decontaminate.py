"""Benchmark decontamination: rare n-gram seeds, a join, then Smith-Waterman alignment.

A seed is two words with at most one word between them. How many documents have each seed
of the items is counted first; an item is then known by its rarest seeds, as many as it
takes to lose no copy (see ``_quota``). The documents' passages that have enough of the
rare seeds are joined with the items on them, and aligned with the items that share enough:
edits, insertions and gaps lower the score but don't hide the copy.

Two scans of the documents do for any number of items. All that is broadcast for them is a
bitmap of a fixed size; texts stay where they are but for the passages found.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payscope.llm.common import chunks, fresh, whole_text, without_rows
from payscope.session import materialize

#: Words from which edited copies of an item count and not only full ones, the least score
#: of an edited copy, words searched at once, characters split into words at once and their bytes at most.
LEAST_WORDS, THRESHOLD, PIECE, PIECE_CHARS, PIECE_BYTES = 8, 0.5, 1 << 18, 1 << 18, 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the bitmap that tells the items' seeds (8 MiB), and bits in a row of it.
SEED_BITS, ROW_BITS = 1 << 26, 32768
#: Base of the words' codes, an odd number.
BASE = 0xD6E8FEB86659FD93
_WORD, _BREAK = re.compile(r"\w+"), re.compile(r"\W")
_VALUES = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_VALUES ^= _VALUES >> np.uint64(32)
_IN_WORD = np.array([n > 127 or bool(_WORD.match(chr(n))) for n in range(256)], np.int8)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """The best local alignment's score as a share of the item's own, and where in the
    passage it ends (exclusive). Words are numbers."""
    best, end = 0, 0
    steps = -GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for w in item:
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == w, MATCH, MISMATCH), out=new[1:])
        # Gaps along the passage: the best of all earlier cells less their distance.
        row = np.maximum.accumulate(new + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best / (MATCH * len(item)), end


def best_place(item: np.ndarray, passage: np.ndarray, least: float) -> tuple[float, int, int] | None:
    """(score, first word, end word) of the best alignment, if it reaches ``least``."""
    # Order aside, a passage can't score more than its words of the item allow.
    sums = np.cumsum(np.where(np.isin(passage, item), MATCH, MISMATCH))
    if (sums - np.minimum.accumulate(np.r_[0, sums[:-1]])).max(initial=0) < MATCH * len(item) * least - 1e-9:
        return None
    share, end = align(item, passage)
    if share < least:
        return None
    return share, end - align(item[::-1], passage[:end][::-1])[1], end


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The base's powers modulo 2^64 and their inverses, up to ``PIECE_BYTES``."""
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(PIECE_BYTES, p, np.uint64)]) for p in (BASE, pow(BASE, -1, 1 << 64)))


def _sums(raw: bytes) -> np.ndarray:
    """What each prefix of the bytes comes to as a polynomial in the base."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[np.frombuffer(raw, np.uint8)] * _powers()[0][: len(raw)], out=sums[1:])
    return sums


def _long_word(raw: bytes) -> int:
    """The polynomial of a word of any length, by pieces."""
    code = 0
    for a in range(0, len(raw), PIECE_BYTES):
        code += int(_sums(raw[a : a + PIECE_BYTES])[-1]) * pow(BASE, a, 1 << 64)
    return code % (1 << 64)


def _piece_codes(piece: str) -> np.ndarray:
    """The codes of the words of a piece in lower case: polynomials of their bytes, each
    the difference of two sums over the piece."""
    # Beyond ASCII words are told by the pattern; then a line break is all between them.
    raw = piece.encode() if piece.isascii() else "\n".join(_WORD.findall(piece)).encode()
    if len(raw) > PIECE_BYTES:
        return np.array([_long_word(w.encode()) for w in _WORD.findall(piece)], np.uint64)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IN_WORD[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends, sums = edges[::2], edges[1::2], _sums(raw)
    return (sums[ends] - sums[starts]) * _powers()[1][starts]


def coded(text: str) -> np.ndarray:
    """64-bit codes of the words; a long text is split at characters that are in no word."""
    text, at, parts = text.lower(), 0, []
    while at < len(text):
        cut = _BREAK.search(text, at + PIECE_CHARS)
        end = cut.start() if cut else len(text)
        parts.append(_piece_codes(text[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _seed(a: np.ndarray, z: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (z ^ (z >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _slot(seed: np.ndarray, width: int = 0) -> np.ndarray:
    """The bit of a seed, or of a seed that items of a width have."""
    return ((seed + np.uint64(width)) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(32)) % np.uint64(SEED_BITS)


def _set(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _quota(n: int, threshold: float, least_words: int) -> tuple[float, int, int, int]:
    """Of an item of n words: the score to reach, words that an alignment covers at most,
    starts of seeds that are looked for, and how many of those every copy has.

    An alignment of score 2 m - e has m equal words and e edits. Of the m - 1 steps from
    one equal word to the next at most e / 2 skip more than one word on a side; the others
    are seeds that start at different words of the item and of the document. A score of
    2 n t leaves n t - 1 of them or more, within n (3 - 2 t) words. The item has n - 1
    starts, so of any n - 1 - (n t - 1) + k of them a copy has k, the rarest ones too.
    """
    t = threshold if n >= least_words else 1.0
    if n == 1:
        return t, 1, 1, 1
    shared = ceil(n * t - 1 - 1e-9)
    asked = max(1, shared // 4)
    return t, floor(n * (3 - 2 * t) + 1e-9), n - 1 - shared + asked, asked


def item_seeds(items: DataFrame, text: str, threshold: float, least_words: int) -> DataFrame:
    """(text, codes, least, width, starts, asked, seeds) per different text; the width is the
    next power of two from what an alignment covers, and seeds are structs of a start and a
    seed there. A single word is a seed with itself. Without words there is no row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for t in batch.column(0).to_pylist():
                codes = coded(t)
                if not len(codes):
                    continue
                least, reach, starts, asked = _quota(len(codes), threshold, least_words)
                steps = (1, 2) if len(codes) > 1 else (0,)
                pairs = [(i, s) for step in steps for i, s in enumerate(_seed(codes[: len(codes) - step], codes[step:]).view(np.int64).tolist())]
                seeds = [{"start": i, "seed": s} for i, s in pairs]
                rows.append((t, codes.tobytes(), least, 1 << (reach - 1).bit_length(), starts, asked, seeds))
            if rows:
                kinds = [pa.string(), pa.binary(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("seed", pa.int64())]))]
                names = ["text", "codes", "least", "width", "starts", "asked", "seeds"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "text string, codes binary, least double, width int, starts int, asked int, seeds array<struct<start: int, seed: long>>"
    return items.select(whole_text(text).alias("text")).distinct().mapInArrow(work, schema)


def _bitmap(slots: DataFrame) -> np.ndarray:
    """The bits of the column ``slot``, of a size that does not depend on their number."""
    bits = np.zeros(SEED_BITS // 8, np.uint8)
    rows = slots.groupBy(F.expr(f"slot div {ROW_BITS}").alias("word")).agg(F.expr(f"bitmap_construct_agg(slot % {ROW_BITS})").alias("bits"))
    for r in rows.collect():
        at = r.word * (ROW_BITS // 8)
        bits[at : at + ROW_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def _slots(seeds: DataFrame, widths: bool) -> DataFrame:
    """The slots of (seed, width), those of the width too if asked for."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed = batch.column(0).to_numpy().view(np.uint64)
            width = batch.column(1).to_numpy().astype(np.uint64)
            both = [_slot(seed)] + ([_slot(seed + width)] if widths else [])
            yield pa.record_batch([pa.array(np.unique(np.concatenate(both)).astype(np.int64))], ["slot"])

    return seeds.select("seed", "width").mapInArrow(work, "slot long")


class Texts:
    """The codes of some texts in one array, and the seeds in them whose bit is set."""

    def __init__(self, texts: list[str], bits: np.ndarray, steps: tuple[int, ...], piece: int = PIECE):
        parts = [coded(t) for t in texts]
        lengths = [len(p) for p in parts]
        self.heads = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
        self.codes = np.concatenate([*parts, np.empty(0, np.uint64)])
        owner, at, seeds = np.repeat(np.arange(len(parts)), lengths), [], []
        for a in range(0, len(self.codes), piece):
            for step in steps:
                z = min(a + piece, len(self.codes) - step)
                if z <= a:
                    continue
                seed = _seed(self.codes[a:z], self.codes[a + step : z + step])
                hit = np.flatnonzero(_set(bits, _slot(seed)) & (owner[a:z] == owner[a + step : z + step]))
                at.append(a + hit)
                seeds.append(seed[hit])
        self.at = np.concatenate([*at, np.empty(0, np.int64)]).astype(np.int64)
        self.seeds = np.concatenate([*seeds, np.empty(0, np.uint64)])
        self.owner = owner[self.at]

    def frequencies(self) -> tuple[np.ndarray, np.ndarray]:
        """The seeds and in how many of the texts they are."""
        order = np.lexsort((self.seeds, self.owner))
        seeds, owner = self.seeds[order], self.owner[order]
        first = np.r_[True, (seeds[1:] != seeds[:-1]) | (owner[1:] != owner[:-1])][: len(seeds)]
        return np.unique(seeds[first], return_counts=True)

    def passages(self, bits: np.ndarray, width: int, asked: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(text, first word, codes, seeds) of the passages of two widths, each a width on
        from the last, in which seeds of items of that width start at ``asked`` words.
        Whatever is not longer than a width is within one of them."""
        hit = _set(bits, _slot(self.seeds, width))
        at, seeds, owner = self.at[hit], self.seeds[hit], self.owner[hit]
        cell = (at - self.heads[owner]) // width
        again = cell > 0
        at, seeds, owner = np.r_[at, at[again]], np.r_[seeds, seeds[again]], np.r_[owner, owner[again]]
        cell = np.r_[cell, cell[again] - 1]
        order = np.lexsort((at, cell, owner))
        at, seeds, owner, cell = at[order], seeds[order], owner[order], cell[order]
        cuts = np.flatnonzero((owner[1:] != owner[:-1]) | (cell[1:] != cell[:-1])) + 1
        for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(at)]):
            if z - a >= asked and len(np.unique(at[a:z])) >= asked:
                n, start = int(owner[a]), int(cell[a]) * width
                head, end = int(self.heads[n]), int(self.heads[n + 1])
                yield n, start, self.codes[head + start : min(head + start + 2 * width, end)], np.unique(seeds[a:z])


def _frequencies(docs: DataFrame, bits: Broadcast, steps: tuple[int, ...]) -> DataFrame:
    """(seed, docs): in how many rows of ``docs`` (their only column) each seed is."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            seeds, n = Texts(batch.column(0).to_pylist(), bits.value, steps).frequencies()
            yield pa.record_batch([pa.array(seeds.view(np.int64)), pa.array(n.astype(np.int64))], ["seed", "docs"])

    return docs.mapInArrow(work, "seed long, docs long").groupBy("seed").agg(F.sum("docs").alias("docs"))


def _passages(docs: DataFrame, bits: Broadcast, steps: tuple[int, ...], widths: list[tuple[int, int]]) -> DataFrame:
    """(digest, width, start, codes, seeds) of the passages of ``docs`` (digest, text)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        names = ["digest", "width", "start", "codes", "seeds"]
        for batch in chunks(batches):
            texts, rows = Texts(batch.column(1).to_pylist(), bits.value, steps), []
            for width, asked in widths:
                for n, start, codes, seeds in texts.passages(bits.value, width, asked):
                    rows.append((batch.column(0)[n].as_py(), width, start, codes.tobytes(), seeds.view(np.int64).tolist()))
                    if len(rows) == 1024:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.mapInArrow(work, "digest binary, width int, start long, codes binary, seeds array<long>")


def _aligned(pairs: DataFrame) -> DataFrame:
    """(digest, item, score, first_word, end_word) of the pairs that reach their score."""
    names = ["digest", "item", "score", "first_word", "end_word"]
    kinds = [pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for digest, item, least, start, codes, passage in zip(*(c.to_pylist() for c in batch.columns)):
                place = best_place(np.frombuffer(codes, np.uint64), np.frombuffer(passage, np.uint64), least)
                if place:
                    rows.append((digest, item, place[0], start + place[1], start + place[2]))
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    columns = pairs.select("digest", "item", "least", "start", "item_codes", "codes")
    return columns.mapInArrow(work, "digest binary, item long, score double, first_word long, end_word long")


def _digest(text: str = "text"):
    return F.unhex(F.sha2(whole_text(text), 256))


def found(docs: DataFrame, items: DataFrame, text: str, item_text: str, threshold: float, least_words: int) -> tuple[DataFrame, DataFrame] | None:
    """(digest, item, score, first_word, end_word) per different text with a copy of an
    item, at its best place; and (item, text) of the items. None if no item has words."""
    if least_words * threshold <= 1:
        raise ValueError(f"a threshold of {threshold} can be reached without a seed")
    spark = docs.sparkSession
    known = materialize(item_seeds(items, item_text, threshold, least_words).withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = known.select("item", "width", "starts", "asked", F.inline("seeds"))
    widths = [(r.width, r.asked) for r in known.groupBy("width").agg(F.min("asked").alias("asked")).orderBy("width").collect()]
    if not widths:
        return None
    steps = (0, 1, 2) if widths[0][0] == 1 else (1, 2)
    asked_for = spark.sparkContext.broadcast(_bitmap(_slots(seeds, False)))
    bodies = docs.select(_digest(text).alias("digest"), whole_text(text).alias("text"))
    counts = _frequencies(bodies.select("text"), asked_for, steps)
    # Starts of an item by how many documents have their seeds, the rarest first.
    counted = seeds.join(counts, "seed", "left").groupBy("item", "start", "width", "starts", "asked").agg(
        F.sum(F.coalesce("docs", F.lit(0))).alias("docs"), F.collect_list("seed").alias("seeds")
    )
    place = F.row_number().over(Window.partitionBy("item").orderBy("docs", "start"))
    rare = counted.withColumn("place", place).filter("place <= starts").select("item", "width", "asked", F.explode("seeds").alias("seed"))
    rare = materialize(rare, "rare-seeds")
    wanted = spark.sparkContext.broadcast(_bitmap(_slots(rare, True)))
    # Copies of a text have the same passages; one is enough.
    passages = _passages(bodies, wanted, steps, widths).groupBy("digest", "width", "start").agg(
        F.any_value("codes").alias("codes"), F.any_value("seeds").alias("seeds")
    )
    passages = materialize(passages, "passages")
    shared = passages.select("digest", "width", "start", F.explode("seeds").alias("seed")).join(rare, ["width", "seed"])
    pairs = shared.groupBy("digest", "width", "start", "item").agg(F.count("*").alias("n"), F.max("asked").alias("asked")).filter("n >= asked")
    pairs = pairs.join(passages.drop("seeds"), ["digest", "width", "start"])
    pairs = pairs.join(known.select("item", "least", F.col("codes").alias("item_codes")), "item")
    best = F.max(F.struct("score", (-F.col("first_word")).alias("first"), (-F.col("end_word")).alias("end")))
    places = _aligned(pairs).groupBy("digest", "item").agg(best.alias("b"))
    places = places.select("digest", "item", "b.score", (-F.col("b.first")).alias("first_word"), (-F.col("b.end")).alias("end_word"))
    return places, known.select("item", "text")


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(key, item_id, score, first_word, end_word): every pair of a row of ``docs`` and an
    item it holds a copy of, at the best place, the first of equal ones; 1 is a full copy.

    Case and punctuation don't count. Null and empty texts have no words and no leaks; of
    items of fewer than ``least_words`` words only full copies count. A repeated row of
    ``docs`` is reported again, a repeated item once. Without items or documents there are
    no rows. Other columns are left out.
    """
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    names = ["key", "item_id", "score", "first_word", "end_word"]
    schema = f"key {kind}, item_id {item_kind}, score double, first_word long, end_word long"
    both = found(docs, items, text, item_text, threshold, least_words)
    if both is None:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    places, known = both
    ids = items.select(F.col(item_key).alias("item_id"), whole_text(item_text).alias("text")).distinct()
    # Rows are found again by their texts' digests; no text is shuffled for it.
    rows = docs.select(F.col(key).alias("key"), _digest(text).alias("digest")).join(places, "digest")
    rows = rows.join(known.join(ids, "text").select("item", "item_id"), "item")
    return rows.select(*names).withColumnRenamed("key", key)


def decontaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``docs`` without the rows that hold a copy of an item, as ``leaks`` finds them, all
    columns as they were."""
    both = found(docs, items, text, item_text, threshold, least_words)
    if both is None:
        return docs
    held = fresh(docs, "_digest")
    dropped = materialize(both[0].select(F.col("digest").alias("row")).distinct(), "leaked")
    return without_rows(docs.withColumn(held, _digest(text)), dropped, held)
