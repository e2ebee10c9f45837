"""Phrase collocations from weighted acyclic automata.

Each shard of words is turned into its windows (up to five words from each word on, within
a piece), sorted, and built into count automata, one per range of prefixes. A range's task
adds up the shards' automata and walks its union only along prefixes that are common
enough. A candidate's parts are looked up by composing the wanted parts with the common
phrases of their range.

Windows are cut at words that are rarer than a phrase has to be, which no phrase or part
holds, and between words whose pair is rarer; bitmaps tell them, and what these let through
falls to the exact counts. Pairs are counted by hash, tasks hand on their counts in blocks,
so a slot of several pairs has their sum and no common pair is missed. Ranges are cut at sampled windows, as a range-partitioned sort does it, so a
frequent first word or pair of words is spread over several. Only the words on the path of
a cut have their counts added up from two ranges or more; the sample affects nothing else.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscope.llm.common import chunks
from payscope.llm.count_automata import DEPTH, Automaton, place, summed, union
from payscope.session import materialize

#: Words of a shard, distinct words a task counts at once.
SHARD_WORDS = 1 << 19
HELD_WORDS = 1 << 19
#: Bits that tell common words (8 MiB), words per range of prefixes, and ranges at most
#: (their cuts, about 50 bytes each, are broadcast; beyond it ranges grow).
COMMON_BITS = 1 << 26
RANGE_WORDS = 1_000_000
RANGES = 1 << 18
#: Bits that tell common pairs: one per so many words or more, as a power of two between
#: these (32 MiB at most; beyond it more rare pairs are let through). Slots of a block, pairs
#: a task counts at once.
PAIR_WORDS, PAIR_BITS = 16, (22, 28)
PAIR_BLOCK = 16
HELD_PAIRS = 1 << 23
#: Sampled words for each cut.
PER_CUT = 60

#: What ends a piece becomes a line break, a tab a space.
_SPLIT = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def words(texts: list[str]) -> list[bytes]:
    """Words of all texts, ``\\n`` between pieces and empty ones between spaces."""
    return "\n".join(texts).encode().translate(_SPLIT).replace(b"\n", b" \n ").split(b" ")


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    langs: dict[str, list[str]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        langs.setdefault(lang, []).append(text)
    yield from langs.items()


def _spelled(column: str) -> Column:
    return F.decode(column, "UTF-8")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of ``docs`` (lang, text). Tasks add up before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in chunks(batches):
            for lang, texts in _by_lang(batch):
                held.setdefault(lang, Counter()).update(words(texts))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from _counted(held)
                held = {}
        yield from _counted(held)

    return docs.mapInArrow(run, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _counted(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counter in held.items():
        counter.pop(b"", None)
        counter.pop(b"\n", None)
        columns = [pa.array([lang] * len(counter), pa.string()), pa.array(counter.keys(), pa.binary()), pa.array(counter.values(), pa.int64())]
        yield pa.record_batch(columns, ["lang", "word", "f"])


def common_bits(counts: DataFrame, least: int) -> np.ndarray:
    """The bitmap of words with ``least`` occurrences or more, a fixed number of bytes."""
    seed = F.xxhash64("lang", "word")  # the second is hashed with the first one's hash as seed
    slot = F.pmod(seed, F.lit(COMMON_BITS))
    size = 32768
    bits = counts.filter(F.col("f") >= least).select(slot.alias("s")).groupBy(F.expr(f"s div {size}").alias("at")).agg(F.expr(f"bitmap_construct_agg(s % {size})").alias("bits"))
    out = np.zeros(COMMON_BITS // 8, np.uint8)
    for row in bits.toLocalIterator():  # 2,048 rows of 4 KiB at most
        out[row["at"] * size // 8 : row["at"] * size // 8 + size // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


class Labels(dict):
    """Word to a number in the order met; 0 for words that are not common and for the end
    of a piece, -1 for what is no word."""

    def __init__(self, lang: str, bits: np.ndarray):
        super().__init__({b"": -1, b"\n": 0})
        self.seed, self.bits, self.words, self.hashes = xxhash.xxh64_intdigest(lang.encode(), 42), bits, [], []

    def __missing__(self, word: bytes) -> int:
        hashed = xxhash.xxh64_intdigest(word, self.seed)
        slot = hashed % COMMON_BITS
        if self.bits[slot >> 3] >> (slot & 7) & 1:
            self.words.append(word)
            self.hashes.append(hashed)
            self[word] = len(self.words)
        else:
            self[word] = 0
        return self[word]


def windows(ids: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Up to ``DEPTH`` labels from each on, until the next 0 or the next one that is not
    ``joined`` to the one before it."""
    out = np.zeros((len(ids), DEPTH), np.int32)
    out[:, 0] = ids
    for d in range(1, min(DEPTH, len(ids))):
        out[:-d, d] = np.where((out[:-d, d - 1] > 0) & joined[d - 1 :], ids[d:], 0)
    return out[ids > 0]


class Shard:
    """Words of one language until they are enough for automata."""

    def __init__(self, lang: str, bits: np.ndarray, pairs: np.ndarray | None = None):
        self.labels, self.pairs, self.parts, self.size = Labels(lang, bits), pairs, [], 0

    def add(self, texts: list[str]) -> None:
        found = words(texts)
        self.parts += [np.fromiter(map(self.labels.__getitem__, found), np.int32, len(found)), np.zeros(1, np.int32)]
        self.size += len(found)

    def ids(self) -> np.ndarray:
        found = np.concatenate(self.parts)
        return found[found >= 0]

    def pair_slots(self, ids: np.ndarray, power: int) -> np.ndarray:
        """The slot of each label with the next one."""
        hashes = np.array([0, *self.labels.hashes], np.uint64)[ids]
        out = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
        out += hashes[1:]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return (out >> np.uint64(64 - power)).astype(np.uint32)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Which labels go on with the next one: all without a bitmap of pairs."""
        if self.pairs is None:
            return np.ones(max(len(ids) - 1, 0), bool)
        slot = self.pair_slots(ids, (8 * len(self.pairs)).bit_length() - 1)
        return (self.pairs[slot >> np.uint32(3)] >> (slot & np.uint32(7)).astype(np.uint8) & 1).astype(bool)

    def sorted_windows(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words in order, and the windows over their places in it."""
        order = sorted(range(len(self.labels.words)), key=self.labels.words.__getitem__)
        rank = np.zeros(len(order) + 1, np.int32)
        rank[np.array(order, np.int64) + 1] = np.arange(1, len(order) + 1)
        ids = self.ids()
        rows = rank[windows(ids, self.joined(ids))]
        return [self.labels.words[i] for i in order], *summed(rows, np.ones(len(rows), np.int64))


def _shards(
    batches: Iterable[pa.RecordBatch], bits: np.ndarray, pairs: np.ndarray | None = None, shard_words: int = SHARD_WORDS
) -> Iterator[tuple[str, Shard]]:
    held: dict[str, Shard] = {}
    for batch in chunks(batches):
        for lang, texts in _by_lang(batch):
            shard = held.setdefault(lang, Shard(lang, bits, pairs))
            for text in texts:
                shard.add([text])
                if shard.size >= shard_words:
                    yield lang, held.pop(lang)
                    shard = held[lang] = Shard(lang, bits, pairs)
    yield from held.items()


def common_pairs(docs: DataFrame, bits, total: int, least: int, shard_words: int = SHARD_WORDS) -> np.ndarray:
    """The bitmap of slots of pairs of common words with ``least`` occurrences or more in
    all. A task hands on its counts, no higher than ``least``, in blocks of slots."""
    power = min(max((total // PAIR_WORDS).bit_length(), PAIR_BITS[0]), PAIR_BITS[1])
    block = 1 << PAIR_BLOCK
    kind = np.dtype("u1" if least < 1 << 8 else "<u4")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, shard in _shards(batches, bits.value, None, shard_words):
            if shard.size:
                ids = shard.ids()
                held.append(shard.pair_slots(ids, power)[(ids[:-1] > 0) & (ids[1:] > 0)])
                size += len(held[-1])
            if size >= HELD_PAIRS:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        slot, n = np.unique(np.concatenate(held), return_counts=True)
        n = np.minimum(n, least).astype(kind)
        at = np.flatnonzero(np.diff(slot >> np.uint32(PAIR_BLOCK), prepend=-1))
        inside = (slot & np.uint32(block - 1)).astype("<u2")
        bounds = [*zip(at.tolist(), [*at[1:].tolist(), len(slot)])]
        columns = [
            pa.array((slot[at] >> np.uint32(PAIR_BLOCK)).astype(np.int32)),
            pa.array([inside[a:b].tobytes() for a, b in bounds], pa.binary()),
            pa.array([n[a:b].tobytes() for a, b in bounds], pa.binary()),
        ]
        return pa.record_batch(columns, ["block", "slots", "n"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(block, np.int64)
        for batch in batches:
            for at, slots, n in zip(*(c.to_pylist() for c in batch.columns)):
                if at != now:
                    yield from told(now, sums)
                    now, sums[:] = at, 0
                sums[np.frombuffer(slots, "<u2")] += np.frombuffer(n, kind)
        yield from told(now, sums)

    def told(now: int | None, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        if now is not None and (sums >= least).any():
            common = np.packbits(sums >= least, bitorder="little").tobytes()
            yield pa.record_batch([pa.array([now], pa.int32()), pa.array([common], pa.binary())], ["block", "bits"])

    parts = docs.mapInArrow(count, "block int, slots binary, n binary").repartition("block").sortWithinPartitions("block")
    out = np.zeros(1 << power - 3, np.uint8)
    for at, common in zip(*(c.to_pylist() for c in parts.mapInArrow(add, "block int, bits binary").toArrow().columns)):  # a bit per slot
        out[at * block // 8 : (at + 1) * block // 8] = np.frombuffer(common, np.uint8)
    return out


#: A cut: language and words of the first window after it.
Cut = tuple[str, *tuple[bytes, ...]]


def cuts(docs: DataFrame, total: int, bits, pairs, range_words: int = RANGE_WORDS) -> list[Cut]:
    """Windows that part the corpus into about equal ranges, from a sample of documents."""
    ranges = min(RANGES, total // range_words + 1)
    if ranges == 1:
        return []
    share = min(1.0, PER_CUT * 250 * ranges / total)  # a sampled text gives one word in 250 or so

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(1)
        for lang, shard in _shards(batches, bits.value, pairs.value):
            if shard.size:
                own, rows, n = shard.sorted_windows()
                taken = np.flatnonzero(rng.random(len(rows)) < np.minimum(1, n * PER_CUT * ranges / (total * share)))
                said = [b"\n".join(own[i - 1] for i in row if i) for row in rows[taken].tolist()]
                yield pa.record_batch([pa.array([lang] * len(said), pa.string()), pa.array(said, pa.binary())], ["lang", "window"])

    sample = docs.sample(share, 1).mapInArrow(run, "lang string, window binary").toArrow()
    found = sorted((lang, *window.split(b"\n")) for lang, window in zip(sample.column(0).to_pylist(), sample.column(1).to_pylist()))
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def sliced(lang: str, own: list[bytes], rows: np.ndarray, all_cuts: list[Cut]) -> Iterator[tuple[int, int, int]]:
    """(range, start, stop) of a language's sorted windows."""
    first, last = bisect_left(all_cuts, (lang,)), bisect_left(all_cuts, (lang + "\0",))
    at = [0]
    for _, *cut in all_cuts[first:last]:
        bound = []
        for word in cut:
            i = bisect_left(own, word)
            bound.append(i + 1)
            if i == len(own) or own[i] != word:
                break
        at.append(place(rows, bound + [0] * (DEPTH - len(bound))))
    for k, (start, stop) in enumerate(zip(at, [*at[1:], len(rows)])):
        if start < stop:
            yield first + k, start, stop


PACKED = "range int, lang string, words binary, sizes array<int>, final array<long>, n_arcs array<int>, label array<int>, child array<int>"


def _packed(k: int, lang: str, own: list[bytes], rows: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    used = np.zeros(len(own) + 1, bool)
    used[rows] = True
    used[0] = False
    label = (np.cumsum(used) * used).astype(np.int32)  # places among the words that this range has
    rows, used = label[rows], np.flatnonzero(used)
    sizes, final, n_arcs, labels, child = Automaton.of(rows, weights).packed()
    numbers = [pa.array([v], pa.list_(t)) for v, t in ((sizes, pa.int32()), (final, pa.int64()), (n_arcs, pa.int32()), (labels, pa.int32()), (child, pa.int32()))]
    said = b"\n".join(own[i - 1] for i in used.tolist())
    return pa.record_batch([pa.array([k], pa.int32()), pa.array([lang]), pa.array([said], pa.binary()), *numbers], ["range", "lang", "words", "sizes", "final", "n_arcs", "label", "child"])


def shard_automata(docs: DataFrame, bits, pairs, all_cuts, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The shards' count automata by range, a row each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in _shards(batches, bits.value, pairs.value, shard_words):
            if shard.size:
                own, rows, weights = shard.sorted_windows()
                for k, start, stop in sliced(lang, own, rows, all_cuts.value):
                    yield _packed(k, lang, own, rows[start:stop], weights[start:stop])

    return docs.mapInArrow(run, PACKED)


def common_phrases(packed: DataFrame, all_cuts, least: int) -> DataFrame:
    """(lang, phrase, m, f) of all phrases of 1 to 5 words with at least that many
    occurrences. A task goes through its ranges one after the other and adds automata up
    as they come, so it holds the union of one range and a few shards' parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, size = None, [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                k, lang, said, *arrays = (batch.column(c)[row] for c in range(batch.num_columns))
                if (k.as_py(), lang.as_py()) != now:
                    yield from _said(now, parts, all_cuts.value, least)
                    now, parts, size = (k.as_py(), lang.as_py()), [], 0
                own = said.as_py().split(b"\n") if said.as_py() else []
                parts.append((own, Automaton.unpacked(*(a.values.to_numpy() for a in arrays))))
                size += len(arrays[3].values)
                if size > 2 * SHARD_WORDS and len(parts) > 1:
                    parts = [union(parts)]
                    size = sum(map(len, parts[0][1].label)) // 2  # so that a union pays for itself
        yield from _said(now, parts, all_cuts.value, least)

    dealt = packed.repartition("range").sortWithinPartitions("range", "lang")
    found = dealt.mapInArrow(run, "lang string, phrase binary, m int, f long")
    return found.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f")).filter(F.col("f") >= least).withColumn("phrase", _spelled("phrase"))


def _said(now, parts, all_cuts: list[Cut], least: int) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    (k, lang), (own, whole) = now, union(parts)
    rows, f = whole.heavy(least)
    found = {tuple(own[i - 1] for i in row if i): n for row, n in zip(rows.tolist(), f.tolist())}
    # Prefixes of the cuts at either end go on in the next range: rarer ones count as well.
    totals, starts = whole.totals(), [np.append(0, np.cumsum(n)) for n in whole.n_arcs]
    for _, *cut in [c for c in all_cuts[max(k - 1, 0) : k + 1] if c[0] == lang]:
        state = 0
        for d, word in enumerate(cut):
            i = bisect_left(own, word)
            arcs = slice(starts[d][state], starts[d][state + 1])
            at = np.flatnonzero(whole.label[d][arcs] == i + 1) if i < len(own) and own[i] == word else ()
            if not len(at):
                break
            state = whole.child[d][arcs][at[0]]
            found[tuple(cut[: d + 1])] = int(totals[d + 1][state])
    columns = [pa.array([lang] * len(found), pa.string()), pa.array([b" ".join(p) for p in found], pa.binary()), pa.array(map(len, found), pa.int32()), pa.array(found.values(), pa.int64())]
    yield pa.record_batch(columns, ["lang", "phrase", "m", "f"])


def look_up(asked: DataFrame, phrases: DataFrame, all_cuts) -> DataFrame:
    """(lang, part, f) of the distinct (lang, part) in ``asked``: per range, its phrases as
    an automaton composed with the parts that lie in it."""

    def ranged(df: DataFrame, column: str) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                k = [bisect_right(all_cuts.value, (lang, *p.encode().split(b" "))) for lang, p in pairs]
                yield pa.record_batch([pa.array(k, pa.int32()), *batch.columns], ["range", "lang", "part", "f"])

        return df.select("lang", column, "f").mapInArrow(run, "range int, lang string, part string, f long")

    def compose(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for lang in sorted({*left.column("lang").to_pylist()}):
            mine, its = (
                [(p.encode().split(b" "), f) for g, p, f in zip(*(t.column(c).to_pylist() for c in ("lang", "part", "f"))) if g == lang]
                for t in (left, right)
            )
            own = sorted({w for p, _ in [*mine, *its] for w in p})
            number = {w: i + 1 for i, w in enumerate(own)}
            built = []
            for side in (mine, its):
                rows = np.array([[number[w] for w in p] + [0] * (DEPTH - len(p)) for p, _ in side], np.int64).reshape(-1, DEPTH)
                built.append(Automaton.of(*summed(rows, np.array([f for _, f in side], np.int64))))
            rows, f = built[0].compose(built[1])
            out += [(lang, b" ".join(own[i - 1] for i in row if i).decode(), n) for row, n in zip(rows.tolist(), f.tolist())]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["lang", "part", "f"])

    mine = ranged(phrases, "phrase").groupBy("range")
    its = ranged(asked.select("lang", "part").distinct().withColumn("f", F.lit(1).cast("long")), "part").groupBy("range")
    return mine.cogroup(its).applyInArrow(compose, "lang string, part string, f long")


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, lang: str = "lang", text: str = "text",
    range_words: int = RANGE_WORDS, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per language the first ``top`` phrases of 2 to 5 words by score: lang, rank, phrase,
    a, l, r, n, score. A phrase occurs ``least`` times or more; its score is that of its
    weakest cut into two parts; it goes if a longer phrase that holds it occurs as often.

    Null texts are empty, a null language is ``und``. Repeated rows count again. Ties go by
    occurrences, then by the bytes of the phrase. Other columns are left out; an empty
    table, or one without such phrases, gives an empty result."""
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    counts = materialize(word_counts(slim), "words")
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bits = spark.sparkContext.broadcast(common_bits(counts, least))
    pairs = spark.sparkContext.broadcast(common_pairs(slim, bits, total, least, shard_words))
    all_cuts = spark.sparkContext.broadcast(cuts(slim, total, bits, pairs, range_words))
    packed = shard_automata(slim, bits, pairs, all_cuts, shard_words)
    phrases = materialize(common_phrases(packed, all_cuts, least), "phrases")

    held = F.split("phrase", " ")
    parts = (
        phrases.filter("m > 1")
        .select("lang", "phrase", "m", F.col("f").alias("a"), held.alias("held"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
        .withColumns({
            "first": F.array_join(F.slice("held", F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice("held", F.col("k") + 1, F.col("m") - F.col("k")), " "),
        })
        .drop("held")
    )
    asked = parts.select("lang", F.explode(F.array("first", "rest")).alias("part"))
    known = materialize(look_up(asked, phrases, all_cuts), "parts")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = (
        parts.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(sizes, "lang")
        .withColumns({"x": wide("a") * wide("n") * F.lit(1000), "y": wide("l") * wide("r")})
        .withColumn("score", F.expr("x div y"))
    )
    cut = materialize(cut.drop("x", "y"), "cuts")
    inside = cut.filter("k = m - 1 AND l = a").select("lang", F.col("first").alias("phrase")).union(
        cut.filter("k = 1 AND r = a").select("lang", F.col("rest").alias("phrase"))
    )
    scored = (
        cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
        .join(inside.distinct(), ["lang", "phrase"], "left_anti")
        .select("lang", "phrase", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), "n", F.col("w.score").alias("score"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
