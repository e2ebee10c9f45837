"""Language-model scores by online logistic context mixing.

A text is its words, lower-cased, and an end sign, spelled bit by bit: a common word by its
code in a Huffman tree of common words, another by an escape and its bytes in a tree of
bytes. Several predictors give the odds of the next bit, each from the bits that followed
the same hashed context in the corpus: for words the place alone, the word before and the
two before; for bytes the last three, the last four and the word so far. A gate, how many
of the two longer contexts are known, chooses the weights by which the odds are mixed;
after each bit these are refined by its error. The bits' costs add up to the text's log
probability.

All training texts are counted: tasks add up tables of the bits per context, which are
summed block by block into tables of a fixed size, a byte per context and node of the code.
The bytes of a spelled word are counted once per distinct word, as often as it is said.
Weights are refined within segments of a text, each gate's by its own bits, so that
thousands of lanes, a gate's bits of a segment each, are mixed side by side, a bit of each
per step. Word counts for the base score are exact: those of the
commonest words, a bounded number, are broadcast, the others joined.
"""

from __future__ import annotations

import copy
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import CHUNK_BYTES, chunks, whole_text
from payscope.session import materialize

#: Slots of a predictor as a power of two, and words with a code of their own.
TABLE_BITS = (21, 22, 22)
CODED_WORDS = 1 << 16
INPUTS = 4  # the predictors and a constant
BLOCK = 1 << 13
#: Words whose counts are broadcast, distinct words a task counts at once.
COMMON_WORDS = 1 << 18
HELD_WORDS = 1 << 20
#: Symbols worked on at once, words of a part of a very long text, bits of a segment.
SLICE, PART, SEGMENT = 1 << 13, 1 << 20, 1 << 11
#: Weight of each predictor at first, and how far an error moves it.
WEIGHT, RATE = 0.3, 0.0005
#: Every bit has this chance at least. Steps laid out at a time; bits whose chances are
#: multiplied before a logarithm is taken.
LEAST, STEPS, FACTORS = 1e-6, 32, 4
#: Bits sorted by gate at once.
PIECE = 1 << 15
#: Places that are sorted and counted at once. Symbols counted before counts are handed on,
#: so that none passes 32 bits.
WAITING, COUNTED = 1 << 20, 1 << 26
#: Bytes of text whose bits are mixed side by side; a longer text is mixed alone.
MIXED_BYTES = CHUNK_BYTES // 2
#: Odds are kept as 16ths of a natural logarithm.
SCALE = 16
GAP = 4  # bytes that a context looks back
#: Symbols beyond the bytes: what announces a spelled word, the end, the first coded word.
ESCAPE, END, FIRST = 256, 257, 258


def held_out(key: str = "doc_id") -> Column:
    """Rows that are not learned from. A null key counts as an empty one."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def spoken(text: str) -> list[bytes]:
    """What ``Said`` finds in many texts at once."""
    return text.encode().lower().split()


def parts(words: list[bytes]) -> list[list[bytes]]:
    """The words and the end sign (empty). A very long text goes in parts that know nothing
    of each other. ``Said.parts`` has the sizes for many texts."""
    said = [*words, b""]
    return [said] if len(said) <= PART else [said[i : i + PART] for i in range(0, len(said), PART)]


def _tree(counts: list[int]) -> list[list[int]]:
    """Huffman codes by counts: per symbol its path, 2 * node + bit from the root on."""
    heap = [(n + 1, i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    up: dict[int, tuple[int, int]] = {}
    for node in range(len(counts), 2 * len(counts) - 1):
        (n, _, zero), (m, _, one) = heapq.heappop(heap), heapq.heappop(heap)
        up[zero], up[one] = (node, 0), (node, 1)
        heapq.heappush(heap, (n + m, node, node))
    out = []
    for i in range(len(counts)):
        path, at = [], i
        while at in up:
            at, bit = up[at]
            path.append(2 * (at - len(counts)) + bit)
        out.append(path[::-1])
    return out


class Code:
    """The codes of bytes and of words: per symbol the bits and the nodes at which they are
    decided. A space ends a word that is spelled."""

    def __init__(self, byte_counts: np.ndarray, words: list[bytes], counts: list[int], escapes: int, ends: int):
        self.number = {w: FIRST + i for i, w in enumerate(words)} | {b"": END}
        bytes_, others = _tree([int(n) for n in byte_counts]), _tree([escapes, ends, *counts])
        paths = bytes_ + [[step + 512 for step in p] for p in others]  # nodes of their own
        self.length = np.array([len(p) for p in paths], np.uint8)
        self.start = np.cumsum(self.length, dtype=np.int32) - self.length
        steps = np.array([*chain.from_iterable(paths)], np.uint32)
        self.step = steps + np.uint32(2)
        self.bit = (steps & 1).astype(np.int8)
        self.node = (steps // 2 + np.uint32(1)) * np.uint32(0x9E3779B1)

    def decisions(self, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits and the nodes of steps, looked up together."""
        both = self.step.take(step)
        bit = (both & np.uint32(1)).astype(np.int8)
        both >>= np.uint32(1)
        both *= np.uint32(0x9E3779B1)
        return bit, both

    def depths(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order of the symbols, the longest first, and how many of them have a first bit,
        a second one and so on, so that those of a depth are the first ones."""
        n = self.length[symbols]
        left = len(n) - np.cumsum(np.bincount(n))
        return np.argsort(n, kind="stable")[::-1], left[left > 0]

    def steps(self, symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The place among the code's steps of each bit of symbols in such an order: all
        first bits, all second ones and so on."""
        return deeper(self.start[symbols], left)


def spread(values: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A symbol's value for each of its bits, depth by depth."""
    return np.concatenate([values[:k] for k in left.tolist()]) if len(left) else values[:0]


def deeper(values: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The same, one more at each depth."""
    out = spread(values, left)
    out += np.repeat(np.arange(len(left), dtype=out.dtype), left)
    return out


class Powers:
    """Powers of an odd number and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint32)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", 0x01000193), ("down", pow(0x01000193, -1, 1 << 32))):
                grown = np.full(n, base, np.uint32)
                grown[0] = 1
                setattr(self, name, np.multiply.accumulate(grown, dtype=np.uint32))


_POWERS = Powers()


class Said:
    """The words of texts in a row, and how many each text has."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        n, words = lists.value_lengths().to_numpy(), lists.flatten()
        self.text = np.repeat(np.arange(len(n)), n)
        length = pc.binary_length(words).to_numpy()
        if not length.all():  # white space at either end gives empty ones
            full = length > 0
            words, length, self.text = words.filter(pa.array(full)), length[full], self.text[full]
        self.words = words.cast(pa.binary())
        self.size = np.bincount(self.text, minlength=len(n))
        #: With a sign after each word and the end.
        self.bytes = np.bincount(self.text, length, len(n)).astype(np.int64) + self.size + 1

    def groups(self, most: int) -> Iterator[tuple[slice, Said]]:
        """The same, some texts at a time, with the places of their words."""
        group = np.cumsum(self.bytes) // most
        cuts = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(group)]
        ends = np.append(0, np.cumsum(self.size)).tolist()
        for a, z in zip(cuts, cuts[1:]):
            own, here = copy.copy(self), slice(ends[a], ends[z])
            own.text, own.size, own.bytes = self.text[here] - a, self.size[a:z], self.bytes[a:z]
            own.words = self.words.slice(here.start, here.stop - here.start)
            yield here, own

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """The text of each part, and how many words it has, the end among them."""
        n = self.size // PART + 1
        text = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        return text, np.minimum(self.size[text] + 1 - nth * PART, PART)


class Lexicon:
    """Words that have a symbol of their own or a count that is known."""

    def __init__(self, code: Code, counts: dict[bytes, int]):
        words = sorted({*code.number, *counts})
        self.words = pa.array(words, pa.binary())
        # The last place is that of all other words.
        self.symbol = np.array([*(code.number.get(w, ESCAPE) for w in words), ESCAPE], np.int32)
        self.log = np.log10(np.array([*(counts.get(w, np.nan) for w in words), np.nan]) + 1)
        self.end = self.log[words.index(b"")]

    def find(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=self.words), len(self.words)).to_numpy()


class Spelled:
    """Words spelled in bytes, with a space after each, in one buffer, with gaps so that no
    context reaches into another."""

    def __init__(self, said: pa.Array):
        gap = b"\n" * GAP
        apart = pc.binary_join_element_wise(said.cast(pa.large_binary()), pa.scalar(b" " + gap, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        self.buffer = np.frombuffer(gap + b"".join(b[:] for b in apart.buffers()[2:] if b), np.uint8)
        size = pc.binary_length(said).to_numpy().astype(np.int64) + 1
        self.first = np.cumsum(size + GAP) - size
        self.size = size
        self.at = np.arange(size.sum()) + np.repeat(self.first - (np.cumsum(size) - size), size)
        _POWERS.reach(len(self.buffer) + 1)
        self.word = np.repeat(self.first, size)  # where the word of each byte begins
        self.sums = np.append(np.uint32(0), np.cumsum(self.buffer * _POWERS.up[: len(self.buffer)], dtype=np.uint32))

    def contexts(self) -> list[np.ndarray]:
        """Per predictor, the context of each byte: the last three, the last four, the word
        so far."""
        x, at, start = self.buffer, self.at, self.word
        last = [x[at - k].astype(np.uint32) for k in range(1, GAP + 1)]
        three = last[0] | last[1] << np.uint32(8) | last[2] << np.uint32(16)
        return [three, three | last[3] << np.uint32(24), (self.sums[at] - self.sums[start]) * _POWERS.down[start]]


def hashed(known: np.ndarray, predictor: int) -> np.ndarray:
    out = known * np.uint32((0xC2B2AE35, 0x27D4EB2F, 0x165667B1)[predictor])
    return out ^ out >> np.uint32(15)


class Texts:
    """Texts as symbols, with the hashed contexts of each; on demand without the bytes of
    spelled words."""

    def __init__(self, said: Said, found: np.ndarray, spell: bool = True):
        self.owner, words = said.parts()
        word = np.full(len(found) + len(said.size), END, np.int32)
        inside = np.ones(len(word), bool)
        inside[np.cumsum(said.size + 1) - 1] = False
        word[inside] = found
        spelled = Spelled(said.words.filter(pa.array((found == ESCAPE) & spell)))
        n = np.ones(len(word), np.int64)
        if spell:
            n[word == ESCAPE] += spelled.size
        first = np.cumsum(n) - n
        self.symbols = np.empty(int(n.sum()), np.int32)
        inside = np.ones(len(self.symbols), bool)
        inside[first] = False
        self.symbols[first], self.symbols[inside] = word, spelled.buffer[spelled.at]
        place = np.arange(len(word)) - np.repeat(np.cumsum(words) - words, words)  # within the part
        one, two = np.zeros(len(word), np.uint32), np.zeros(len(word), np.uint32)
        one[1:], two[2:] = word[:-1], word[:-2]
        one[place < 1] = two[place < 2] = 0
        before = [np.zeros(len(word), np.uint32), one, one * np.uint32(0x2545F491) + two]
        self.contexts = []
        for k, (w, b) in enumerate(zip(before, spelled.contexts())):
            mixed = np.empty(len(self.symbols), np.uint32)
            mixed[first], mixed[inside] = w, b
            self.contexts.append(hashed(mixed, k))
        ends = np.cumsum(words)
        self.size = np.diff(np.append(np.append(first, len(self.symbols))[ends - words], len(self.symbols))) if len(words) else words
        self.places = [np.flatnonzero(inside), first]

    def slices(self) -> Iterator[tuple[np.ndarray, bool]]:
        """Places of symbols, some at a time, and whether these are words: the first predictor
        gives words no context."""
        for coded, places in enumerate(self.places):
            for i in range(0, len(places), SLICE):
                yield places[i : i + SLICE], bool(coded)


def slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """The place in its table of each bit's context and node."""
    out = context ^ node
    out *= np.uint32(0x2C1B3C6D)
    out >>= np.uint32(32 - bits)
    return out


class Tally:
    """Counts by place. Places wait until there are many and are counted in their order, so
    that the counts are passed over instead of being looked up here and there."""

    def __init__(self, size: int):
        self.counts, self.waiting, self.n = np.zeros(size, np.uint32), [], 0

    def add(self, places: np.ndarray, times: np.ndarray | None = None) -> None:
        if times is not None:
            np.add.at(self.counts, places, times)
            return
        self.waiting.append(places)
        self.n += len(places)
        if self.n > WAITING:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            places = np.concatenate(self.waiting)
            places.sort()
            np.add.at(self.counts, places, np.uint32(1))
            self.waiting, self.n = [], 0


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all tokens; the end sign is the empty word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for chunk in chunks(batches):
            found = Said(chunk.column(0)).words.value_counts()
            held.append(pa.table([found.field(0), found.field(1)], ["word", "c"]))
            held.append(pa.table([pa.array([b""], pa.binary()), pa.array([chunk.num_rows], pa.int64())], ["word", "c"]))
            if sum(t.num_rows for t in held) > HELD_WORDS:
                held = [summed(held)]
                if held[0].num_rows > HELD_WORDS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    def summed(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def learned_code(words: DataFrame) -> Code:
    """The codes by the counts of words: the commonest have their own, the others give the
    counts of bytes. Spelling counts as many words as there are escapes."""
    coded = commonest(words, CODED_WORDS).filter("octet_length(word) > 0")
    found = sorted(zip(*(c.to_pylist() for c in coded.toArrow().columns)))
    spelled = words.join(F.broadcast(coded.select("word")), "word", "left_anti").filter("octet_length(word) > 0")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257)
        for batch in batches:
            own = batch.column(0).to_pylist()
            c = batch.column(1).to_numpy().astype(np.float64)
            total[:256] += np.bincount(np.frombuffer(b"".join(own), np.uint8), np.repeat(c, [len(w) for w in own]), 256)
            total[256] += c.sum()
        yield pa.record_batch([pa.array(np.arange(257)), pa.array(total.astype(np.int64))], ["byte", "n"])

    counts = np.zeros(257, np.int64)
    for row in spelled.select("word", "c").mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():  # 257 rows
        counts[row["byte"]] = row["n"]
    ends = words.filter("octet_length(word) = 0").agg(F.sum("c")).first()[0] or 0
    escapes = int(counts[256])
    counts[32] += escapes
    return Code(counts[:256], [w for w, _ in found], [c for _, c in found], escapes, ends)


def _block(counts: np.ndarray) -> tuple[bytes, int, bool]:
    """The counts of a block, in as few bytes each as they need; few ones by their places."""
    full = np.flatnonzero(counts)
    sparse = len(full) * 3 < len(counts)
    held = counts[full] if sparse else counts
    top = int(held.max()) if len(held) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 8
    body = held.astype(f"<u{width}").tobytes()
    return (full.astype("<u2").tobytes() + body if sparse else body), width, sparse


def pieces(words: pa.Array, times: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words and how often each is said, some at a time: no more than make a chunk, or are
    counted before counts are handed on. A word that is said more often comes again."""
    size = pc.binary_length(words).to_numpy().astype(np.int64) + 1
    most = np.maximum(COUNTED // size, 1)
    n = -(-times // most)
    row = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    times, size = np.minimum(times[row] - nth * most[row], most[row]), size[row]
    group = np.cumsum(size / CHUNK_BYTES + times * size / COUNTED).astype(np.int64)
    cuts = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(row)]
    for a, z in zip(cuts, cuts[1:]):
        yield words.take(pa.array(row[a:z])), times[a:z]


def tables(texts: DataFrame, words: DataFrame, code, lexicon) -> list[np.ndarray]:
    """Per predictor, the odds of a one for each slot, from all texts. A task hands on
    its blocks once; a block is summed as its parts come in. The bytes of a spelled word
    know nothing outside it, so they are counted by distinct words, as often as each is said."""
    bounds = np.cumsum([0, *(1 << b for b in TABLE_BITS)]) // BLOCK

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Tally(2 << b) for b in TABLE_BITS]
        own, seen = code.value, 0
        alone = np.zeros(len(own.length), np.uint32)
        for chunk in chunks(batches):
            said = Said(chunk.column(0))
            texts = Texts(said, lexicon.value.symbol[lexicon.value.find(said.words)], spell=False)
            for i in range(0, len(texts.symbols), SLICE):
                symbols = texts.symbols[i : i + SLICE]
                alone += np.bincount(symbols, minlength=len(alone)).astype(np.uint32)
                order, left = own.depths(symbols)
                bit, node = own.decisions(own.steps(symbols[order], left))
                for k in (1, 2):
                    held[k].add(places(texts.contexts[k][i : i + SLICE][order], left, bit, node, k))
            seen += len(texts.symbols)
            if seen > COUNTED:
                yield from settled(held, alone)
                for counts in (alone, *(table.counts for table in held)):
                    counts[:] = 0
                seen = 0
        if seen:
            yield from settled(held, alone)

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Tally(2 << b) for b in TABLE_BITS]
        own, seen = code.value, 0
        for batch in batches:
            rare = lexicon.value.symbol[lexicon.value.find(batch.column(0))] == ESCAPE
            for some, said in pieces(batch.column(0).filter(pa.array(rare)), batch.column(1).to_numpy()[rare]):
                spelled = Spelled(some)
                symbols, times = spelled.buffer[spelled.at], np.repeat(said, spelled.size).astype(np.uint32)
                contexts = [hashed(c, k) for k, c in enumerate(spelled.contexts())]
                for i in range(0, len(symbols), SLICE):
                    order, left = own.depths(symbols[i : i + SLICE])
                    bit, node = own.decisions(own.steps(symbols[i : i + SLICE][order], left))
                    often = spread(times[i : i + SLICE][order], left)
                    for k, context in enumerate(contexts):
                        held[k].add(places(context[i : i + SLICE][order], left, bit, node, k), often)
                seen += int((said * spelled.size).sum())
                if seen > COUNTED:
                    yield from settled(held)
                    for table in held:
                        table.counts[:] = 0
                    seen = 0
        if seen:
            yield from settled(held)

    def places(context: np.ndarray, left: np.ndarray, bit: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
        out = slots(spread(context, left), node, TABLE_BITS[k])
        out <<= np.uint32(1)
        out |= bit.view(np.uint8)
        return out

    def settled(held: list[Tally], alone: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        if alone is not None:  # words as the first predictor sees them
            symbols = np.flatnonzero(alone)
            order, left = code.value.depths(symbols)
            symbols = symbols[order]
            bit, node = code.value.decisions(code.value.steps(symbols, left))
            held[0].add(places(np.zeros(len(symbols), np.uint32), left, bit, node, 0), spread(alone[symbols], left))
        for table in held:
            table.settle()
        yield from blocks([table.counts for table in held])

    def blocks(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for first, table in zip(bounds, held):
            for i in range(0, len(table), 64 * 2 * BLOCK):
                rows = [(first + j // (2 * BLOCK), *_block(own)) for j in range(i, min(i + 64 * 2 * BLOCK, len(table)), 2 * BLOCK) for own in [table[j : j + 2 * BLOCK]] if own.any()]
                if rows:
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.int32(), pa.bool_()))], ["block", "counts", "width", "sparse"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts, width, sparse in zip(*(c.to_pylist() for c in batch.columns)):
                total = held.setdefault(block, np.zeros(2 * BLOCK, np.int64))
                if sparse:
                    n = len(counts) // (2 + width)
                    total[np.frombuffer(counts, "<u2", n)] += np.frombuffer(counts, f"<u{width}", n, 2 * n).astype(np.int64)
                else:
                    total += np.frombuffer(counts, f"<u{width}").astype(np.int64)
        for block, total in held.items():
            odds = np.log((total[1::2] + 0.4) / (total[::2] + 0.4)) * SCALE
            # Rounded away from 0, which is kept for contexts never met.
            signs = np.copysign(np.clip(np.ceil(np.abs(odds)), 1, 127), odds) * (total[1::2] + total[::2] > 0)
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([signs.astype(np.int8).tobytes()], pa.binary())], ["block", "odds"])

    schema = "block int, counts binary, width int, sparse boolean"
    counted = texts.mapInArrow(count, schema).union(words.select("word", "c").mapInArrow(spell, schema))
    done = materialize(counted.repartition("block").mapInArrow(add, "block int, odds binary"), "odds")
    out = np.zeros(sum(1 << b for b in TABLE_BITS), np.int8)
    for block, odds in zip(*(c.to_pylist() for c in done.toArrow().columns)):  # a byte per slot
        out[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(odds, np.int8)
    return [out[a * BLOCK : b * BLOCK] for a, b in zip(bounds, bounds[1:])]


class Model:
    """The code and the tables, with the first predictor's odds of a word's bits, which know
    the place alone, at each of the code's steps."""

    def __init__(self, code: Code, odds: list[np.ndarray]):
        self.code, self.odds = code, odds
        self.alone = odds[0].take(slots(np.uint32(0), code.node, TABLE_BITS[0]))


def predictions(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per bit of all texts the predictors' odds with room for one more value, the bit, and
    per text the number of its bits."""
    code = model.code
    n = code.length[texts.symbols]
    first = np.cumsum(n, dtype=np.int64) - n
    size = np.add.reduceat(n, np.cumsum(texts.size) - texts.size, dtype=np.int64) if len(texts.size) else np.zeros(0, np.int64)
    x = np.empty((int(size.sum()), INPUTS), np.int8)
    rows = x.view(np.int32).ravel()
    for at, coded in texts.slices():
        order, left = code.depths(texts.symbols[at])
        at = at[order]
        step = code.steps(texts.symbols[at], left)
        bit, node = code.decisions(step)
        own = np.empty((len(step), INPUTS), np.int8)
        own[:, -1] = bit
        if coded:
            own[:, 0] = model.alone.take(step)
        for k in range(coded, len(model.odds)):
            own[:, k] = model.odds[k].take(slots(spread(texts.contexts[k][at], left), node, TABLE_BITS[k]))
        rows[deeper(first[at], left)] = own.view(np.int32).ravel()
    return x, x[:, -1], size


def mix(x: np.ndarray, bit: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The natural logarithm of each text's probability. The last value of a row of x gives
    way to its bit; the constant is put in here.

    A gate's weights are refined by its own bits alone, so each gate's bits of a segment are
    a lane of their own. All lanes are mixed side by side, the longest first, so that those
    still going are always the first ones."""
    x[:, -1] = bit
    first = np.cumsum(size) - size
    n = (size + SEGMENT - 1) // SEGMENT
    text = np.repeat(np.arange(len(size)), n)
    if not len(text):
        return np.zeros(len(size))
    start = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * SEGMENT
    gate = np.empty(len(x), np.uint8)
    spans = [slice(i, i + PIECE) for i in range(0, len(x), PIECE)]
    for here in spans:
        np.add(x[here, 1] != 0, x[here, 2] != 0, out=gate[here], dtype=np.uint8)
    rows, done, lanes = np.empty(len(x) + STEPS, np.int32), 0, []
    for g in range(3):
        length = np.add.reduceat((gate == g).view(np.uint8), start, dtype=np.uint16).astype(np.int64)
        lanes.append((text, done + np.cumsum(length) - length, length))
        for here in spans:
            found = x[here].view(np.int32).ravel()[gate[here] == g]
            rows[done : done + len(found)] = found
            done += len(found)
    rows[done:] = 0
    text, at, length = (np.concatenate(v) for v in zip(*lanes))
    order = np.argsort(-length, kind="stable")
    text, at, length = text[order], at[order], length[order]
    going = len(length) - np.cumsum(np.bincount(length))
    # Half the weights and twice the error, since 2 / (1 + exp(-v)) - 1 is tanh(v / 2).
    weights = np.full((INPUTS, going[0]), WEIGHT / SCALE / 2, np.float32)
    odds, moved = np.full_like(weights, SCALE), np.empty_like(weights)
    hit, error, chance = (np.ones(going[0], np.float32) for _ in range(3))
    cost, rate = np.zeros(len(length)), np.float32(RATE / SCALE / 4)
    ahead = np.lib.stride_tricks.sliding_window_view(rows, STEPS)
    for t, k in enumerate(going[:-1].tolist()):
        if t % STEPS == 0:  # what the lanes need lies in one piece each
            laid = np.ascontiguousarray(ahead[at[:k] + t].T).view(np.int8)
        row = laid[t % STEPS].reshape(-1, INPUTS)[:k]
        w, v, m, h, e, c = weights[:, :k], odds[:, :k], moved[:, :k], hit[:k], error[:k], chance[:k]
        for i in range(INPUTS - 1):
            v[i] = row[:, i]
        np.multiply(row[:, -1], np.float32(2), h)
        h -= 1
        np.multiply(w, v, m)
        np.add.reduce(m, 0, out=e)
        np.tanh(e, e)
        np.subtract(h, e, e)
        np.multiply(e, rate, h)
        np.multiply(v, h, m)
        w += m
        np.abs(e, e)
        e *= np.float32(LEAST - 0.5)
        e += np.float32(1 - LEAST)
        c *= e
        if t % FACTORS == FACTORS - 1:
            cost[:k] += np.log(c)
            c[:] = 1
    # What lanes that ended between two such sums have left.
    cost[: len(chance)] += np.log(chance)
    return np.bincount(text, cost, len(size))


def score(said: Said, symbols: np.ndarray, model: Model) -> np.ndarray:
    texts = Texts(said, symbols)
    return np.bincount(texts.owner, mix(*predictions(texts, model)), len(said.size))


def commonest(words: DataFrame, most: int) -> DataFrame:
    """Those words whose count's order of magnitude leaves at most so many, and the end
    sign."""
    level = F.floor(F.log2("c") * 4)
    sizes = words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # 256 rows at most
    least, total = 256, 0
    for size in sizes:
        total += size["count"]
        if total > most:
            break
        least = size["level"]
    return words.filter((level >= least) | (F.octet_length("word") == 0))


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", learned: Column | None = None) -> DataFrame:
    """Per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte of the words with a sign after each. Learned from the rows where ``learned`` holds
    (those not ``held_out()``).

    Null and empty texts are a single end sign. Repeated rows count, and are scored, again.
    With nothing to learn from, each bit costs one; an empty table gives an empty result."""
    spark = docs.sparkSession
    learned = ~held_out(key) if learned is None else learned
    kind = docs.schema[key].dataType
    training = docs.filter(learned).select(whole_text(text).alias("text"))
    words = materialize(word_counts(training), "words")
    counted = words.agg(F.sum("c"), F.count("*")).first()
    tokens, different = counted[0] or 0, counted[1]
    learned_words = learned_code(words)
    code = spark.sparkContext.broadcast(learned_words)
    odds = spark.sparkContext.broadcast(tables(training, words, code, spark.sparkContext.broadcast(Lexicon(learned_words, {}))))
    common = commonest(words, COMMON_WORDS).toArrow()
    known = dict(zip(common.column("word").to_pylist(), common.column("c").to_pylist()))
    lexicon = spark.sparkContext.broadcast(Lexicon(learned_words, known))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = lexicon.value, Model(code.value, odds.value)
        for chunk in chunks(batches):
            said = Said(chunk.column(chunk.num_columns - 1))
            found, rows = own.find(said.words), chunk.num_rows
            cost = np.concatenate([score(some, own.symbol[found[here]], model) for here, some in said.groups(MIXED_BYTES)])
            value = own.log[found]
            hit = ~np.isnan(value)
            base, n_known = np.bincount(said.text[hit], value[hit], rows), np.bincount(said.text[hit], minlength=rows)
            if not np.isnan(own.end):
                base, n_known = base + own.end, n_known + 1
            rare = said.words.filter(pa.array(~hit)).dictionary_encode()
            different = max(len(rare.dictionary), 1)
            pair, times = np.unique(said.text[~hit] * different + rare.indices.to_numpy(), return_counts=True)
            ends = pa.array(np.append(0, np.cumsum(np.bincount(pair // different, minlength=rows))), pa.int32())
            yield pa.record_batch(
                [*chunk.columns[:3], pa.array(said.size + 1), pa.array(n_known), pa.array(base, pa.float64()), pa.array(cost / np.log(10)), pa.array(-cost / np.log(2) / said.bytes),
                 pa.ListArray.from_arrays(ends, rare.dictionary.take(pa.array(pair % different))), pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))],
                NAMES,
            )

    slim = docs.select(F.col(key), F.monotonically_increasing_id(), ~learned, whole_text(text))
    schema = f"key {kind.simpleString()}, row long, held_out boolean, n_tokens long, hits long, base double, score double, bits_per_byte double, rare array<binary>, times array<long>"
    scored = materialize(slim.mapInArrow(run, schema), "scored")
    left = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    more = left.join(words, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("more_hits")
    )
    spread = float(np.log10(tokens + different + 1))
    return scored.join(more, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("hits") + F.coalesce("more_hits", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(spread)).alias("base_score"),
        "score", "bits_per_byte",
    )


NAMES = ["key", "row", "held_out", "n_tokens", "hits", "base", "score", "bits_per_byte", "rare", "times"]
