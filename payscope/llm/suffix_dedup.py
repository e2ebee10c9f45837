"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier is removed.

Suffixes are dealt out by content, so that no task needs the whole corpus. Each string
start s is assigned to its seed, the ``GRAM``-byte string with the smallest hash within
the ``LENGTH`` bytes from s: equal strings have equal seeds at equal places. Neighbouring
starts of one seed share a window, the text from the first start to the end of the last
one's string.

1. A scan writes seed and window hash. Windows that are equal throughout need no sorting:
   all but the first are removed. A seed with one window text is done.
2. Of seeds with several window texts each window that is left is asked for by row and
   place. The lists of places are joined with the documents, which cuts out the texts of
   just these windows, however many there are, and sends them to the task of their seed.
3. There, shards of windows get a suffix order and its Burrows-Wheeler transform each,
   over an alphabet of ``SIGN`` bytes a sign: a window is ``SIGN`` strings, one for each
   phase, and a suffix is reached from the next by one sign. The transforms are merged by
   refining an interleave: the order by h signs gives that by h + 1 by moving every entry
   to the bucket of its preceding sign, block borders show which neighbours have h signs
   in common, and after ``LENGTH / SIGN`` rounds the blocks are the repeated intervals.
   No suffix is compared or sorted again.
4. A seed with very many window texts is split over several tasks, which hand on one
   occurrence per string and task; a last grouping by string hash settles these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payscope.llm.common import KEPT_BITS, chunks, marked, numbered, whole_text
from payscope.session import materialize

LENGTH, GRAM, SIGN = 100, 32, 20
#: Bytes that are hashed together, window texts of one seed in a task at most, and bytes of
#: windows that are merged as one group of two shards.
PIECE, SPLIT, GROUP = 1 << 17, 16384, 1 << 19
#: Kinds of rows: the one occurrence a chunk hands on, a later one, a mark for a seed with
#: several window texts in the chunk, a window of such a seed; and windows asked for, seeds
#: to be split.
SINGLE, LATER, MARK, SURE = 0, 1, 2, 3
REMOVED, ASKED, MANY = 0, 1, 2
#: Bits of the number of starts in a run; a group has fewer than that many starts.
RUN = 24

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SIGNS = np.random.default_rng(11).integers(0, 1 << 63, 256).astype(_U) * _U(2) + _U(1)


class _Powers:
    """Powers of the base of the rolling hash and of its inverse, as far as needed."""

    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * PIECE)
            cls.up = np.cumprod(np.r_[_U(1), np.full(n, _U(_BASE))])
            cls.down = np.cumprod(np.r_[_U(1), np.full(n, _U(pow(_BASE, -1, 1 << 64)))])
        return cls.up, cls.down


def _prefix_hash(line: np.ndarray) -> np.ndarray:
    up, _ = _Powers.to(len(line) + 1)
    out = np.zeros(len(line) + 1, _U)
    np.cumsum(_SIGNS[line] * up[: len(line)], out=out[1:])
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def _slice_hash(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    _, down = _Powers.to(len(prefix))
    return _mix((prefix[b] - prefix[a]) * down[a])


def windows(line: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts one after the other: seed, window hash, number of the text, first start
    within the line, number of starts. Starts with less than LENGTH bytes left have none."""
    empty = np.zeros(0, np.int64)
    if len(line) < LENGTH:
        return empty.astype(_U), empty.astype(_U), empty, empty, empty
    prefix = _prefix_hash(line)
    _, down = _Powers.to(len(prefix))
    low = _mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: len(line) - GRAM + 1])
    gram, width, span = low, LENGTH - GRAM + 1, 1
    at = np.arange(len(low), dtype=np.int32)
    while span < width:  # the leftmost smallest hash of ever longer stretches
        step = min(span, width - span)
        less = low[step:] < low[:-step]
        low, at = np.where(less, low[step:], low[:-step]), np.where(less, at[step:], at[:-step])
        span += step
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes)[: len(at)] - np.arange(len(at))
    start = np.flatnonzero(left >= LENGTH)
    if not len(start):
        return empty.astype(_U), empty.astype(_U), empty, empty, empty
    place = at[start]
    cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
    first, n = start[cut], np.diff(np.r_[cut, len(start)])
    place = place[cut].astype(np.int64)
    text = _slice_hash(prefix, first, first + n - 1 + LENGTH) + (place - first).astype(_U) * _U(0xFF51AFD7ED558CCD)
    return gram[place], text, np.searchsorted(ends, first, "right"), first, n


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """Texts of about PIECE bytes at a time with (id, row, first byte); long texts are cut
    so that every start is in one part and has its LENGTH bytes there."""
    names, parts, size = [], [], 0
    for i, row, text in zip(*(c.to_pylist() for c in batch.columns)):
        raw = text.encode()
        for a in range(0, max(1, len(raw) - LENGTH + 1), 1 << 20):
            part = raw if len(raw) <= 1 << 20 else raw[a : a + (1 << 20) + LENGTH - 1]
            if len(part) >= LENGTH:
                names.append((-(1 << 63) if i is None else i, row, a))
                parts.append(part)
                size += len(part)
            if size >= PIECE:
                yield names, parts
                names, parts, size = [], [], 0
    if parts:
        yield names, parts


def _chunk_windows(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """All windows of a chunk (signed longs)."""
    out = []
    for names, parts in _pieces(batch):
        line = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts])
        seed, text, number, first, n = windows(line, sizes)
        name = np.array(names, np.int64).reshape(-1, 3)
        begin = np.cumsum(sizes) - sizes
        got = {"seed": seed.view(np.int64), "text": text.view(np.int64), "id": name[number, 0], "row": name[number, 1],
               "at": name[number, 2] + first - begin[number], "n": n}
        out.append(got)
    names = ("seed", "text", "id", "row", "at", "n")
    return {k: np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in names}


def _ordered(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.lexsort((w["at"], w["row"], w["id"], w["text"], w["seed"]))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first does."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _packed(at: np.ndarray, n: np.ndarray, kind: int | np.ndarray = 0) -> np.ndarray:
    return (at << 10) | (kind << 8) | n


def _hand_on(w: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A chunk's windows for the grouping by seed: one occurrence per seed where all are
    equal, else a mark. Later ones of equal windows pass by, and so does the first of each
    text where there is a mark, since it is asked for in any case (its seed as ``text``)."""
    order = np.argsort(w["seed"], kind="stable")
    w = {k: v[order] for k, v in w.items()}
    new = _changes(w["seed"])
    many = ~new
    many[:-1] |= ~new[1:]
    lone = {k: v[~many] for k, v in w.items()}
    rest = {k: v[many] for k, v in w.items()}
    order = _ordered(rest)
    rest = {k: v[order] for k, v in rest.items()}
    columns = [[lone[k] for k in ("seed", "text", "id", "row")] + [_packed(lone["at"], lone["n"], SINGLE)]]
    if len(order):
        of_seed, of_text = _changes(rest["seed"]), _changes(rest["seed"], rest["text"])
        seed = np.cumsum(of_seed) - 1
        texts = np.bincount(seed, of_text).astype(np.int64)
        single = of_text & (texts[seed] == 1)
        later = ~of_text
        for pick, kind in ((single, SINGLE), (later, LATER)):
            columns.append([rest[k][pick] for k in ("seed", "text", "id", "row")] + [_packed(rest["at"][pick], rest["n"][pick], kind)])
        sure = of_text & (texts[seed] > 1)
        columns.append([rest[k][sure] for k in ("seed", "seed", "id", "row")] + [_packed(rest["at"][sure], rest["n"][sure], SURE)])
        mark = of_seed & (texts[seed] > 1)
        zero = np.zeros(int(mark.sum()), np.int64)
        columns.append([rest["seed"][mark], zero, zero, rest["row"][mark], _packed(texts[texts > 1], zero, MARK)])
    return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*columns)], ["seed", "text", "id", "row", "at"])


def _settled(w: dict[str, np.ndarray], split: int) -> pa.RecordBatch:
    """Columns (kind, a, b, seed) for complete seeds: later occurrences of equal windows
    are REMOVED (row, place); of seeds with several window texts one occurrence each is
    ASKED for (row, place, seed); MANY (seed, texts) of seeds that are to be split."""
    out = []

    def add(kind: int, a: np.ndarray, b: np.ndarray, seed: np.ndarray | int = 0) -> None:
        out.append([np.full(len(a), kind, np.int64), a, b, np.broadcast_to(np.asarray(seed, np.int64), a.shape)])

    place = lambda pick: w["at"][pick] >> 10 << RUN | w["at"][pick] & 255
    kind = w["at"] >> 8 & 3
    later, sure = kind == LATER, kind == SURE
    add(REMOVED, w["row"][later], place(later))
    add(ASKED, w["row"][sure], place(sure), w["text"][sure])
    w = {k: v[~(later | sure)] for k, v in w.items()}
    order = _ordered(w)
    w = {k: v[order] for k, v in w.items()}
    mark = (w["at"] >> 8 & 3) == MARK
    of_seed = _changes(w["seed"])
    seeds, number = w["seed"][of_seed], np.cumsum(of_seed) - 1
    new = ~mark & _changes(w["seed"], w["text"], mark)
    texts = np.bincount(number, new, len(seeds)).astype(np.int64)
    marks = np.bincount(number, mark, len(seeds)) > 0
    again = ~mark & ~new
    add(REMOVED, w["row"][again], place(again))
    ask = new & ((texts > 1) | marks)[number]
    add(ASKED, w["row"][ask], place(ask), w["seed"][ask])
    texts += np.bincount(number, np.where(mark, w["at"] >> 10, 0), len(seeds)).astype(np.int64)
    add(MANY, seeds[texts > split], texts[texts > split])
    return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["kind", "a", "b", "seed"])


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows at the places asked for: of rows (id, row, places, text)."""
    for chunk in chunks(batches):
        ident, row, places, text = chunk.columns
        number = np.repeat(np.arange(chunk.num_rows), places.value_lengths().to_numpy(zero_copy_only=False))
        seed, b = places.flatten().flatten()
        at, n = b.to_numpy() >> RUN, b.to_numpy() & (1 << RUN) - 1
        raw, last, out = b"", -1, []
        for i, a, z in zip(number.tolist(), at.tolist(), (at + n - 1 + LENGTH).tolist()):
            if i != last:
                raw, last = text[i].as_py().encode(), i
            out.append(raw[a:z])
        columns = [seed, *(c.take(pa.array(number)) for c in (ident, row)), pa.array(at), pa.array(n), pa.array(out, pa.binary())]
        yield pa.record_batch(columns, ["seed", "id", "row", "at", "n", "bytes"])


def _by_group(batches: Iterable[pa.RecordBatch], keys: int, least: int, weigh) -> Iterator[pa.RecordBatch]:
    """Batches of complete groups, whose first ``keys`` columns are sorted and equal, with
    at least ``least`` by ``weigh``, a function of the rows."""
    held, weight = [], 0
    for batch in batches:
        held.append(batch)
        weight += weigh(batch)
        if weight < least:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        change = np.flatnonzero(_changes(*(whole.column(i).to_numpy(zero_copy_only=False) for i in range(keys))))
        if change[-1] > 0:
            yield whole.slice(0, change[-1])
            whole = whole.slice(change[-1])
        held, weight = [whole], weigh(whole)
    if held:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()
        if whole and whole[0].num_rows:
            yield whole[0]


def transform(sign: np.ndarray, before: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's suffixes in order of their first LENGTH / SIGN signs, and the signs before
    them: its Burrows-Wheeler transform. ``follow`` is the suffix one sign on."""
    bits = int(sign.max(initial=0)).bit_length()
    key, width, at = sign.astype(np.int64), bits, follow
    for _ in range(LENGTH // SIGN - 1):  # as many signs as fit become one key, then its rank
        if width + bits > 63:
            key = np.unique(key, return_inverse=True)[1]
            width = int(key.max(initial=0)).bit_length()
        key, width, at = key << bits | sign[at], width + bits, follow[at]
    order = np.argsort(key)
    return order, before[order]


def _bucketed(sign: np.ndarray) -> np.ndarray:
    """Stable order by sign, in two passes over 16 bits."""
    order = np.argsort(sign.astype(np.uint16), kind="stable")
    if len(sign) and sign.max() >> 16:
        order = order[np.argsort((sign[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def merge(shards: list[np.ndarray], ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' suffixes in common order (a shard's number for each
    place), and a number for each place's block: same block, same LENGTH bytes ahead.
    ``shards`` are transforms with 0 for none, ``ends`` how many empty suffixes each has."""
    mix = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s) for s in shards])
    empty = np.repeat(np.arange(len(shards), dtype=np.uint8), ends)
    block = np.zeros(len(mix), np.int32)
    sign = np.empty(len(mix), np.int64)
    for _ in range(LENGTH // SIGN):
        for k, own in enumerate(shards):
            sign[mix == k] = own
        order = _bucketed(sign)
        mix, moved, sorted_block = mix[order], sign[order], block[order]
        border = np.ones(len(order), bool)
        border[1:] = (moved[1:] != moved[:-1]) | (sorted_block[1:] != sorted_block[:-1])
        border[1 : len(empty)] = False  # empty suffixes are all alike
        mix[: len(empty)] = empty
        block = np.cumsum(border, dtype=np.int32)
    return mix, block


def repeated(texts: list[bytes], starts: np.ndarray, shards: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For windows with so many starts each: (window, start in it, block) of every string
    of LENGTH bytes, and a hash of each. A string with a sign that occurs once is alone and
    has a block of its own; only signs of the other strings go through the transforms."""
    sizes = np.array([len(t) for t in texts], np.int64)
    line = np.frombuffer(b"".join(texts), np.uint8)
    prefix = _prefix_hash(line)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(line)) - begin[owner]
    full = np.flatnonzero(inside <= sizes[owner] - SIGN)
    number = pa.array(_slice_hash(prefix, full, full + SIGN)).dictionary_encode().indices.to_numpy()
    sign = np.zeros(len(line), np.int64)
    sign[full] = number
    often = np.zeros(len(line), bool)
    often[full] = np.bincount(number)[number] > 1
    start = np.flatnonzero(inside < starts[owner])
    shared = often[start]
    for k in range(SIGN, LENGTH, SIGN):
        shared &= often[start + k]
    start, alone = start[shared], start[~shared]
    # A suffix begins at every sign of these strings, and an empty one ends each run of signs.
    needed = np.zeros(len(line) + SIGN, bool)
    for k in range(0, LENGTH, SIGN):
        needed[start + k] = True
    place = np.flatnonzero(needed)
    entry = np.cumsum(needed) - 1
    used = np.zeros(len(line) + 1, bool)
    used[sign[place]] = True
    sign[place] = np.cumsum(used)[sign[place]]  # from 1 on, 0 is none
    of = owner[place]
    goes = needed[place + SIGN] & (np.r_[owner, np.full(SIGN, -1)][place + SIGN] == of)
    came = needed[place - SIGN] & (owner[place - SIGN] == of) & (place >= SIGN)
    before = np.where(came, sign[place - SIGN], 0)
    cuts = np.searchsorted(of, np.linspace(0, len(texts), min(shards, len(texts)) + 1).astype(np.int64))
    where, transforms, ends = [], [], []
    for a, z in zip(cuts, cuts[1:]):
        end = a + np.flatnonzero(~goes[a:z])
        own = np.r_[sign[place[a:z]], np.zeros(len(end), np.int64)]
        follow = np.arange(len(own))
        on = np.flatnonzero(goes[a:z])
        follow[on] = entry[place[a + on] + SIGN] - a
        follow[end - a] = z - a + np.arange(len(end))
        order, signs = transform(own, np.r_[before[a:z], sign[place[end]]], follow)
        where.append(np.r_[place[a:z], np.full(len(end), len(line))][order])
        transforms.append(signs)
        ends.append(len(end))
    mix, block = merge(transforms, ends)
    suffix = np.empty(len(mix), np.int64)
    for k, at in enumerate(where):
        suffix[mix == k] = at
    valid = np.zeros(len(line) + 1, bool)
    valid[start] = True
    valid = valid[suffix]
    suffix = np.r_[suffix[valid], alone]
    block = np.r_[block[valid], len(mix) + 1 + np.arange(len(alone))]
    return owner[suffix], inside[suffix], block, _slice_hash(prefix, suffix, suffix + LENGTH)


def _runs(row: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of starts (document, first, number) that go on from one another as one."""
    order = np.lexsort((at, row))
    row, at, n = row[order], at[order], n[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + n[:-1])
    first = np.flatnonzero(new)
    return row[first], at[first], np.add.reduceat(n, first) if len(first) else n


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Windows of complete seeds (or parts of split ones) to removed starts, and for split
    seeds one occurrence of every string."""
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
    texts, known = batch.column(6).to_pylist(), set()
    order = np.lexsort((columns[4], columns[3], columns[2])).tolist()
    # Equal windows (from other chunks) are one string to the transforms, the first.
    kept = [i for i in order if (text := (columns[1][i], texts[i])) not in known and not known.add(text)]
    later = np.setdiff1d(order, kept, assume_unique=True)
    again = [columns[3][later], columns[4][later], columns[5][later]]
    seed, part, ident, row, at, n = (c[kept] for c in columns)
    owner, inside, block, hashes = repeated([texts[i] for i in kept], n)
    where = at[owner] + inside
    # Strings that are alone say something only where a seed is split.
    keep = (np.bincount(block)[block] > 1) | (part[owner] >= 0)
    owner, where, block, hashes = owner[keep], where[keep], block[keep], hashes[keep]
    order = np.lexsort((where, row[owner], ident[owner], block))
    owner, where, block, hashes = owner[order], where[order], block[order], hashes[order]
    first = _changes(block)
    single = [row[owner[~first]], where[~first], np.ones(int((~first).sum()), np.int64)]
    r, a, m = _runs(*(np.concatenate(c) for c in zip(single, again)))
    split = first & (part[owner] >= 0)
    zero = np.zeros(len(r), np.int64)
    o = owner[split]
    columns = [
        np.r_[zero, np.ones(len(o), np.int64)], np.r_[zero, hashes[split].view(np.int64)], np.r_[zero, seed[o]], np.r_[zero, ident[o]],
        np.r_[r, row[o]], np.r_[a << RUN | m, where[split] << RUN | 1],
    ]
    return pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["split", "hash", "seed", "id", "row", "b"])


def _named(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the boolean ``named``: whether ``found`` may have its row. Texts of the
    others need not be shuffled to be joined with it."""
    slot = F.pmod(F.xxhash64("row"), F.lit(KEPT_BITS))
    return marked(docs, slot, found.select(slot.alias("slot")), "named")


def removed_starts(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """``docs`` (id, row, text) to (row, b): runs of starts whose string also starts
    earlier, b being the first start times 2^RUN plus their number."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield _hand_on(_chunk_windows(chunk))

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _by_group(batches, 1, 1 << 17, lambda b: b.num_rows):
            names = ("seed", "text", "id", "row", "at")
            yield _settled({k: whole.column(k).to_numpy(zero_copy_only=False) for k in names}, split)

    handed = docs.mapInArrow(scan, "seed long, text long, id long, row long, at long")
    # What only passes by spreads out.
    passing = F.col("at").bitwiseAND(0x300).isin(LATER << 8, SURE << 8)
    lane = F.when(passing, F.xxhash64("row", "at")).otherwise(F.col("seed"))
    dealt = handed.withColumn("seed", lane).repartition("seed").sortWithinPartitions("seed")
    settled = materialize(dealt.mapInArrow(settle, "kind long, a long, b long, seed long"), "settled")

    asked = settled.filter(F.col("kind") == ASKED).select(F.col("a").alias("row"), F.struct("seed", "b").alias("place"))
    places = materialize(asked.groupBy("row").agg(F.collect_list("place").alias("places")), "places")
    ident = F.coalesce("id", F.lit(-(1 << 63))).alias("id")
    told = _named(docs, places).filter("named").join(places, "row").select(ident, "row", "places", "text")
    found = told.mapInArrow(_cut_out, "seed long, id long, row long, at long, n long, bytes binary")
    many = settled.filter(F.col("kind") == MANY).select(F.col("a").alias("seed"), F.ceil(F.col("b") / split).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("row"), "parts"), F.lit(-1)).cast("long")
    found = found.join(many, "seed", "left").select("seed", part.alias("part"), "id", "row", "at", "n", "bytes")
    found = found.repartition("seed", "part").sortWithinPartitions("seed", "part")

    def merge_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (b.slice(i, GROUP >> 8) for b in batches for i in range(0, b.num_rows, GROUP >> 8))
        for whole in _by_group(small, 2, GROUP, lambda b: b.column(6).nbytes):
            yield _merged(whole)

    merged = materialize(found.mapInArrow(merge_groups, "split long, hash long, seed long, id long, row long, b long"), "merged")
    order = Window.partitionBy("seed", "hash").orderBy("id", "row", "b")  # one row per part of the seed
    apart = merged.filter("split = 1").withColumn("nth", F.row_number().over(order)).filter("nth > 1")
    return (
        settled.filter(F.col("kind") == REMOVED).select(F.col("a").alias("row"), "b")
        .unionByName(merged.filter("split = 0").select("row", "b"))
        .unionByName(apart.select("row", "b"))
    )


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256`` and, if asked for, ``kept`` (bytes, since a cut can fall
    inside a character).

    The key is an integer and orders the documents, a null one first; rows with one key
    are documents of their own, so a repeated row loses what it repeats. Null texts are
    empty; texts of fewer than LENGTH bytes lose nothing. Other columns are left out.
    The documents are written once with a row number, which ties removed starts to them.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("long").alias("id"), whole_text(text).alias("text"))
    rows = numbered(rows, "row").select("id", "row", "text")
    spans = materialize(removed_starts(rows).groupBy("row").agg(F.collect_list("b").alias("spans")), "spans")
    told = _named(rows, spans)
    joined = told.filter("named").join(spans, "row", "left").select("id", "spans", "text")
    rest = told.filter("not named").select("id", F.lit(None).cast("array<long>").alias("spans"), "text")
    joined = joined.unionByName(rest)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out = []
            for i, found, t in zip(*(c.to_pylist() for c in batch.columns)):
                raw, kept, n, end = t.encode(), [], 0, 0
                for b in sorted(found or ()):
                    a, z = b >> RUN, (b >> RUN) + (b & (1 << RUN) - 1) - 1 + LENGTH
                    if a > end or not n:
                        n += 1
                        kept.append(raw[end:a])
                    end = max(end, z)
                kept.append(raw[end:])
                rest = b"".join(kept)
                out.append((i, len(raw), len(raw) - len(rest), n, hashlib.sha256(rest).hexdigest(), rest)[: 6 if keep else 5])
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), types)]
            yield pa.record_batch(columns, names[: len(columns)])

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep
    return joined.mapInArrow(work, schema).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", key)
