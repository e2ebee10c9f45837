"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage of the whole
text is encoded; a gated attention (tanh times sigmoid) weighs the passages; the weighted
passage representation is scored. Encoder, attention and scorer are learned together from
the labels of a bounded sample of documents, by gradient descent in numpy on the driver;
scoring runs in the tasks, on every document.

A passage's input is how often one kind of byte follows another (letters by case and
sound, digits, spaces, kinds of punctuation), how long it and its words are, how often
a word repeats the one before, and which words it has, hashed. Nothing but the text goes in.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import chunks, fresh, whole_text

#: Words of a passage; labelled documents learned from, at most; passages that one of
#: them may have (longer ones are not learned from, but scored as any). The sample is
#: thus at most 150 MB on the driver, and some 25 MB where documents are of usual length.
PASSAGE_WORDS, SAMPLE, SAMPLE_PASSAGES = 64, 4000, 48
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 32, 16, 20, 64, 3e-3, 1e-4
WORD_BUCKETS = 128
_KINDS = [b" ", b"\t\n\r\x0b\x0c", b"0123456789", b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"AEIOUBCDFGHJKLMNPQRSTVWXYZ",
          b".,;:", b"!?", b"$&*%#", b"|", b"\"'`", b"()[]{}<>", b"-_/\\+=~^@"]
KIND = np.full(256, len(_KINDS), np.int64)
for _i, _bytes in enumerate(_KINDS):
    KIND[list(_bytes)] = _i
KIND[128:192], KIND[192:] = len(_KINDS) + 1, len(_KINDS) + 2
PAIRS = 16
INPUTS = PAIRS * PAIRS + 4 + WORD_BUCKETS


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The passages' inputs, and each text's first passage; a text without words has one
    passage, of zeros if it is empty."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.cumsum(sizes) - sizes
    line = np.frombuffer(b"".join(texts), np.uint8)
    kind = KIND[line]
    first = np.zeros(len(line) + 1, bool)
    first[offset] = True
    first = first[:-1]
    space = kind < 2
    word = np.flatnonzero(~space & (np.r_[True, space[:-1]] | first)) if len(line) else np.zeros(0, np.int64)
    of = np.searchsorted(offset, word, "right") - 1
    # An empty text shares its offset with the next one; the last of them owns the words.
    rank = np.arange(len(word)) - np.searchsorted(word, offset)[of]
    cut = word[(rank % PASSAGE_WORDS == 0) & (rank > 0)]
    start = np.sort(np.concatenate((offset, cut)))
    head = np.searchsorted(start, offset) + (np.arange(len(texts)) - np.searchsorted(offset, offset))
    length = np.diff(np.r_[start, len(line)])
    n = len(start)
    own = np.repeat(np.arange(n), length)
    x = np.zeros((n, INPUTS), np.float32)
    if len(line) > 1:
        key = own[:-1] * PAIRS * PAIRS + kind[:-1] * PAIRS + kind[1:]
        x[:, : PAIRS * PAIRS] = np.bincount(key[own[:-1] == own[1:]], minlength=n * PAIRS * PAIRS).reshape(n, -1)
    words = np.bincount(own[word], minlength=n) if len(word) else np.zeros(n)
    hashed = np.fromiter((zlib.crc32(w) for t in texts for w in t.lower().split()), np.int64, len(word))
    at = np.repeat(np.arange(n), words.astype(np.int64))
    x[:, -WORD_BUCKETS:] = np.bincount(at * WORD_BUCKETS + hashed % WORD_BUCKETS, minlength=n * WORD_BUCKETS).reshape(n, -1)
    again = np.bincount(at[1:][(hashed[1:] == hashed[:-1]) & (at[1:] == at[:-1])], minlength=n)
    x[:, : PAIRS * PAIRS] /= np.maximum(length, 1)[:, None]
    x[:, -WORD_BUCKETS:] /= np.maximum(words, 1)[:, None]
    np.sqrt(x, out=x)
    x[:, PAIRS * PAIRS] = np.log1p(length) / 8
    x[:, PAIRS * PAIRS + 1] = np.log1p(words) / 5
    x[:, PAIRS * PAIRS + 2] = length / np.maximum(words, 1) / 10
    x[:, PAIRS * PAIRS + 3] = again / np.maximum(words, 1)
    x[length == 0] = 0
    return x, head


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


class Model:
    """Parameters ``p`` and the two directions through them."""

    def __init__(self, seed: int = 7, prior: float = 0.0):
        rng = np.random.default_rng(seed)
        scale = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {
            "encode": scale(INPUTS, HIDDEN), "shift": np.zeros(HIDDEN, np.float32),
            "tanh": scale(HIDDEN, GATE), "gate": scale(HIDDEN, GATE), "weigh": scale(GATE, 1)[:, 0],
            "score": scale(HIDDEN, 1)[:, 0], "bias": np.float32([prior]),
        }

    def forward(self, x: np.ndarray, head: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        f = {"h": np.maximum(x @ p["encode"] + p["shift"], 0)}
        f["t"], f["g"] = np.tanh(f["h"] @ p["tanh"]), _sigmoid(f["h"] @ p["gate"])
        a = (f["t"] * f["g"]) @ p["weigh"]
        f["n"] = np.diff(np.r_[head, len(x)])
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, head), f["n"]))
        f["a"] = a / np.repeat(np.add.reduceat(a, head), f["n"])
        f["z"] = np.add.reduceat(f["h"] * f["a"][:, None], head)
        f["y"] = _sigmoid(f["z"] @ p["score"] + p["bias"][0])
        return f

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """A few hundred kilobytes at a time, or one longer text."""
        out, start, size = [np.zeros(0)], 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > 1 << 19:
                out.append(self.forward(*passages(texts[start:i]))["y"])
                start, size = i, 0
            size += len(t)
        if start < len(texts):
            out.append(self.forward(*passages(texts[start:]))["y"])
        return np.concatenate(out)

    def gradient(self, x: np.ndarray, head: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, head)
        dy = (f["y"] - label) / len(label)
        dz = np.repeat(dy[:, None] * p["score"], f["n"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        da = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, head), f["n"]))
        dt = da[:, None] * p["weigh"] * f["g"] * (1 - f["t"] ** 2)
        dg = da[:, None] * p["weigh"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (dz * f["a"][:, None] + dt @ p["tanh"].T + dg @ p["gate"].T) * (f["h"] > 0)
        return {
            "encode": x.T @ dh, "shift": dh.sum(axis=0), "tanh": f["h"].T @ dt, "gate": f["h"].T @ dg,
            "weigh": (f["t"] * f["g"]).T @ da, "score": f["z"].T @ dy, "bias": np.array([dy.sum()]),
        }

    def fit(self, bags: list[np.ndarray], label: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                part = order[at : at + BATCH]
                sizes = np.array([len(bags[i]) for i in part])
                grad = self.gradient(np.concatenate([bags[i] for i in part]), np.cumsum(sizes) - sizes, label[part])
                step += 1
                for k, g in grad.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    move = RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = (self.p[k] * (1 - RATE * DECAY) - move).astype(np.float32)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from; a null key never has a label."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from up to ``sample`` labelled documents outside the held-out rows, picked by
    a hash of the key. Several labels of one key count by majority, a tie as 1; null ones
    don't count, nor do texts of more than ``SAMPLE_PASSAGES`` passages. Without
    any label every score is 0.5; with one class only it is near that class's.
    """
    chosen = (
        labels.filter(~held_out(key)).dropna(subset=[key, label]).groupBy(F.col(key).alias("id"))
        .agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    named = docs.select(F.col(key).alias("id"), whole_text(text).alias("text"))
    rows = named.join(F.broadcast(chosen), "id").select("id", "label", "text")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x, head = passages([t.encode() for t in batch.column(2).to_pylist()])
            bags = [b for b in np.split(x, head[1:])]
            small = pa.array([len(b) <= SAMPLE_PASSAGES for b in bags])
            data = pa.array([b.astype(np.float16).tobytes() if len(b) <= SAMPLE_PASSAGES else b"" for b in bags], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), data], ["id", "label", "bag"]).filter(small)

    kind = labels.schema[key].dataType.simpleString()
    # A key that comes up more than once in the documents counts once.
    found = rows.mapInArrow(work, f"id {kind}, label int, bag binary").orderBy(F.xxhash64("id"), "id", "bag").limit(sample).toArrow()
    bags = [np.frombuffer(b, np.float16).reshape(-1, INPUTS).astype(np.float32) for b in found["bag"].to_pylist()]
    label_of = np.array(found["label"].to_pylist(), np.float32)
    if not bags:
        model = Model()
        model.p["score"] *= 0
        return model
    share = float(np.clip(label_of.mean(), 0.01, 0.99))
    model = Model(prior=np.log(share / (1 - share)))
    model.fit(bags, label_of)
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row; null texts are empty, an empty one is scored by its one
    blank passage; repeated rows score alike; other columns are left out."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            y = shared.value.scores([t.encode() for t in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(y.astype(np.float64))], ["key", "score"])

    slim = docs.select(F.col(key), whole_text(text))
    return slim.mapInArrow(work, f"key {kind}, score double").withColumnRenamed("key", key)


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``least``, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = fresh(docs, "_body")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            y = shared.value.scores([t.encode() for t in batch.column(batch.num_columns - 1).to_pylist()])
            kept = batch.select(range(batch.num_columns - 1)).filter(pa.array(y >= least))
            yield kept

    return docs.withColumn(body, whole_text(text)).mapInArrow(work, docs.schema)
