"""SentencePiece encoding by a prefix table, and decoding.

The text gets a space in front, spaces become U+2581, and no entry holds that sign after
another character, so runs of it with what follows are encoded one by one. The same holds
around line breaks where no entry has one, and after a letter before punctuation that
follows a letter in no entry; both are read off the vocabulary. What a worker has met before comes from a
memory of bounded size. Characters outside the vocabulary fall back to their bytes.
"""

from __future__ import annotations

import hashlib
import re
import string
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import map_chunks, whole_text
from payscope.llm.prefix_bpe import Memory, PrefixTable

SPACE = "▁"
LETTER = r"[^\W\d_▁]"


class Codec:
    """Encodes as the library does with its default settings, without sampling."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        score, ids, self.byte = {}, {}, [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                ids[piece] = i
                score[piece] = -sp.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a vocabulary entry goes on past a space; words can't be split")
        self.ids = ids
        self.table = PrefixTable(ids, lambda a, b: score.get(a + b))
        letter = re.compile(LETTER)
        joined = {b for p in ids for a, b in zip(p, p[1:]) if letter.match(a)}
        stops = re.escape("".join(c for c in string.punctuation + "\n" if c not in joined))
        line = "" if any("\n" in p for p in ids) else "\n"
        self.words = re.compile(
            rf"{SPACE}*{LETTER}+(?=[{stops}])|{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (r"|\n+" if line else "")
        )
        self.memory = Memory(self.word)

    def word(self, word: str) -> tuple[int, ...]:
        out: list[int] = []
        for token in self.table.encode(word):
            i = self.ids.get(token)
            if i is None:
                out += [self.byte[b] for b in token.encode()]
            else:
                out.append(i)
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        memory, ids = self.memory, []
        for word in self.words.findall(SPACE + text.replace(" ", SPACE)):
            ids += memory.new.get(word) or memory.missed(word)
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker."""
    return Codec(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(key, ids): the ids of every text; with ``decoded`` also the text they decode to.
    Null and empty texts have no ids and decode to an empty one; a repeated row is encoded
    again; other columns are left out."""
    kind = docs.schema[key].dataType

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        ids = [own.encode(t) for t in batch.column(1).to_pylist()]
        back = [pa.array(map(own.decode, ids), pa.string())] if decoded else []
        return pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32())), *back], ["key", "ids", "decoded"][: 2 + decoded])

    schema = f"key {kind.simpleString()}, ids array<int>" + ", decoded string" * decoded
    slim = docs.select(F.col(key), whole_text(text))
    return map_chunks(slim, work, schema).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of ids, their SHA-256 as decimals joined by commas, the SHA-256
    of the decoded text, and whether that is the text itself. Ids never leave the task."""
    kind = docs.schema[key].dataType

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        n, ids_sha, text_sha, same = [], [], [], []
        for t in batch.column(1).to_pylist():
            ids = own.encode(t)
            back = own.decode(ids)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(back.encode()).hexdigest())
            same.append(back == t)
        return pa.record_batch(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
            ["key", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"],
        )

    schema = f"key {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    slim = docs.select(F.col(key), whole_text(text))
    return map_chunks(slim, work, schema).withColumnRenamed("key", key)
