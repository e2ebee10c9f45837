"""Token counts of byte-level BPE, at every prefix.

The text splits into words by the vocabulary's pattern; a prefix table gives the number
of tokens at every prefix of a word, so a running sum gives it for every prefix of the
text (split as the whole text is). That answers how many tokens a text has, whether it
stays within a budget, and where to cut it, with no second encoding.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import map_chunks, whole_text
from payscope.llm.prefix_bpe import Memory, PrefixTable

#: The split pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in such a vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.table = PrefixTable(spec["model"]["vocab"], lambda a, b: ranks.get((a, b)))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = regex.compile(PATTERN, regex.V0)
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.memory = Memory(self.word, 500_000)

    def spelled(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)

    def word(self, word: str) -> int:
        return self.table.counts(self.spelled(word))[-1]

    def parts(self, text: str):
        """Stretches of plain text and special strings in turn; the latter are one token."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield text[at : m.start()], m.group()
            at = m.end()
        yield text[at:], ""

    def count(self, text: str) -> int:
        memory, n = self.memory, 0
        for plain, special in self.parts(text):
            for w in self.words.findall(plain):
                n += memory.new.get(w) or memory.missed(w)
            n += bool(special)
        return n

    def prefix_counts(self, text: str) -> list[int]:
        """Number of tokens at every prefix in UTF-8 bytes, the empty one first. Inside a
        special string the count is that before it."""
        out = [0]
        for plain, special in self.parts(text):
            for w in self.words.findall(plain):
                base = out[-1]
                out += [base + c for c in self.table.counts(self.spelled(w))[1:]]
            if special:
                out += [out[-1]] * (len(special.encode()) - 1) + [out[-1] + 1]
        return out

    def cut(self, text: str, limit: int) -> int:
        """Bytes of the longest prefix of whole characters with no more tokens than
        ``limit``. Word counts lead to the word that crosses it; its own table gives the
        place within."""
        at = n = 0
        for plain, special in self.parts(text):
            for w in self.words.findall(plain):
                size, more = len(w.encode()), self.memory.new.get(w) or self.memory.missed(w)
                if n + more > limit:
                    counts = self.table.counts(self.spelled(w))
                    raw = w.encode()
                    whole = [i for i in range(size) if raw[i] & 0xC0 != 0x80 and n + counts[i] <= limit]
                    return at + whole[-1]
                at, n = at + size, n + more
            if special:
                if n + 1 > limit:
                    return at
                at, n = at + len(special.encode()), n + 1
        return at


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per Python worker."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its bytes, its tokens, whether they exceed ``limit``, and how many bytes
    stay when it is cut to the limit. Null and empty texts have no tokens; a repeated row
    counts again; other columns are left out."""
    kind = docs.schema[key].dataType

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        size, n, cut = [], [], []
        for t in batch.column(1).to_pylist():
            size.append(len(t.encode()))
            n.append(own.count(t))
            cut.append(own.cut(t, limit) if n[-1] > limit else size[-1])
        columns = [batch.column(0), *(pa.array(v, pa.int64()) for v in (size, n, cut))]
        return pa.record_batch(columns, ["key", "n_bytes", "n_tokens", "cut_bytes"])

    schema = f"key {kind.simpleString()}, n_bytes long, n_tokens long, cut_bytes long"
    counted = map_chunks(docs.select(F.col(key), whole_text(text)), work, schema)
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cut_bytes")
