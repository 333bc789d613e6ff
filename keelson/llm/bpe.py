"""Byte-pair encoding with word ends, and decoding.

Each word is a doubly linked list of symbols; a priority queue holds the
ranked merges of neighbours, and an entry whose symbols have changed since
is skipped when it comes up. Decoding concatenates the vocabulary's strings
(this tokenizer file names no decoder, so its library joins them by a space).

The tokenizer file is a parameter. The driver reads it once and broadcasts
its 49,408 entries (a fixed size), so executors need no copy of the file.

Letters and numbers are those of the ``regex`` module's Unicode version; the
few characters that a later or earlier version calls letters may be split
otherwise than by a library built with that version.

Cases: a null text is encoded as an empty one (no ids); texts of any length
are encoded whole (a word of n symbols takes O(n log n)); repeated rows are
encoded one by one; an empty table gives an empty table; ``encode_documents``
returns the id column and the results only, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unicode white space; it separates words and is dropped.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return [table[b] for b in range(256)]


class WordBpe(dict):
    """word -> its ids as little-endian unsigned 32-bit integers, remembered
    for words met lately (at most ``limit``; words over 64 characters never)."""

    def __init__(self, spec: dict, limit: int = 300_000):
        super().__init__()
        model = spec["model"]
        self.limit = limit
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: (left id, right id) -> (rank, merged id)
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b])
                       for rank, (a, b) in enumerate(pairs)}
        self.strings = {i: s for s, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: s for s, i in self.special.items()})
        self.special_re = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.last = [self.vocab[s + self.end] for s in symbols]

    def __missing__(self, word: str) -> bytes:
        ids = self.merge_word(word.encode("utf-8"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = packed
        return packed

    def merge_word(self, data: bytes) -> list[int]:
        """Ids of one word by lowest-rank merges, leftmost first on ties."""
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        merges = self.merges
        queue = []
        for i in range(n - 1):
            if (m := merges.get((ids[i], ids[i + 1]))) is not None:
                queue.append((m[0], i, m[1]))
        heapq.heapify(queue)
        while queue:
            rank, i, merged = heapq.heappop(queue)
            j = after[i]
            # stale: a symbol here was merged away or changed since
            if ids[i] < 0 or j < 0 or merges.get((ids[i], ids[j]), (-1, -1)) != (rank, merged):
                continue
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (m := merges.get((merged, ids[k]))) is not None:
                    heapq.heappush(queue, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], merged))) is not None:
                heapq.heappush(queue, (m[0], h, m[1]))
        return [x for x in ids if x >= 0]

    def _ordinary(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower-cased letter by letter: no final sigma
            text = text.replace("Σ", "σ")
        return b"".join(map(self.__getitem__, WORDS.findall(text.lower())))

    def encode(self, text: str | None) -> bytes:
        """All ids of a text, packed. A special token's string is that token."""
        if not text:
            return b""
        if "<|" not in text:
            return self._ordinary(text)
        return b"".join(struct.pack("<I", self.special[part]) if part in self.special
                        else self._ordinary(part)
                        for part in self.special_re.split(text) if part)

    def decode(self, ids) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def encode_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text; with
    ``ids`` also the ids themselves and the decoded text."""
    spec = df.sparkSession.sparkContext.broadcast(load(path or default_path()))
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if ids:
        schema += ", ids array<long>, decoded string"

    @F.pandas_udf(schema)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = WordBpe(spec.value)
        for texts in batches:
            rows = []
            for value in texts:
                packed = bpe.encode(value)
                numbers = np.frombuffer(packed, dtype="<u4").tolist()
                decoded = bpe.decode(numbers)
                row = [len(numbers), hashlib.sha256(packed).hexdigest(),
                       hashlib.sha256(decoded.encode("utf-8")).hexdigest()]
                rows.append((*row, numbers, decoded) if ids else row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return df.select(F.col(doc_id), encode(F.col(text)).alias("encoded")).select(
        F.col(doc_id), "encoded.*")
