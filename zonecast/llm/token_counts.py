"""Token counts by rank-synchronous array merging (operator 5).

The pre-tokens of a batch that a worker has not met are held as one ragged
numpy array of symbols. Each round finds the lowest-rank pair of every
sequence, applies it at once in all sequences, and drops sequences that have
no pair left; the surviving symbols are the count.

The text rules are those of the tokenizer file: NFC, lower case, white space
dropped, byte-level symbols, an end-of-word mark. Special token strings inside
a text count as one token each and separate what stands beside them.

Defined results: null or empty text has 0 bytes and 0 tokens; one very long
pre-token is merged like any other; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import map_batches
from zonecast.llm.bpe_codec import _WS

_CHUNK = re.compile(rf"[^{_WS}]+")
#: Chunks that a worker remembers at once.
KEEP = 400_000
_counters: dict[str, Counter] = {}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a
    visible Latin-1 character, else the next free code point from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in visible else next(rest)) for b in range(256)]


class Counter:
    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        names = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in names], dtype=np.int64)
        self.final = np.array([vocab.get(s + self.end, -1) for s in names], dtype=np.int64)
        self.width = len(vocab) + 1
        keys, made = [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            keys.append(vocab[a] * self.width + vocab[b])
            made.append(vocab[a + b])
        keys = np.array(keys, dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), np.array(made, dtype=np.int64)[order]
        self.specials = re.compile("|".join(re.escape(t["content"]) for t in spec.get("added_tokens", [])) or "(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def surviving(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece after all merges."""
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        out = length.copy()
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbol, owner = self.inner[data], np.repeat(np.arange(len(pieces)), length)
        last = np.cumsum(length) - 1
        symbol[last[length > 0]] = self.final[data[last[length > 0]]]
        while len(symbol) > 1:
            key = symbol[:-1] * self.width + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.rank[at], len(self.keys))
            rank = np.append(rank, len(self.keys))  # one for each symbol; the last has no right neighbour
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(owner)))
            go = np.repeat(low < len(self.keys), size)
            hit = go & (rank == np.repeat(low, size))
            if not hit.any():
                break
            # of touching hits (a pair of equal symbols) every second one counts, from the left
            spot = np.flatnonzero(hit)
            run = np.append(True, np.diff(spot) > 1)
            place = np.arange(len(spot)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            spot = spot[place % 2 == 0]
            symbol[spot] = self.made[at[spot]]
            gone = np.zeros(len(symbol), dtype=bool)
            gone[spot + 1] = True
            np.subtract.at(out, owner[spot], 1)
            keep = go & ~gone  # sequences without a pair are done
            symbol, owner = symbol[keep], owner[keep]
        return out

    def pieces(self, chunk: str) -> list[bytes]:
        """Pre-tokens of a chunk without white space."""
        norm = "".join(c.lower() for c in unicodedata.normalize("NFC", chunk))
        return [m.encode() for m in self.pattern.findall(norm)]

    def learn(self, chunks: set[str]) -> dict[str, int]:
        """Counts of chunks that are not known yet, in one batched merge."""
        todo, counts, parts, owner = [], {}, [], []
        for c in chunks:
            if c in self.older:
                counts[c] = self.older[c]
            else:
                todo.append(c)
        for i, c in enumerate(todo):
            own = self.pieces(c)
            parts += own
            owner += [i] * len(own)
        total = np.zeros(len(todo), dtype=np.int64)
        if parts:
            np.add.at(total, np.array(owner), self.surviving(parts))
        counts.update(zip(todo, total.tolist(), strict=True))
        if len(self.known) + len(counts) > KEEP:
            self.older, self.known = self.known, {}
        self.known.update((c, n) for c, n in counts.items() if len(c) <= 64)
        return counts

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        found, extra = [], []
        for t in texts:
            t = t or ""
            n = 0
            if "<|" in t:
                n = len(self.specials.findall(t))
                t = self.specials.sub(" ", t)
            found.append(_CHUNK.findall(t))
            extra.append(n)
        known = self.known
        new = {c for f in found for c in f if c not in known}
        if new:
            late = self.learn(new)
            look = lambda c: late[c] if c in late else known[c]
            return [n + sum(map(look, f)) for n, f in zip(extra, found, strict=True)]
        return [n + sum(map(known.__getitem__, f)) for n, f in zip(extra, found, strict=True)]


def counter(path: str) -> Counter:
    if path not in _counters:
        with open(path if "/" in path else SparkFiles.get(path), encoding="utf-8") as f:
            _counters[path] = Counter(json.load(f))
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text. One narrow pass."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(c.count(texts), type=pa.int64())],
                    names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), size)
    return (map_batches(texts, work, f"id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit)
            .withColumnRenamed("id", id_col))
