"""Byte-level BPE by prefix dynamic programming (operator 3).

For every prefix of a pre-token there is exactly one token that can end its
encoding. The encoder stores that token per prefix: a token fits at the end of
a prefix when it and the last token of the shorter prefix before it are a
stable pair (merging their bytes gives the same two tokens back). Appending
bytes extends the list, an edit recomputes it from the edit on and stops when
it agrees with the old list again (``Codec.append``, ``Codec.edit``).

Texts are cut into units (a run without white space with at most one blank in
front, or white space); the pattern never matches across them, so a unit's ids
are kept in a bounded table inside each Python worker.

Defined results: null text counts as empty and has no ids; white space only,
very long texts and repeated rows are ordinary texts; an empty table gives an
empty result; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import list_array, map_batches

#: Code points with the White_Space property.
_WS = "\t-\r \x85\xa0  -     　"
_UNIT = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Units and token pairs that a worker remembers at once.
KEEP = 400_000
#: Texts that a task encodes at once.
ROWS = 1024
_codecs: dict[tuple[str, str], Codec] = {}


class Codec:
    def __init__(self, lines: list[bytes], pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, self.ranks), default=1)
        self.size = max(self.ranks.values(), default=0) + 1
        self.of = [b""] * self.size
        for k, v in self.ranks.items():
            self.of[v] = k
        lengths = np.array([len(x) for x in self.of], dtype=np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.flat = np.frombuffer(b"".join(self.of), dtype=np.uint8)
        self.ends: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, raw: bytes) -> list[bytes]:
        """Plain merging of a token's bytes, lowest rank first, down to two parts."""
        parts, get = [raw[i:i + 1] for i in range(len(raw))], self.ranks.get
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spines(self, token: int) -> tuple[list[tuple[bytes, int, int]], list[tuple[bytes, int, int]]] | None:
        """The (bytes, formed at, merged at) of the parts that stand at the right
        and at the left end of a token while its bytes merge; None for a token
        that its own bytes don't merge into."""
        if token in self.ends:
            return self.ends[token]
        raw, never = self.of[token], self.size
        out: tuple = ([(raw, token if len(raw) > 1 else -1, never)], [(raw, token if len(raw) > 1 else -1, never)])
        if len(raw) > 1:
            parts = self.merged(raw)
            sides = [self.spines(self.ranks[p]) for p in parts] if len(parts) == 2 else [None]
            if None in sides:
                out = None
            else:
                for k, inner in ((0, sides[1][0]), (1, sides[0][1])):
                    out[k].extend((p, f, token if m == never else m) for p, f, m in inner)
        self.ends[token] = out
        return out

    def whole(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token."""
        return self.spines(token) is not None

    def follows(self, a: int, b: int) -> bool:
        """Whether token b can stand after token a: no part at the right end of
        a merges with one at the left end of b while both are there (of equal
        ranks the left one merges first)."""
        key = a * self.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 3 * KEEP:
                self.pairs.clear()
            get, known = self.ranks.get, True
            left = self.spines(b)[1]
            for x, formed_x, until_x in self.spines(a)[0]:
                for y, formed_y, until_y in left:
                    r = get(x + y)
                    if r is not None and (at := max(r, formed_x, formed_y)) < until_x and at <= until_y:
                        known = False
            self.pairs[key] = known
        return known

    def prefixes(self, raw: bytes, last: list[int] | None = None) -> list[int]:
        """The last token of the encoding of each prefix raw[:1], raw[:2], ...;
        ``last`` holds those already known."""
        last = [] if last is None else last
        get, longest = self.ranks.get, self.longest
        for end in range(len(last) + 1, len(raw) + 1):
            for start in range(max(0, end - longest), end):
                token = get(raw[start:end])
                if token is not None and self.whole(token) and (not start or self.follows(last[start - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no encoding of {raw[:end]!r}: the vocabulary lacks a byte")
        return last

    def append(self, raw: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """Exact append: only the new prefixes are computed."""
        return raw + more, self.prefixes(raw + more, list(last))

    def edit(self, raw: bytes, last: list[int], at: int, cut: int, put: bytes) -> tuple[bytes, list[int]]:
        """raw[at:at+cut] replaced by put. Work stops once a whole token length
        of prefixes agrees with the old list: from there on both are equal."""
        new = raw[:at] + put + raw[at + cut:]
        out, shift, same = list(last[:at]), len(put) - cut, 0
        while len(out) < len(new):
            self.prefixes(new[:len(out) + 1], out)
            i = len(out) - 1
            tail = i - shift >= at + cut and i >= at + len(put)
            same = same + 1 if tail and out[i] == last[i - shift] else 0
            if same >= self.longest:
                out += last[i - shift + 1:]
        return new, out

    def tokens(self, last: list[int]) -> list[int]:
        """Walks back from the last prefix."""
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.of[ids[-1]])
        return ids[::-1]

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token is that token."""
        whole = self.ranks.get(raw)
        return [whole] if whole is not None else self.tokens(self.prefixes(raw))

    def learn(self, units: set[str]) -> dict[str, bytes]:
        """Ids of units that are not known yet, as int32 bytes. Their pieces are
        taken in byte order, so that each keeps the prefixes it shares with the
        piece before it and only appends the rest."""
        got = {u: self.older[u] for u in units if u in self.older}
        cut = {u: [m.encode() for m in self.pattern.findall(u)] for u in units if u not in got}
        ids: dict[bytes, list[int]] = {}
        before, last = b"", []
        for raw in sorted({p for own in cut.values() for p in own}):
            whole = self.ranks.get(raw)
            if whole is not None:
                ids[raw] = [whole]
                continue
            same, most = 0, min(len(before), len(raw))
            while same < most and before[same] == raw[same]:
                same += 1
            before, last = raw, self.prefixes(raw, last[:same])
            ids[raw] = self.tokens(last)
        for u, own in cut.items():
            got[u] = array("i", [i for p in own for i in ids[p]]).tobytes()
        if len(self.units) + len(got) > KEEP:
            self.older, self.units = self.units, {}
        self.units.update((u, x) for u, x in got.items() if len(u) <= 64)
        return got

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        found = [_UNIT.findall(t) if t else [] for t in texts]
        known = self.units
        new = {u for f in found for u in f if u not in known}
        late = self.learn(new) if new else {}
        if not late:
            return [b"".join([known[u] for u in f]) for f in found]
        return [b"".join([late[u] if u in late else known[u] for u in f]) for f in found]

    def decode(self, ids: np.ndarray) -> bytes:
        length = self.lengths[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ids) else 0
        return self.flat[np.repeat(self.starts[ids] - ends + length, length) + np.arange(total)].tobytes()


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a rank file; ``path`` is a file's place on the
    executors, or a name given to ``SparkContext.addFile``."""
    if (path, pattern) not in _codecs:
        with open(path if "/" in path else SparkFiles.get(path), "rb") as f:
            _codecs[path, pattern] = Codec(f.read().splitlines(), pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded binary): each text's ids and the bytes that
    decoding those ids gives. One narrow pass, no shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                raw = [np.frombuffer(x, dtype=np.int32) for x in c.encode(part.column(1).to_pylist())]
                flat = np.concatenate(raw)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    list_array(flat, np.array([len(x) for x in raw]), pa.int32()),
                    pa.array([c.decode(x) for x in raw], type=pa.binary()),
                ], names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(texts, work, f"id {kind}, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``encode``'s rows."""
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
