"""Repeated passages by hash-compared suffix sort (operator 1).

Every byte of a text that a repeated string of ``LENGTH`` bytes covers is found,
whatever the number of occurrences and whether they overlap.

1. Anchors. Of the ``GRAM``-byte grams of each window of ``LENGTH`` bytes the
   one with the least hash (rightmost of equals) is its anchor. Equal windows
   have equal anchors at equal places, so only windows with equal anchor grams
   need a comparison. An anchor stands for one run of window starts; its
   context is all bytes of those windows.
2. Counts. One row for each anchor goes through a shuffle by its gram. A gram
   that occurs once has no repeated window. A context that occurs twice is
   repeated whole. Both need hashes only.
3. Suffix sort. The other contexts, those that share a gram but differ, are cut
   from the texts and meet by gram. The suffixes at all their window starts are
   sorted by a merge sort over prefix polynomial hashes: two suffixes are
   compared by a binary search for their longest common extension, log2(LENGTH)
   hash comparisons, and then by one byte. All merges of all groups advance
   together in numpy. Neighbours with a common extension of LENGTH or more are
   repeated; their bytes are compared against hash collisions.
4. Groups of more than ``GROUP`` contexts (a very common line) aren't sorted in
   one task: their windows go out as one digest each, counted by Spark with
   partial aggregation. It finds the same windows.

Defined results: null or empty text has no bytes (and the digest of nothing);
texts shorter than LENGTH keep all; repeated rows remove each other's repeated
windows as any two texts do; rows that share an id are texts of their own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import U64, Prefix, binary_parts, map_batches, mix, runs
from zonecast.session import materialize

LENGTH = 200
GRAM = 40
GROUP = 2000
#: Window starts that a task sorts at once.
SORTED = 1 << 19
_POS = 21  # bits of a position inside a piece
PIECE = 1 << 20


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours, by doubling."""
    have, out = 1, key
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(key) - width + 1], out[width - have:])
    return out


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, anchor, first window, last window) of one text."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    pos, first = [], []
    step = PIECE
    for lo in range(0, n - LENGTH + 1, step):  # windows lo..hi-1; a long text in pieces
        hi = min(lo + step, n - LENGTH + 1)
        part = data[lo:hi + LENGTH - 1]
        p = Prefix(part)
        grams = mix(p.of(np.arange(len(part) - GRAM + 1), GRAM))
        key = (grams >> U64(_POS)) << U64(_POS) | (U64((1 << _POS) - 1) - np.arange(len(grams), dtype=U64))
        at = (1 << _POS) - 1 - (_least(key, LENGTH - GRAM + 1) & U64((1 << _POS) - 1)).astype(np.int64)
        new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        pos.append(at[new] + lo)
        first.append(new + lo)
    pos, first = np.concatenate(pos), np.concatenate(first)
    keep = np.append(True, pos[1:] != pos[:-1])
    pos, first = pos[keep], first[keep]
    last = np.append(first[1:], n - LENGTH + 1) - 1
    return pos, first, last


def _substrings(data: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Hashes of substrings; they don't depend on where the text was cut."""
    if len(data) <= PIECE * 2:
        return Prefix(data).of(start, length)
    length = np.broadcast_to(length, start.shape)
    out = np.empty(len(start), dtype=U64)
    piece = start // PIECE
    for k in np.unique(piece):
        own = np.flatnonzero(piece == k)
        lo, hi = int(start[own].min()), int((start[own] + length[own]).max())
        out[own] = Prefix(data[lo:hi]).of(start[own] - lo, length[own])
    return out


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each anchor: (gram, context digest, row, shape)."""
    for batch in batches:
        keys = batch.column("row").to_numpy()
        held: list[tuple] = []
        size = 0
        for i, data in _texts(batch.column("text")):
            if len(data) < LENGTH:
                continue
            pos, first, last = anchors(data)
            gram = mix(_substrings(data, pos, GRAM))
            long = last - first + LENGTH
            shape = mix((long.astype(U64) << U64(20)) | (pos - first).astype(U64))
            whole = mix(_substrings(data, first, long) + shape)
            held.append((gram.view(np.int64), whole.view(np.int64), np.full(len(pos), keys[i]),
                         (first << 16) | ((last - first) << 8) | (pos - first)))
            size += len(pos)
            if size > 200_000:
                yield _table(held)
                held, size = [], 0
        if held:
            yield _table(held)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): how often each anchor gram occurs, combined by block."""
    for batch in batches:
        held = [np.zeros(0, U64)]
        for _, data in _texts(batch.column("text")):
            if len(data) >= LENGTH:
                held.append(mix(_substrings(data, anchors(data)[0], GRAM)))
        gram, n = np.unique(np.concatenate(held), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])


#: ``shape`` packs the first window, and how far the last one and the anchor
#: are behind it (each less than LENGTH): a row of four longs shuffles cheaply.
_ROWS = ("gram", "whole", "row", "shape")


def _table(held: list[tuple]) -> pa.RecordBatch:
    cols = [np.concatenate(x) for x in zip(*held, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(_ROWS))


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    raw, offs = binary_parts(column)
    for i in range(len(column)):
        yield i, raw[offs[i]:offs[i + 1]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open context: (gram, row, first, last, pos, n, bytes)."""
    for batch in batches:
        rows, grams, spans = [], [], []
        column, open_ = batch.column("text"), batch.column("open")
        for i, data in _texts(column):
            own = open_[i].as_py()
            for o in own:
                first = o["shape"] >> 16
                last, pos = first + (o["shape"] >> 8 & 255), first + (o["shape"] & 255)
                rows.append((o["gram"], first, last, pos, o["n"]))
                grams.append(data[first:last + LENGTH].tobytes())
                spans.append(i)
        if not rows:
            continue
        gram, first, last, pos, n = zip(*rows, strict=True)
        keys = batch.column("row").to_numpy()[spans]
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), pa.array(keys), pa.array(first, pa.int32()), pa.array(last, pa.int32()),
             pa.array(pos, pa.int32()), pa.array(n, pa.int64()), pa.array(grams, pa.binary())],
            names=["gram", "row", "first", "last", "pos", "n", "bytes"])


class Suffixes:
    """Suffixes of a byte block that compare by hashes: at most LENGTH bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray):
        self.data, self.start, self.hash = data, start, Prefix(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension (up to LENGTH) of suffixes a and b: binary
        search over equal prefix hashes."""
        x, y = self.start[a], self.start[b]
        low = np.zeros(len(a), dtype=np.int64)
        high = np.full(len(a), LENGTH, dtype=np.int64)
        while True:
            go = low < high
            if not go.any():
                return low
            mid = (low + high + 1) >> 1
            same = self.hash.of(x, mid) == self.hash.of(y, mid)
            low, high = np.where(go & same, mid, low), np.where(go & ~same, mid - 1, high)

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b (equal ones by their number)."""
        c = self.common(a, b)
        last = c >= LENGTH
        at = np.where(last, 0, c)
        u, v = self.data[self.start[a] + at], self.data[self.start[b] + at]
        return np.where(last, a < b, u < v)


def merge_sorted(s: Suffixes, group: np.ndarray) -> np.ndarray:
    """Suffix numbers sorted within each group (numbers ascend by group): bottom-up
    merging of runs in all groups at once. An element's new place is its place
    in its run plus its rank in the run beside it, found by binary search."""
    n = len(group)
    order = np.arange(n)
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(start, n))
    base, length = np.repeat(start, size), np.repeat(size, size)
    width, longest = 1, int(size.max()) if n else 0
    spot = np.arange(n) - base  # place inside the group
    while width < longest:
        act = np.flatnonzero(length > width)  # groups that are sorted already rest
        b, p, ln = base[act], spot[act], length[act]
        run = p // width
        mate = np.where(run % 2 == 0, run + 1, run - 1) * width
        left = np.minimum(mate, ln)
        low, high = left.copy(), np.minimum(mate + width, ln)
        mine = order[act]
        while True:
            go = np.flatnonzero(low < high)
            if not len(go):
                break
            mid = (low[go] + high[go]) >> 1
            other = order[b[go] + mid]
            before = s.less(other, mine[go])
            low[go] = np.where(before, mid + 1, low[go])
            high[go] = np.where(before, high[go], mid)
        new = b + (run // 2) * 2 * width + (p - run * width) + (low - left)
        order = order.copy()
        order[new] = mine
        width *= 2
    return order


def repeated_windows(contexts: list[bytes], gram: np.ndarray, first: np.ndarray, last: np.ndarray,
                     pos: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(context, repeated window starts) of contexts that meet by gram."""
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    count = last - first + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    begin = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    # windows can only be equal if their gram and its place inside them are
    _, code = np.unique(gram, return_inverse=True)
    place = pos[owner] - first[owner] - step
    group = code[owner].astype(np.int64) * (LENGTH + 1) + place
    by = np.argsort(group, kind="stable")
    s = Suffixes(data, (begin[owner] + step)[by])
    group = group[by]
    order = merge_sorted(s, group)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(group[:-1] == group[1:])
    near = near[s.common(a[near], b[near]) >= LENGTH]
    if len(near):  # the bytes themselves decide
        x, y = s.start[a[near]], s.start[b[near]]
        ok = np.ones(len(near), dtype=bool)
        for i in range(LENGTH):
            ok &= data[x + i] == data[y + i]
        near = near[ok]
    hit = np.unique(np.concatenate([order[near], order[near + 1]]))
    hit = np.sort(by[hit])
    return [(int(k), first[k] + step[own]) for k, own in
            ((owner[h[0]], h) for h in np.split(hit, np.flatnonzero(np.diff(owner[hit])) + 1) if len(h))]


def _cover(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows at these sorted starts."""
    cut = np.flatnonzero(np.diff(starts) > LENGTH)
    lo = starts[np.append(0, cut + 1)]
    hi = starts[np.append(cut, len(starts) - 1)] + LENGTH
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


_FOUND = "row long, start int, end int, h1 long, h2 long"


def _rows(row, start, end, h1=None, h2=None) -> pa.RecordBatch:
    none = pa.nulls(len(row), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(row, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
         none if h1 is None else pa.array(h1), none if h2 is None else pa.array(h2)], names=["row", "start", "end", "h1", "h2"])


def _sorted(held: list[pa.Table]) -> pa.RecordBatch:
    """Spans of repeated windows of contexts in order of their grams."""
    t = pa.concat_tables(held)
    cols = [t.column(c).to_numpy() for c in ("gram", "first", "last", "pos", "row")]
    found = repeated_windows(t.column("bytes").to_pylist(), *(c.astype(np.int64) for c in cols[:4]))
    out = [(cols[4][k], lo, hi) for k, starts in found for lo, hi in _cover(starts)]
    return _rows(*(zip(*out, strict=True) if out else ((), (), ())))


def _windows(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """A 128-bit digest of every window of contexts of very common grams."""
    row, first = t.column("row").to_numpy(), t.column("first").to_numpy()
    for i, raw in enumerate(t.column("bytes").to_pylist()):
        data = np.frombuffer(raw, dtype=np.uint8)
        at = np.arange(len(data) - LENGTH + 1)
        h = [mix(Prefix(x).of(at, LENGTH)).view(np.int64) for x in (data, data ^ np.uint8(0x5A))]
        start = first[i] + at
        yield _rows(np.full(len(at), row[i]), start, start + LENGTH, *h)


def _resolved(group: int):
    """From contexts sorted by unit: spans of repeated windows, and digests of
    the windows that Spark is to count."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in runs(batches, "unit"):
            if t.column("n")[0].as_py() > group:
                yield from _windows(t)
                continue
            held.append(t)
            size += int((t.column("last").to_numpy() - t.column("first").to_numpy() + 1).sum())
            if size > SORTED:
                yield _sorted(held)
                held, size = [], 0
        if held:
            yield _sorted(held)

    return work


def spans(texts: DataFrame) -> DataFrame:
    """(row, spans array<struct<start, end>>): repeated runs, unmerged, of the
    texts (row long, text) that have any; rows of one name hold one text."""
    grams = map_batches(texts.select("text"), _grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = map_batches(texts, _anchored, "gram long, whole long, row long, shape long")
    shared = materialize(found.join(grams.where("n > 1"), "gram", "left_semi"), "op1-shared")
    counts = materialize(shared.groupBy("gram", "whole").agg(F.count("row").alias("same")), "op1-counts")
    kinds = counts.groupBy("gram").agg(F.count("whole").alias("kinds"))
    known = counts.join(kinds, "gram").where("same > 1 or kinds > 1")
    shared = materialize(shared.join(known, ["gram", "whole"]), "op1-known")
    first = F.shiftright("shape", 16)
    whole = shared.where("same > 1").select(
        "row", first.cast("int").alias("start"),
        (first + F.shiftright("shape", 8).bitwiseAND(F.lit(255)) + LENGTH).cast("int").alias("end"))

    # a context that differs from all others of its gram may still share windows with them
    some = shared.where("kinds > 1")
    one = some.where("same = 1").unionByName(some.where("same > 1").dropDuplicates(["gram", "whole"]))
    wanted = one.groupBy("row").agg(F.collect_list(F.struct("gram", "shape", F.col("kinds").alias("n"))).alias("open"))
    cut = map_batches(texts.join(wanted, "row").select("row", "text", "open"), _cut,
                      "gram long, row long, first int, last int, pos int, n long, bytes binary")
    # contexts of a very common gram need not meet: they are dealt apart
    cut = cut.withColumn("unit", F.when(F.col("n") <= GROUP, F.col("gram")).otherwise(F.xxhash64("row", "first")))
    met = cut.repartition("unit").sortWithinPartitions("unit", "gram", "row", "first")
    met = materialize(map_batches(met, _resolved(GROUP), _FOUND), "op1-resolved")
    many = met.where("h1 is not null")
    twice = many.groupBy("h1", "h2").agg(F.count("row").alias("c")).where("c > 1").select("h1", "h2")
    common = many.join(twice, ["h1", "h2"])
    every = whole.unionByName(met.where("h1 is null").select("row", "start", "end")).unionByName(common.select("row", "start", "end"))
    return every.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged(found: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["start"], s["end"]) for s in found or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans_, out = batch.column("spans"), []
        for i, data in _texts(batch.column("text")):
            own = merged(spans_[i].as_py())
            parts, at = [], 0
            for lo, hi in own:
                parts.append(data[at:lo].tobytes())
                at = hi
            parts.append(data[at:].tobytes())
            out.append((len(data), sum(hi - lo for lo, hi in own), [{"start": lo, "end": hi} for lo, hi in own], b"".join(parts)))
        size, gone, own, kept = zip(*out, strict=True) if out else ((), (), (), ())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(own, kind),
             pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "removed", "kept"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, removed array<struct<start, end>>, kept binary)
    of every row. The texts are read for the grams, the anchors, the contexts
    and what is left, and shuffled for the last two, by row."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # equal rows may share a name: what is found for one holds for the other
    texts = texts.withColumn("row", F.xxhash64("id", F.length("text"), "text"))
    found = spans(texts.select("row", "text"))
    return map_batches(texts.join(found, "row", "left").select("id", "text", "spans"), _kept,
                       f"id {kind}, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept binary"
                       ).withColumnRenamed("id", id_col)
