"""Best-fit packing in bulk-synchronous rounds (operator 12).

Documents become pieces of at most ``capacity`` tokens, and pieces go into sequences
of that capacity. A round sorts the pieces of the current size band and the gaps of
the open sequences by size, largest first and gaps before pieces, and deals the
sorted rows out by range. A task sweeps its range: a piece takes the smallest gap
not below it that is still free, as brackets match, and every pair it finds inside
the range is settled. What is left of a range is a run of pieces and then a run of
gaps; the rank of each (how deep it lies in the bracket sequence of all ranges) names
the one row of another range that it can meet, so one shuffle by rank settles the
rest and no gap is claimed twice. Gaps shrink by what they took, and the next round
begins. Before a round, as many sequences are opened as the band needs at least by
volume. A gap that could take several of the largest pieces is offered in parts of
that size, so that small pieces don't need a round each.

The driver sees histograms over sizes (``capacity`` rows at most) and one count a
range; rows move between tasks only. The number of rounds follows the spread of the
sizes (6 to 16 in trials from 1,000 to 1,000,000 pieces), not their number.

Defined results: null counts as empty, which is one token (the end); a piece of full
length is a sequence of its own; rows with one id, and equal rows, are packed each by
itself; ties go by the order of the written pieces; an empty table gives an empty
result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonecast.llm.arrow import list_array, map_batches
from zonecast.llm.token_counts import byte_symbols
from zonecast.session import materialize

#: Rows of a sweep that a task takes.
ROWS = 250_000
#: Rows of a table between rounds that a file holds at least.
FILE_ROWS = 20_000
#: From this share of the capacity down all pieces are one band.
SMALL = 8
_coders: dict[tuple[str, str], Coder] = {}


class Coder:
    """Token ids by a byte-level BPE file of the tokenizers library. The merges run in
    tiktoken, several times as fast, where ids ascend with the merges (checked), which
    gives the same ids; a text that its expressions give up on goes to the library."""

    def __init__(self, path: str, pattern: str):
        self.path = path if "/" in path else SparkFiles.get(path)
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"ids of {path} do not ascend with its merges")
        byte = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocab.items() if t not in special}
        self.fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.whole: Tokenizer | None = None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as e:  # a panic of the extension is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if self.whole is None:
                self.whole = Tokenizer.from_file(self.path)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end: int = 0, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece, and ``ids`` if asked for.
    A document's tokens are followed by ``end``; of a longer document all pieces but
    the first have ``capacity`` tokens. One narrow pass."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                owner, rows, kept = [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = np.append(c.ids(text or ""), np.uint32(end)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for j, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        owner.append(i)
                        rows.append((j, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                        if with_ids:
                            kept.append(ids[a:b])
                columns = [part.column(0).take(pa.array(owner, pa.int64())),
                           *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.int64()] * 3), strict=True))]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(list_array(np.concatenate(kept).astype(np.int64), np.array([len(k) for k in kept]), pa.int64()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    found = map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), work,
                        f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
    return found.withColumnRenamed("id", id_col)


def brackets(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows in order, gaps (False) and pieces (True): (rank of every row, matched
    gaps, matched pieces). A piece takes the last gap before it that none has taken; a
    gap and a piece can meet only where their ranks are equal and neighbours."""
    rank = np.cumsum(np.where(piece, -1, 1)) + piece
    order = np.argsort(rank, kind="stable")
    meet = (rank[order][1:] == rank[order][:-1]) & ~piece[order][:-1] & piece[order][1:]
    at = np.flatnonzero(meet)
    return rank, order[at], order[at + 1]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles the pairs of one range; its pieces, and its gaps that are free."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    piece = t.column("piece").to_numpy()
    rank, gaps, taken = brackets(piece)
    seq, slot = (t.column(c).to_numpy().copy() for c in ("seq", "slot"))
    met = np.zeros(len(piece), dtype=bool)
    met[taken] = True
    for c in (seq, slot):
        c[taken] = c[gaps]
    stay = piece.copy()
    stay[~piece] = True
    stay[gaps] = False
    columns = [t.column("piece"), t.column("uid"), t.column("size"), pa.array(seq), pa.array(slot), t.column("row"),
               t.column("part"), pa.array(met), pa.array(rank.astype(np.int64))]
    out = pa.Table.from_arrays(columns, names=["piece", "uid", "size", "seq", "slot", "row", "part", "met", "rank"])
    yield from out.filter(pa.array(stay)).to_batches(max_chunksize=20_000)


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows in no more partitions than those need."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def match(active: DataFrame, slots: DataFrame, count: int, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """One round over the pieces ``active`` (uid, size, row), ``count`` rows with the
    slots: (uid, size, seq, slot, row) of those that got a part of a gap, and (uid,
    size, row) of the others."""
    spark = active.sparkSession
    kind = active.schema["row"].dataType
    none = F.lit(-1).cast("long")
    both = (active.select(F.lit(True).alias("piece"), "uid", "size", none.alias("seq"), none.alias("slot"), "row")
            .unionByName(slots.select(F.lit(False).alias("piece"), F.col("seq").alias("uid"), "size", "seq", "slot",
                                      F.lit(None).cast(kind).alias("row"))))
    order = [F.desc("size"), F.asc("piece"), F.asc("uid"), F.asc("slot")]
    dealt = (both.repartitionByRange(max(1, -(-count // rows)), *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))
    out = f"piece boolean, uid long, size long, seq long, slot long, row {kind.simpleString()}, part int, met boolean, rank long"
    swept = materialize(few(map_batches(dealt, _sweep, out), count), "best-fit-sweep")
    # gaps less pieces left in the ranges before each range: one count a range
    left = few(swept.where("not met").groupBy("part").agg(F.sum(F.when(F.col("piece"), -1).otherwise(1)).alias("d")), 1).collect()
    base, before = [], 0
    for r in sorted(left, key=lambda r: r["part"]):
        base.append((r["part"], before))
        before += r["d"]
    done = swept.where("met").select("uid", "size", "seq", "slot", "row")
    rest = swept.where("not met")
    if len(base) > 1:
        rest = rest.join(F.broadcast(spark.createDataFrame(base, "part int, base long")), "part")
        w = Window.partitionBy(F.col("rank") + F.col("base")).orderBy("part", F.desc("piece"))
        rest = rest.withColumn("gap", F.lag(F.struct("piece", "seq", "slot")).over(w)).where("piece")
        hit = F.coalesce(~F.col("gap.piece"), F.lit(False))
        rest = materialize(few(rest.select("uid", "size", F.when(hit, F.col("gap.seq")).alias("seq"),
                                           F.when(hit, F.col("gap.slot")).alias("slot"), "row"), count), "best-fit-rest")
        done, rest = done.unionByName(rest.where("seq is not null")), rest.where("seq is null")
    else:
        rest = rest.where("piece")
    return done, rest.select("uid", "size", "row")


def _histogram(df: DataFrame, size: str) -> dict[int, int]:
    return {int(r[0]): int(r[1]) for r in few(df.groupBy(size).count(), 1).collect()}


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", rows: int = ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Lengths lie in 1..capacity."""
    names = pieces.columns
    base = materialize(pieces.select(F.monotonically_increasing_id().alias("uid"), F.col(length_col).cast("long").alias("size"),
                                     F.struct(*names).alias("row")), "best-fit-pieces")
    spark = base.sparkSession
    waiting = _histogram(base, "size")
    if waiting and not 1 <= min(waiting) <= max(waiting) <= capacity:
        raise ValueError(f"a length is outside 1..{capacity}")
    # a full piece needs no search; sequences below zero are theirs
    full = base.where(F.col("size") == capacity).select("row", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    waiting.pop(capacity, None)
    top, left, late = capacity - 1, None, {}              # base sizes up to top are not yet active
    open_, gaps, opened, placed = None, {}, 0, []         # (seq, free) and its histogram
    while waiting or late:
        most = max([*waiting, *late])
        cut = most // 2 if most > capacity // SMALL else 0
        now = {s: n for s, n in waiting.items() if s > cut}
        waiting = {s: n for s, n in waiting.items() if s <= cut}
        fresh = base.where((F.col("size") > cut) & (F.col("size") <= top))
        active = fresh if left is None else left.unionByName(fresh)
        top, least = min(top, cut), min([*now, *late])
        volume = sum(s * n for h in (now, late) for s, n in h.items())
        room = sum(f * n for f, n in gaps.items() if f >= least)
        new = max(0, -(-(volume - room) // capacity))
        more = spark.range(opened, opened + new).select(F.col("id").alias("seq"), F.lit(capacity).cast("long").alias("free"))
        opened += new
        state = more if open_ is None else open_.unionByName(more)
        several = F.col("free") >= 2 * most
        slots = state.where(F.col("free") >= least).select(
            "seq", F.when(several, F.lit(most)).otherwise(F.col("free")).cast("long").alias("size"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.when(several, F.floor(F.col("free") / most)).otherwise(1).cast("long"))).alias("slot"))
        count = sum(now.values()) + sum(late.values()) + sum(
            n * max(1, f // most) for f, n in [*gaps.items(), (capacity, new)] if f >= least)
        done, left = match(active, slots, count, rows)
        placed.append(done.select("seq", F.lit(len(placed)).alias("round"), "slot", "size", "row"))
        late = _histogram(left, "size")
        if waiting or late:
            taken = state.unionByName(done.select("seq", (-F.col("size")).alias("free"))).groupBy("seq").agg(F.sum("free").alias("free"))
            open_ = materialize(few(taken.where(F.col("free") >= min([*waiting, *late])), sum(gaps.values()) + new), "best-fit-gaps")
            gaps = _histogram(open_, "free")
    if not placed:
        return full.select("row.*", "sequence_id", "offset")
    every = placed[0]
    for p in placed[1:]:
        every = every.unionByName(p)
    w = Window.partitionBy("seq").orderBy("round", "slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(w), F.lit(0)).cast("long").alias("offset")
    return full.unionByName(every.select("row", F.col("seq").alias("sequence_id"), offset)).select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """(sequence_id, ids) of packed pieces that hold their ids; a sequence is one
    bounded group."""
    lists = F.sort_array(F.collect_list(F.struct("offset", F.col(ids_col).alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.flatten(lists.getField("ids")).alias("ids"))
