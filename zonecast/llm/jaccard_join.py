"""N-gram Jaccard join by parity sketches (operator 2).

A document is its set of distinct word shingles (hashed to 64 bits). Sets of
sizes a and b link at similarity t only if their symmetric difference has at
most D = (a + b)(1 - t) / (1 + t) elements. Within a size band the shingles are
dealt by hash into D + 1 blocks and XORed there: of D + 1 blocks one at least
holds no differing shingle, so linked sets share a block's value (pigeonhole).

1. One row for each task and block value goes through one shuffle; a task's own
   documents with the same value are tied to the least of them beforehand, so a
   value that a third of all documents share arrives as a few rows.
2. Documents that share a value meet in units; there bit sketches (one parity
   bit for each shingle hash) are compared, whose Hamming distance never exceeds
   the symmetric difference. Pairs beyond D are out for certain.
3. The rest forms clusters. Each cluster's sets meet once, and every pair that
   is not connected yet is compared by its sketch, then exactly.

Units and clusters above ``CHUNK`` sets are dealt into chunks and compared chunk
by chunk, each pair of chunks in a task of its own choosing; only a spanning
forest of the verified links leaves a task. Equal sets are one set throughout.
All blocks of a pair can be empty by chance when D is small; such bands deal
their shingles several times over (``DEALS``), which puts a miss below 1e-11.

Defined results: null or empty text, or one without words, has an empty set and
links with nothing; a text of fewer words than a shingle has one shingle, its
whole sequence; repeated rows are equal sets. Texts link, not ids: sets are known
by their digests throughout, and a group gets its name, its smallest id, at the end.
So rows of different texts that share an id are documents of their own, each in the
group of its text, and a text that only rows with a null id hold links like any
other (a group has a null name if all its ids are null). An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import U64, blocks, map_batches, mix, runs, words
from zonecast.llm.components import components
from zonecast.session import materialize

#: Sets that are compared with each other in one task.
CHUNK = 4096
#: Block values a task combines before it hands them on.
HELD = 1 << 20
GROWTH = 1.5


def difference(a, b, percent: int):
    """Most differing elements of two linked sets of these sizes."""
    return ((a + b) * (100 - percent)) // (100 + percent)


def bands(percent: int, top: int = 1 << 40) -> np.ndarray:
    """Lower sizes of the bands; linked sets are in the same or in neighbours."""
    edge = [1]
    while edge[-1] < top:
        edge.append(max(edge[-1] + 1, int(edge[-1] * GROWTH)))
    assert 100 / percent < GROWTH
    return np.array(edge, dtype=np.int64)


def deals(d: int) -> int:
    """How often a band's shingles are dealt anew."""
    return 1 if d >= 40 else 2 if d >= 16 else 4 if d >= 8 else 6 if d >= 4 else 10


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a block."""
    w, before = words(data, offs)
    n = np.diff(before)
    g = np.zeros(max(len(w) - k + 1, 0), dtype=U64)
    for i in range(k):
        g = mix(g * U64(0x9E3779B97F4A7C15) + w[i:i + len(g)])
    out = []
    for r in range(len(n)):
        lo = before[r]
        if n[r] >= k:
            out.append(np.unique(g[lo:lo + n[r] - k + 1]))
        elif n[r]:
            h = np.full(1, int(n[r]), dtype=U64)
            for x in w[lo:lo + n[r]]:
                h = mix(h * U64(0x9E3779B97F4A7C15) + x)
            out.append(h)
        else:
            out.append(w[:0])
    return out


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity bits, a power of two of them (at least 2 for each element)."""
    bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    parity = np.bincount((mix(s) >> U64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(U64)


def folded(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketches brought to the length of the shortest by XORing halves."""
    size = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(s.reshape(-1, size), axis=0) for s in sketches])


def digests(s: np.ndarray) -> tuple[int, int]:
    one = int(mix(s).sum(dtype=U64)) ^ len(s)
    two = int(np.bitwise_xor.reduce(mix(s + U64(0x51ED)))) if len(s) else 0
    return tuple(int(np.array([x], dtype=U64).view(np.int64)[0]) for x in (one, two))


def _described(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(2)):
                sets = shingle_sets(data, offs, k)
                d = [digests(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([x for x, _ in d], type=pa.int64()), pa.array([x for _, x in d], type=pa.int64()),
                    pa.array([sketch(s).tobytes() for s in sets], type=pa.binary())], names=["id", "text_key", "n", "d1", "d2", "sketch"])

    return work


def block_values(sets: list[np.ndarray], owner: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, owner) of every filled block of every set, in all its bands."""
    edge = bands(percent)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    home = np.searchsorted(edge, size, side="right") - 1
    near = size * 100 >= percent * edge[np.minimum(home + 1, len(edge) - 1)]
    members: dict[int, list[int]] = {}
    for i in np.flatnonzero(size > 0):
        members.setdefault(int(home[i]), []).append(i)
        if near[i]:
            members.setdefault(int(home[i]) + 1, []).append(i)
    values, owners = [], []
    for band, rows in members.items():
        top = int(edge[band + 1]) - 1
        d = int(difference(top, top, percent))
        if not d:  # only equal sets link
            continue
        flat = np.concatenate([sets[i] for i in rows])
        of = np.repeat(np.arange(len(rows)), size[rows])
        for deal in range(deals(d)):
            salt = U64((deal * 0xA24BAED4963EE407 + 0x9FB21C651E98DF25) % (1 << 64))
            dealt = mix(flat ^ salt)
            block = ((dealt >> U64(32)) * U64(d + 1)) >> U64(32)
            spot = of.astype(U64) * U64(d + 1) + block
            order = np.argsort(spot, kind="stable")
            spot, content = spot[order], flat[order]
            start = np.flatnonzero(np.append(True, spot[1:] != spot[:-1]))
            tag = mix((spot[start] % U64(d + 1)) + U64(band << 40) + U64(deal << 56))
            values.append(mix(np.bitwise_xor.reduceat(mix(content), start) ^ tag))
            owners.append(owner[rows][(spot[start] // U64(d + 1)).astype(np.int64)])
    if not values:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(values), np.concatenate(owners)


def _tied(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """(value, least owner) once for each value, and (value, least, owner) for
    each other owner of it."""
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    fresh = np.append(True, value[1:] != value[:-1])
    start = np.flatnonzero(fresh)
    least = np.repeat(owner[start], np.diff(np.append(start, len(value))))
    more = (owner != least) & np.append(True, (owner[1:] != owner[:-1]) | fresh[1:])
    return value[start], owner[start], value[more], least[more], owner[more]


def _rows(key, value, a, b, kind: int) -> pa.RecordBatch:
    cols = [pa.array(x, type=pa.int64()) for x in (key, value, a, b)]
    return pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(a), kind, dtype=np.int32))],
                                      names=["key", "value", "a", "b", "kind"])


_ROWS = "key long, value long, a long, b long, kind int"


def _valued(k: int, percent: int):
    """Rows of kind 0, dealt by value: a is the least holder of the value here;
    rows of kind 1, dealt by value and a: b holds it too, beside a."""
    def flush(held):
        value, first, shared, least, member = _tied(*(np.concatenate(x) for x in zip(*held, strict=True)))
        v, w = value.view(np.int64), shared.view(np.int64)
        yield _rows(v, v, first, first, 0)
        yield _rows(mix(shared ^ mix(least.view(U64))).view(np.int64), w, least, member, 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, data, offs in blocks(batch.column(0)):
                sets = shingle_sets(data, offs, k)
                own = np.array([digests(s)[0] for s in sets], dtype=np.int64)
                held.append(block_values(sets, own, percent))
                size += len(held[-1][0])
                if size > HELD:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return work


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: ties (kind 1) as they are, and for each value
    with several holders the holders beside the least, b (kind 0)."""
    carry_value, carry_least = None, None
    for batch in batches:
        _, value, a, b, kind = (batch.column(i).to_numpy() for i in range(5))
        tie = kind == 1
        yield _rows(value[tie], value[tie], a[tie], b[tie], 1)
        value, a = value[~tie], a[~tie]
        if not len(value):
            continue
        start = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        least = np.minimum.reduceat(a, start)  # rows are sorted by value and holder
        if carry_value is not None and value[0] == carry_value:
            least[0] = carry_least
        carry_value, carry_least = value[-1], least[-1]
        head = np.repeat(least, np.diff(np.append(start, len(value))))
        other = a != head
        yield _rows(value[other], value[other], a[other], head[other], 0)


class Forest:
    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, j: int) -> None:
        a, b = self.of[i], self.of[j]
        self.of[self.of == max(a, b)] = min(a, b)


def _forest(size: np.ndarray, marks: np.ndarray, percent: int, side: np.ndarray | None, holds) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sketches are close enough and that
    ``holds`` accepts; with ``side`` only pairs from different sides."""
    forest, out = Forest(len(size)), []
    for i in range(len(size)):
        rest = np.flatnonzero(forest.of != forest.of[i])
        if side is not None:
            rest = rest[side[rest] != side[i]]
        most = difference(size[i], size[rest], percent)
        fits = np.abs(size[rest] - size[i]) <= most
        rest, most = rest[fits], most[fits]
        if not len(rest):
            continue
        near = np.bitwise_count(marks[rest] ^ marks[i]).sum(axis=1) <= most
        for j in rest[near]:
            if forest.of[j] != forest.of[i] and holds(i, j):
                out.append((i, int(j)))
                forest.join(i, j)
    return out


def _compared(percent: int, exact: bool):
    """Forest edges (a, b) within each unit of rows sorted by ``unit``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for t in runs(batches, "unit"):
            if t.num_rows < 2:
                continue
            ids, size = t.column("id").to_numpy(), t.column("n").to_numpy()
            marks = folded([np.frombuffer(x, dtype=U64) for x in t.column("sketch").to_pylist()])
            side = t.column("side").to_numpy()
            side = side if len(np.unique(side)) > 1 else None
            if exact:
                sets = [np.frombuffer(x, dtype=U64) for x in t.column("elements").to_pylist()]

                def holds(i, j, sets=sets):
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    return 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
            else:
                holds = lambda i, j: True
            out += [(ids[i], ids[j]) for i, j in _forest(size, marks, percent, side, holds)]
            if len(out) > 100_000:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)

    return work


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = np.array(found, dtype=np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def in_chunks(members: DataFrame, group: str) -> DataFrame:
    """Rows (group, id, ...) dealt to units: a group of at most CHUNK rows is one
    unit; a larger one is dealt into chunks, and each pair of chunks (and each
    chunk) is a unit, ``side`` telling the two chunks apart."""
    sizes = members.groupBy(group).agg(F.ceil(F.count("id") / CHUNK).cast("int").alias("__chunks"))
    df = members.join(sizes, group).withColumn("__own", F.pmod(F.xxhash64("id"), F.col("__chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))
    df = df.withColumn("__other", other)
    unit = F.xxhash64(group, F.least("__own", "__other"), F.greatest("__own", "__other"))
    # within a chunk's own unit all rows are of one side
    return (df.withColumn("unit", unit).withColumn("side", F.col("__own"))
            .drop("__chunks", "__own", "__other"))


def _by_unit(df: DataFrame) -> DataFrame:
    return df.repartition("unit").sortWithinPartitions("unit", "id")


def _elements(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column("text")):
                sets = shingle_sets(data, offs, k)
                part = batch.slice(lo, hi - lo)
                same = pa.array([digests(s)[0] for s in sets], type=pa.int64())
                out = pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("cluster"), part.column("n"), part.column("sketch"),
                     pa.array([s.tobytes() for s in sets], type=pa.binary())],
                    names=["id", "cluster", "n", "sketch", "elements"])
                # a text key is a hash: only the text that stands for the class
                yield out.filter(pa.compute.equal(same, part.column("d1")))

    return work


def text_key(text_col: str = "text"):
    """What tells texts under one id apart (null and empty: the same)."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def grouped(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, n, component_id, set_group) of every row: ``component_id`` is the
    smallest id of the row's group, ``set_group`` a number that no other group has (null
    for an empty set)."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    seen = materialize(map_batches(base, _described(k), "id long, text_key long, n long, d1 long, d2 long, sketch binary"), "op2-seen")
    # a class is a set; one of its rows, with an id where it has one, stands for it
    row = F.struct(F.col("id").isNull().alias("nameless"), "id", "text_key")
    classes = seen.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(row).alias("row"), F.first("sketch").alias("sketch"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("id"), "n", "d1", "d2", "row", "sketch"), "op2-sets")

    values = map_batches(base.select("text"), _valued(k, percent), _ROWS)
    met = materialize(map_batches(values.repartition("key").sortWithinPartitions("key", "kind", "a"), _met, _ROWS), "op2-met")
    ties = met.where("kind = 1").select("value", F.col("a").alias("least"), F.col("b").alias("member"))
    lead = met.where("kind = 0").select("value", F.col("a").alias("least"), F.col("b").alias("head")).distinct()
    # a task's ties follow their least holder to the head of the value
    units = (ties.join(lead, ["value", "least"], "left").select(F.coalesce("head", "least").alias("head"), "member")
             .unionByName(lead.select("head", F.col("least").alias("member"))).distinct())
    units = units.unionByName(units.select("head", F.col("head").alias("member")).distinct())
    known = classes.select("id", "n", F.col("d1").alias("member"), "sketch")
    close = _by_unit(in_chunks(units.join(known, "member").select("head", "id", "n", "sketch"), "head"))
    close = materialize(map_batches(close.select("unit", "side", "id", "n", "sketch"), _compared(percent, False),
                                    "a long, b long"), "op2-close")

    cluster = components(close).select("id", F.col("component").alias("cluster"))
    wanted = cluster.join(classes.select("id", "n", "d1", "row", "sketch"), "id").select(
        "id", "cluster", "n", "d1", "sketch", F.col("row.id").alias("row_id"), "row.text_key")
    wanted = materialize(wanted, "op2-wanted")
    cols = ["id", "cluster", "n", "d1", "sketch", "text"]
    named = (base.where("id is not null").withColumnRenamed("id", "row_id")
             .join(wanted.where("row_id is not null"), ["row_id", "text_key"]).select(*cols))
    # rows without an id meet by their text alone: one of each text goes on
    nameless = (base.where("id is null").dropDuplicates(["text_key"]).drop("id")
                .join(wanted.where("row_id is null"), "text_key").select(*cols))
    sets = map_batches(named.unionByName(nameless), _elements(k),
                       "id long, cluster long, n long, sketch binary, elements binary")
    sets = materialize(sets.dropDuplicates(["id"]), "op2-elements")
    links = _by_unit(in_chunks(sets, "cluster")).select("unit", "side", "id", "n", "sketch", "elements")
    groups = materialize(components(map_batches(links, _compared(percent, True), "a long, b long")), "op2-groups")

    own = classes.select("id", "n", "d1", "d2", F.col("row.id").alias("least"))
    names = own.join(groups, "id").groupBy("component").agg(F.min("least").alias("name"))
    linked = groups.join(names, "component")
    of_class = own.join(linked, "id", "left").select(
        "n", "d1", "d2", F.coalesce("component", "id").alias("set_group"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("name")).alias("name"))
    return seen.drop("sketch").join(of_class, ["n", "d1", "d2"], "left").select(
        "id", "text_key", "n", F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("id")).alias("component_id"), "set_group")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    return grouped(docs, k, percent, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row left of each group: that of the smallest id
    (one without an id only if the group has none other), of its texts that of the least
    text key. Rows with an empty set stay, but of rows that share id and text one is left."""
    found = grouped(docs, k, percent, id_col, text_col)
    keys = ["__nameless", "__id", "__key"]
    row = F.struct(F.col("id").isNull().alias("__nameless"), F.coalesce("id", F.lit(0)).alias("__id"), F.col("text_key").alias("__key"))
    rows = found.select("set_group", row.alias("row"))
    heads = (rows.where("set_group is not null").groupBy("set_group").agg(F.min("row").alias("row")).select("row.*")
             .unionByName(rows.where("set_group is null").select("row.*").distinct()))
    own = F.col(id_col).cast("long")
    at = docs.select(F.struct(*docs.columns).alias("__row"), own.isNull().alias("__nameless"),
                     F.coalesce(own, F.lit(0)).alias("__id"), text_key(text_col).alias("__key"))
    return at.join(heads, keys, "left_semi").dropDuplicates(keys).select("__row.*")
