"""Embedding near-duplicates by an inverted multi-index (operator 8).

Vectors are scaled to length 1 and cut in half; two codebooks, fitted by
k-means on a bounded sample (``SAMPLE`` rows at most), give every vector a cell
of the product grid. A query walks the grid's cells in order of the summed
distances of its halves to the cell's centres (a multi-sequence traversal) and
takes the nearest ``walk`` ones; ``walk`` is the least number with which the
sample's own links are found to ``RECALL``. Cosines of the visited pairs are
then computed in double precision.

Every row is indexed and every row is a query. Equal vectors of a label are one
vector with a weight. Rows meet by label and cell; a cell of more than
``CHUNK`` rows is dealt into chunks, each with its own share of the queries, so
no task holds a hot cell. A task hands on counts and a spanning forest of the
links it found, never all pairs.

A pair counts for both when either walk reaches the other's cell: the task that
sees it knows both walks, and counts for the second one where that one's own
walk would miss it.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite parts, and one with a null label, links with nothing; vectors of
different lengths never link; repeated rows link with each other; a row with a
null id is not linked; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import map_batches, runs
from zonecast.llm.components import components
from zonecast.session import materialize

SAMPLE = 8192
#: Sample rows that the number of visited cells is learned from.
TRIED = 1024
RECALL = 0.97
CHUNK = 2048
#: Vectors that a cell should hold on average.
CELL = 64


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(15):
        near = np.argmax(x @ centre.T - 0.5 * (centre ** 2).sum(1), axis=1)
        n = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, j], k) for j in range(x.shape[1])], axis=1)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ centre.T + (centre ** 2).sum(1), 0.0)


class Grid:
    """Codebooks of the two halves and the number of cells that a query visits."""

    def __init__(self, first: np.ndarray, second: np.ndarray, walk: int):
        self.books, self.walk = (first, second), walk

    @property
    def size(self) -> int:
        return len(self.books[0])

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.books[0].shape[1]
        return _distances(x[:, :m], self.books[0]), _distances(x[:, m:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * self.size + b.argmin(1)

    def visited(self, x: np.ndarray, walk: int | None = None) -> np.ndarray:
        """The nearest cells of each vector, nearest first. A cell at places
        (i, j) of the two sorted lists has (i+1)(j+1)-1 nearer ones at least, so
        the walk never leaves the hyperbola (i+1)(j+1) <= walk."""
        walk = min(walk or self.walk, self.size ** 2)
        a, b = self.halves(x)
        i, j = np.divmod(np.arange(self.size ** 2), self.size)
        front = (i + 1) * (j + 1) <= walk
        i, j = i[front], j[front]
        oa, ob = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        cost = np.take_along_axis(a, oa, 1)[:, i] + np.take_along_axis(b, ob, 1)[:, j]
        take = np.argsort(cost, axis=1, kind="stable")[:, :walk]
        return oa[np.arange(len(x))[:, None], i[take]] * self.size + ob[np.arange(len(x))[:, None], j[take]]


def fit(x: np.ndarray, count: int, cosine: float) -> Grid:
    """Codebooks from a sample; ``count`` vectors of one label are expected."""
    k = int(np.clip(np.sqrt(count / CELL), 1, min(256, len(x))))
    rng, m = np.random.default_rng(5), x.shape[1] // 2
    grid = Grid(_kmeans(x[:, :m], k, rng), _kmeans(x[:, m:], k, rng), 1)
    # links are rare in a sample, so it learns from vectors turned to the very limit: the hardest links
    x = x[:TRIED]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1)[:, None] * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1), 1e-12)[:, None]
    want, before = grid.cells(cosine * x + np.sqrt(1 - cosine ** 2) * noise), []
    for lo in range(0, len(x), 32):
        a, b = grid.halves(x[lo:lo + 32])
        cost = (a[:, :, None] + b[:, None, :]).reshape(len(a), -1)
        before.append((cost < np.take_along_axis(cost, want[lo:lo + 32, None], 1)).sum(1))
    grid.walk = int(np.quantile(np.concatenate(before), RECALL)) + 1
    return grid


def clean(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec, v): usable rows; v is the vector of length 1 in doubles."""
    vec = F.col(vec_col).cast("array<double>")
    df = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec"))
    df = df.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0))
    df = df.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    most = F.array_max(F.transform("vec", F.abs))  # scaled first, so that squares neither overflow nor vanish
    df = df.withColumn("most", most).where("most > 0").withColumn("v", F.transform("vec", lambda x: x / F.col("most")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return df.withColumn("norm", norm).select("id", "label", "vec", F.transform("v", lambda x: x / F.col("norm")).alias("v"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _placed(grid: Grid):
    """Each vector with its own cell and the cells it visits."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            own, seen = [], []
            for lo in range(0, len(x), 256):
                own.append(grid.cells(x[lo:lo + 256]))
                seen += grid.visited(x[lo:lo + 256]).astype(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(own).astype(np.int64)), pa.array(seen, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "own", "walk"])

    return work


def _linked(cosine: float):
    """For each unit (rows of one label and cell chunk, and queries): links and a
    forest, as rows (a, b, n): n more links for a, or with n = 0 an edge a-b."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "unit"):
            asks = t.column("ask").to_numpy(zero_copy_only=False)
            if asks.all() or not asks.any():
                continue
            ids, weight, own = (t.column(c).to_numpy() for c in ("id", "weight", "own"))
            walk, x = t.column("walk").to_pylist(), _matrix(t.column("v"))
            here, from_ = np.flatnonzero(~asks), np.flatnonzero(asks)
            a, b, n = [], [], []
            reach = [set(w) for w in (walk[i] for i in here)]
            for lo in range(0, len(from_), 1024):
                q = from_[lo:lo + 1024]
                i, j = np.nonzero(x[q] @ x[here].T >= cosine)
                qi, hj = q[i], here[j]
                ok = ids[qi] != ids[hj]
                qi, hj, j = qi[ok], hj[ok], j[ok]
                # the other side counts here if its own walk would not reach the query
                back = np.array([own[k] not in reach[m] for k, m in zip(qi, j, strict=True)], dtype=bool)
                for who, other in ((qi, hj), (hj[back], qi[back])):
                    u, inv = np.unique(who, return_inverse=True)
                    a += ids[u].tolist()
                    b += ids[u].tolist()
                    n += np.bincount(inv, weight[other]).astype(np.int64).tolist()
                if len(qi):  # one edge for each query and for each row reached spans what met here
                    for side, other in ((qi, hj), (hj, qi)):
                        order = np.lexsort((ids[other], side))
                        first = order[np.append(True, side[order][1:] != side[order][:-1])]
                        a += ids[side[first]].tolist()
                        b += ids[other[first]].tolist()
                        n += [0] * len(first)
                    label = _spanning(qi, hj)
                    a += ids[label[0]].tolist()
                    b += ids[label[1]].tolist()
                    n += [0] * len(label[0])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, n)], names=["a", "b", "n"])

    return work


def _spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, least row it is connected with) by label spreading over the pairs."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    i, j = at[:len(u)], at[len(u):]
    of = np.arange(len(nodes))
    while True:
        new = of.copy()
        np.minimum.at(new, i, of[j])
        np.minimum.at(new, j, of[i])
        new = np.minimum(new, new[new])
        if (new == of).all():
            return nodes, nodes[of]
        of = new


def near_duplicates(rows: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    good = materialize(clean(rows, id_col, vec_col, label_col), "op8-clean")
    classes = materialize(good.groupBy("label", "vec", "v").agg(
        F.min("id").alias("rep"), F.count("id").alias("weight")), "op8-classes")
    results, ties = [], []
    for (dim,) in classes.select(F.size("v")).distinct().collect():  # one grid for each vector length
        some = classes.where(F.size("v") == dim)
        sample = some.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").toArrow()
        top = some.groupBy("label").count().agg(F.max("count")).first()[0]
        x = _matrix(sample.column("v"))
        grid = fit(x, top, cosine)
        placed = map_batches(
            some.select("label", F.col("rep").alias("id"), "weight", "v"), _placed(grid),
            "label string, id long, weight long, v array<double>, own long, walk array<long>")
        placed = materialize(placed, "op8-placed")
        # a cell's rows in chunks; every query of the cell meets every chunk, in blocks of its own
        sizes = placed.groupBy("label", F.col("own").alias("cell")).agg(F.ceil(F.count("id") / CHUNK).cast("int").alias("chunks"))
        asked = placed.withColumn("cell", F.explode("walk"))
        loads = asked.groupBy("label", "cell").agg(F.ceil(F.count("id") / CHUNK).cast("int").alias("blocks"))
        sizes = sizes.join(loads, ["label", "cell"])
        stay = placed.withColumn("cell", F.col("own")).join(sizes, ["label", "cell"])
        stay = stay.withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).withColumn(
            "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("ask", F.lit(False))
        go = asked.join(sizes, ["label", "cell"])
        go = go.withColumn("b", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")).withColumn(
            "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("ask", F.lit(True))
        unit = F.xxhash64("label", "cell", "c", "b").alias("unit")
        met = (stay.select(unit, "ask", "id", "weight", "own", "walk", "v")
               .unionByName(go.select(unit, "ask", "id", "weight", "own", "walk", "v"))
               .repartition("unit").sortWithinPartitions("unit", "ask", "id"))
        found = materialize(map_batches(met, _linked(cosine), "a long, b long, n long"), "op8-links")
        results.append(found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more")))
        ties.append(found.where("n = 0").select("a", "b"))
    of = classes.select("label", "vec", "rep", "weight")
    if results:
        more, edges = results[0], ties[0]
        for r, e in zip(results[1:], ties[1:], strict=True):
            more, edges = more.unionByName(r), edges.unionByName(e)
        of = (of.join(more, "rep", "left").join(components(edges).withColumnRenamed("id", "rep"), "rep", "left")
              .select("label", "vec", F.coalesce("component", "rep").alias("component"),
                      (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("links")))
    else:
        of = of.select("label", "vec", F.col("rep").alias("component"), (F.col("weight") - 1).alias("links"))
    named = good.select("id", "label", "vec").join(of, ["label", "vec"]).select("id", "component", "links")
    every = rows.select(F.col(id_col).cast("long").alias("__id"))
    # ids that occur several times keep all their rows; a row's own links count once
    per_id = named.groupBy("id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    component = F.coalesce("component", "__id")
    return every.join(per_id, F.col("__id") == F.col("id"), "left").select(
        F.col("__id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("__id") == component).alias("kept"))
