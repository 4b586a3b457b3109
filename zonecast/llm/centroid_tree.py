"""Centroid clustering with a vantage-point tree (operator 11).

Vectors are cut to integers, ``floor(scale * x)``, so that distances, sums and
means are exact and a result does not depend on the order of rows. Each round
builds a vantage-point tree over the centroids on the driver and broadcasts it
(k centroids; the size is checked). Every vector walks the tree by itself, best
first: its node of least lower bound is opened next, and it stops when that bound
passes its best distance. A bound that equals the best distance is still opened,
since a centroid behind it may tie with a smaller number. Distances to centroids
are exact integers. A task adds up its own vectors, so k rows a task are shuffled
and k rows a round reach the driver; the vectors themselves never move.

Defined results: vectors that are null, of another length than ``dim`` or hold a
null or non-finite component are left out; a null id hashes as the text ``null``;
rows with the same id or vector all count, each as a vector of its own; with fewer
than k vectors each one is a centroid; centroids without vectors stay; an empty
table gives an empty result; other columns are not read. A component whose integer
passes 2^27 in size is an error, because squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.arrow import map_batches
from zonecast.session import materialize

#: Centroids of a leaf.
LEAF = 4
#: Cells of the (vector, tree node) table that a task holds at once.
CELLS = 1 << 21
#: Largest tree that is broadcast, in bytes of centroids.
MOST_BYTES = 1 << 28
#: Largest size of a component's integer.
MOST = 1 << 27


@dataclass
class Tree:
    """Nodes in arrays. An inner node has a vantage centroid and two children, each
    with the least and greatest distance of its centroids from the vantage point; a
    leaf has the numbers ``leaf[node]``."""

    centroids: np.ndarray      # (k, dim) int64
    vantage: np.ndarray        # centroid number, -1 in a leaf
    child: np.ndarray          # (nodes, 2), -1 where there is none
    near: np.ndarray           # (nodes, 2) least distance of the child's centroids
    far: np.ndarray            # (nodes, 2) greatest one
    leaf: list[np.ndarray]


def build(centroids: np.ndarray) -> Tree:
    """The tree over the rows of ``centroids``; equal rows are fine."""
    vantage, child, near, far, leaf = [], [], [], [], []
    todo = [(np.arange(len(centroids)), -1, 0)]
    while todo:
        own, parent, side = todo.pop()
        node = len(vantage)
        if parent >= 0:
            child[parent][side] = node
        child.append([-1, -1])
        near.append([0.0, 0.0])
        far.append([0.0, 0.0])
        if len(own) <= LEAF:
            vantage.append(-1)
            leaf.append(own)
            continue
        # the centroid farthest from the first one has the widest spread of distances
        top = own[np.argmax(_squared(centroids[own], centroids[own[0]]))]
        rest = own[own != top]
        dist = np.sqrt(_squared(centroids[rest], centroids[top]).astype(np.float64))
        order = np.argsort(dist, kind="stable")
        vantage.append(int(top))
        leaf.append(own[:0])
        for s, part in enumerate(np.array_split(order, 2)):
            near[node][s], far[node][s] = dist[part].min(), dist[part].max()
            todo.append((np.sort(rest[part]), node, s))
    return Tree(centroids, np.array(vantage), np.array(child), np.array(near), np.array(far), leaf)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(-1)


def nearest(tree: Tree, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row of ``v``; of
    equally near ones the smallest number. The rows take their steps together, each
    at the node that is next in its own order."""
    best = np.full(len(v), np.iinfo(np.int64).max)
    number = np.full(len(v), len(tree.centroids))
    bound = np.full((len(v), len(tree.vantage)), np.inf)   # inf: not met, or done
    bound[:, 0] = 0.0
    rows = np.arange(len(v))
    while len(rows):
        node = bound[rows].argmin(1)
        least = bound[rows, node]
        # least is below the true bound by more than its rounding, so no tie is cut off
        on = least <= np.sqrt(best[rows].astype(np.float64))
        rows, node, least = rows[on], node[on], least[on]
        bound[rows, node] = np.inf
        order = np.argsort(node, kind="stable")
        rows, node, least = rows[order], node[order], least[order]
        cuts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))[:len(node)]
        for lo, hi in zip(cuts, np.append(cuts[1:], len(node))[:len(cuts)], strict=True):
            n, at = node[lo], rows[lo:hi]
            some = tree.leaf[n] if tree.vantage[n] < 0 else tree.vantage[n:n + 1]
            d = _squared(v[at][:, None, :], tree.centroids[some][None])
            first = d.argmin(1)                              # numbers of a leaf ascend
            low, which = d[np.arange(len(at)), first], some[first]
            gain = (low < best[at]) | ((low == best[at]) & (which < number[at]))
            best[at[gain]], number[at[gain]] = low[gain], which[gain]
            if tree.vantage[n] >= 0:
                away = np.sqrt(d[:, 0].astype(np.float64))
                for s in (0, 1):
                    gap = np.maximum(away - tree.far[n, s], tree.near[n, s] - away)
                    gap -= 1e-9 * (away + tree.far[n, s])    # more than the rounding of the roots
                    bound[at, tree.child[n, s]] = np.maximum(np.maximum(gap, 0.0), least[lo:hi])
    return number, best


def _vectors(column: pa.Array, scale: float, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = np.floor(scale * x)
    if len(v) and np.abs(v).max() > MOST:
        raise ValueError(f"a component times {scale} passes {MOST}")
    return v.astype(np.int64).reshape(-1, dim)


def _blocks(batches: Iterator[pa.RecordBatch], tree: Tree, scale: float):
    """(first row's batch slice, vectors, numbers, distances) block by block."""
    dim = tree.centroids.shape[1]
    step = max(16, CELLS // max(len(tree.vantage), LEAF * dim))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            v = _vectors(part.column("v"), scale, dim)
            yield part, v, *nearest(tree, v)


def clean(rows: DataFrame, dim: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    good = (F.size(vec_col) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"))


def seeds(vectors: DataFrame, k: int, salt: str, scale: float) -> np.ndarray:
    """The k vectors of least SHA-256 of ``salt:id``, in that order; of rows with one
    id the smaller vector comes first."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    cut = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    top = (vectors.select(F.sha2(text, 256).alias("h"), cut.alias("w")).orderBy("h", "w").limit(k).collect())
    return np.array([r["w"] for r in top], dtype=np.int64)


def _totals(vectors: DataFrame, tree, dim: int, scale: float) -> list:
    """(cluster, vectors, component sums) of the clusters that have vectors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tree.value
        k = len(t.centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, v, number, _ in _blocks(batches, t, scale):
            order = np.argsort(number, kind="stable")
            met, first = np.unique(number[order], return_index=True)
            count[met] += np.diff(np.append(first, len(number)))
            total[met] += np.add.reduceat(v[order], first, axis=0)
        met = np.flatnonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(met) + 1, dtype=np.int32) * dim),
                                        pa.array(total[met].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(count[met]), sums], names=["cluster", "n", "s"])

    part = map_batches(vectors.select("v"), work, "cluster long, n long, s array<long>")
    return part.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.element_at("s", i + 1).cast("decimal(20,0)")) for i in range(dim)]).alias("s")).collect()


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, salt: str = "1",
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every
    vector that takes part, after ``rounds`` rounds of assignment and replacement by
    the floor of the mean, and a last assignment."""
    if k * dim * 8 > MOST_BYTES:
        raise ValueError(f"{k} centroids of {dim} components pass {MOST_BYTES} bytes")
    spark = rows.sparkSession
    vectors = clean(rows, dim, id_col, vec_col)
    kind = vectors.schema["id"].dataType.simpleString()
    centroids = seeds(vectors, k, salt, scale).reshape(-1, dim)
    for _ in range(rounds if len(centroids) else 0):
        tree = spark.sparkContext.broadcast(build(centroids))
        for r in _totals(vectors, tree, dim, scale):
            centroids[r["cluster"]] = [int(s) // int(r["n"]) for s in r["s"]]
        tree.unpersist()
    last = spark.sparkContext.broadcast(build(centroids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, distance in _blocks(batches, last.value, scale):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(number), pa.array(distance)],
                                             names=["id", "cluster", "distance"])

    placed = materialize(map_batches(vectors, work, f"id {kind}, cluster long, distance long"), "centroid-tree")
    per = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))   # k rows at most
    per = per.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    names = spark.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())],
        "cluster long, centroid_sha256 string")
    facts = per.join(names, "cluster")
    return placed.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
