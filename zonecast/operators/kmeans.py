"""K-Means on pickup points, all starts in the same passes.

The folded points (distinct coordinates with their counts) are packed into numpy
blocks and kept as a persisted RDD, since dozens of short passes read them. A pass
serves every start that is not finished: it finds the nearest centre of each start
and adds up k x starts weighted sums, merged in a tree reduction; the driver sees
those sums only. Seeds come by k-means||: a point joins the candidates by a hash of
its coordinates and the step, so the draw does not depend on where the point lies;
the candidates (about 4 k for each start) are weighed by the points nearest to them,
and every start thins them to k on the driver by a draw of its own. The best start is
followed on to a tenth of the tolerance.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, reach

#: Points times centres that a task compares at once.
CELLS = 1 << 20
SEED_STEPS = 2
#: Draws for each centre that is chosen from the candidates.
TRIES = 5


@dataclass
class Centers:
    """A fitted model: the centres of the best start and its cost (the weighted sum
    of squared distances)."""

    centers: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name Spark ML gives it
        return list(self.centers)

    def save(self, path: str) -> None:
        rows = [(i, float(c[0]), float(c[1]), float(self.cost)) for i, c in enumerate(self.centers)]
        (SparkSession.getActiveSession().createDataFrame(rows, "zone int, lat double, lon double, cost double")
         .coalesce(1).write.mode("overwrite").parquet(path))

    @classmethod
    def load(cls, path: str) -> Centers:
        rows = SparkSession.getActiveSession().read.parquet(path).orderBy("zone").collect()
        return cls(np.array([(r["lat"], r["lon"]) for r in rows]), float(rows[0]["cost"]))


def _uniform(points: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each point, from its coordinates and ``salt`` alone."""
    lat, lon = (np.ascontiguousarray(points[:, i] + 0.0).view(np.uint64) for i in (0, 1))
    z = lat * np.uint64(0x9E3779B97F4A7C15) ^ (lon + np.uint64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ z >> np.uint64(shift)) * np.uint64(by)
    return (z ^ z >> np.uint64(31)) / 2.0 ** 64


def _nearest(xy: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each point's nearest centre, the first on ties."""
    number, least = np.empty(len(xy), dtype=np.int64), np.empty(len(xy))
    step = max(1, CELLS // max(len(centers), 1))
    for lo in range(0, len(xy), step):
        part = xy[lo:lo + step]
        d = np.subtract.outer(part[:, 0], centers[:, 0])
        d *= d
        e = np.subtract.outer(part[:, 1], centers[:, 1])
        e *= e
        d += e
        number[lo:lo + step] = d.argmin(1)
        least[lo:lo + step] = d[np.arange(len(d)), number[lo:lo + step]]
    return number, least


def _pass(blocks, centers: dict[int, np.ndarray], sample: dict | None = None):
    """For each start (k, 4): weight, sums of lat and lon, and cost of every centre.
    With ``sample`` = {start: (salt, rate)} also the points drawn as candidates."""
    def work(part):
        sums, drawn = {}, {s: [] for s in sample or ()}
        for points in part:
            xy, w = points[:, :2], points[:, 2]
            for s, c in centers.items():
                number, least = _nearest(xy, c)
                got = np.stack([np.bincount(number, v, len(c)) for v in (w, w * xy[:, 0], w * xy[:, 1], w * least)], axis=1)
                sums[s] = sums[s] + got if s in sums else got
                if sample:
                    salt, rate = sample[s]
                    drawn[s].append(xy[_uniform(xy, salt) < rate * w * least])
        yield sums, drawn

    def both(a, b):
        return ({s: a[0][s] + b[0][s] if s in a[0] and s in b[0] else a[0].get(s, b[0].get(s)) for s in {*a[0], *b[0]}},
                {s: a[1][s] + b[1][s] for s in a[1]})

    return blocks.mapPartitions(work).treeReduce(both)


def _plus_plus(points: np.ndarray, weight: np.ndarray, k: int, rng) -> np.ndarray:
    """k of the weighted candidates by greedy k-means++, then Lloyd steps among them."""
    if len(points) <= k:
        return points
    chosen = [points[rng.choice(len(points), p=weight / weight.sum())]]
    least = ((points - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        mass = weight * least
        if mass.sum() <= 0:
            mass = (least > 0) + 1e-300
        # of several draws the one that lowers the cost most
        tries = points[rng.choice(len(points), size=TRIES, p=mass / mass.sum())]
        after = np.minimum(least[None], ((points[None] - tries[:, None]) ** 2).sum(2))
        best = int((after @ weight).argmin())
        chosen.append(tries[best])
        least = after[best]
    centers = np.array(chosen)
    for _ in range(30):
        number, _ = _nearest(points, centers)
        total = np.bincount(number, weight, k)
        moved = np.stack([np.bincount(number, weight * points[:, i], k) for i in (0, 1)], axis=1) / np.maximum(total, 1e-300)[:, None]
        moved = np.where(total[:, None] > 0, moved, centers)
        if np.allclose(moved, centers, atol=1e-12):
            break
        centers = moved
    return centers


def fit(points: DataFrame, k: int, seed: int, starts: int, max_iter: int, tol: float, rows_per_block: int = 500_000) -> Centers:
    """Centres of (lat, lon, weight) rows: the start of least cost. A start is finished
    when no centre moves by more than ``tol`` degrees."""
    n = points.count()
    if not n:
        raise ValueError("no points")
    parts = max(1, -(-n // rows_per_block), min(8, n // 2048))
    fixed = (points.repartition(parts, "lat", "lon").sortWithinPartitions("lat", "lon"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = np.stack([b.column(c).to_numpy() for c in ("lat", "lon", "weight")], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(data)], pa.binary())], names=["data"])

    reach(points.sparkSession)
    packed = materialize(fixed.select("lat", "lon", "weight").mapInArrow(pack, "data binary"), "kmeans-blocks")
    blocks = packed.rdd.map(lambda r: pickle.loads(r["data"])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # the point of least hash (a task hands on one), then the candidates of all starts
        first = blocks.map(lambda p: min(zip(_uniform(p, seed), p[:, 0], p[:, 1]))).treeReduce(min)
        found = np.array([first[1:]], dtype=float)
        sums, _ = _pass(blocks, {0: found})
        for step in range(SEED_STEPS):
            rate = 2.0 * k * starts / max(sums[0][:, 3].sum(), 1e-300)
            _, drawn = _pass(blocks, {0: found}, {0: (seed + step + 1, rate)})
            found = np.unique(np.concatenate([found, *drawn[0]]), axis=0)
            sums, _ = _pass(blocks, {0: found})
        going = {s: _plus_plus(found, sums[0][:, 0], k, np.random.default_rng(seed + s)) for s in range(starts)}
        done: dict[int, tuple[float, np.ndarray]] = {}
        for turn in range(max_iter + 1):
            sums, _ = _pass(blocks, going)
            for s in list(going):
                w = sums[s][:, 0]
                moved = np.where(w[:, None] > 0, sums[s][:, 1:3] / np.maximum(w, 1e-300)[:, None], going[s])
                still = ((moved - going[s]) ** 2).sum(1).max() <= tol * tol or turn == max_iter
                if still:                                    # the cost is that of the centres that stay
                    done[s] = (float(sums[s][:, 3].sum()), going.pop(s))
                else:
                    going[s] = moved
            if not going:
                break
        best = min(done, key=lambda s: done[s][0])
        cost, centers = done[best]
        for _ in range(max_iter):                            # one start, to a tenth of the tolerance
            sums = _pass(blocks, {0: centers})[0][0]
            cost = float(sums[:, 3].sum())
            moved = np.where(sums[:, :1] > 0, sums[:, 1:3] / np.maximum(sums[:, :1], 1e-300), centers)
            if ((moved - centers) ** 2).sum(1).max() <= tol * tol / 100:
                break
            centers = moved
    finally:
        blocks.unpersist()
    return Centers(centers, cost)
