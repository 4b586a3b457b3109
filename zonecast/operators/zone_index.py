"""Nearest zone for zone tables of any size, by candidate cells (C4).

A few zones are literals in a projection (``functions.geo``). For many, the plane is
cut into about as many cells as there are zones, and each cell gets the zones that can
be nearest to some point of it: those whose least distance to the cell is not above
the least of all zones' greatest distances to it. A point then meets its cell's few
candidates by an equi-join on the cell, and takes the nearest of them; no point is
compared with every zone, and the result is exact, ties included (the zone that comes
first in zone order). Candidates are found in two levels, first for groups of cells,
so the work does not grow with cells times zones.

The zones themselves (24 bytes each, checked against ``MOST_ZONES``) are broadcast to
the tasks that build the index. Points outside the zones' box are covered: the cells
reach over the box of zones and points together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, reach

#: Zones that are broadcast to the index at most (about 240 MB).
MOST_ZONES = 10_000_000
#: Cells of a group, along each axis.
SIDE = 16


def _candidates(lat: np.ndarray, lon: np.ndarray, own: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The numbers in ``own`` of zones that can be nearest to a point of ``box``."""
    lo_lat, hi_lat, lo_lon, hi_lon = box
    a, b = lat[own], lon[own]
    near = np.maximum(np.maximum(lo_lat - a, a - hi_lat), 0) ** 2 + np.maximum(np.maximum(lo_lon - b, b - hi_lon), 0) ** 2
    far = np.maximum(np.abs(a - lo_lat), np.abs(a - hi_lat)) ** 2 + np.maximum(np.abs(b - lo_lon), np.abs(b - hi_lon)) ** 2
    return own[near <= far.min() * (1 + 1e-9) + 1e-300]          # more than the rounding, so no tie is lost


def _cell(c, low: float, size: float, n: int):
    """Cell number along one axis, inside 0..n-1."""
    return F.least(F.greatest(F.floor((c - F.lit(low)) / F.lit(size)), F.lit(0)), F.lit(n - 1)).cast("int")


def assign_many(points: DataFrame, zones: DataFrame, lat: str, lon: str, out: str = "zone_id") -> DataFrame:
    """``points`` with the nearest zone of ``zones`` (zone_id, zone_lat, zone_lon). A
    point without both coordinates gets no zone."""
    spark = points.sparkSession
    order = [F.when(F.col("zone_id").rlike("^[0-9]{1,18}$"), F.col("zone_id").cast("long")), F.col("zone_id")]
    table = (zones.select("zone_id", "zone_lat", "zone_lon").orderBy(F.asc_nulls_last(order[0]), order[1])
             .limit(MOST_ZONES + 1).toArrow())
    k = table.num_rows
    if not k:
        raise ValueError("no centroids")
    if k > MOST_ZONES:
        raise ValueError(f"zone table has more than {MOST_ZONES} rows")
    names = np.array(table.column("zone_id").to_pylist(), dtype=object)
    zlat, zlon = (table.column(c).to_numpy() for c in ("zone_lat", "zone_lon"))
    ext = points.agg(F.min(lat), F.max(lat), F.min(lon), F.max(lon)).first()
    low = [min([z.min(), *([e] if e is not None else [])]) for z, e in ((zlat, ext[0]), (zlon, ext[2]))]
    high = [max([z.max(), *([e] if e is not None else [])]) for z, e in ((zlat, ext[1]), (zlon, ext[3]))]
    n = max(1, math.isqrt(k))
    size = [max((h - a) / n, 1e-9) for a, h in zip(low, high, strict=True)]
    shared = spark.sparkContext.broadcast((zlat, zlon))
    pad = [s * 1e-6 for s in size]                               # a point on a border may round into the next cell

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = shared.value
        every = np.arange(len(a))

        def box(i, j, m):
            edges = ((low[x] + c * size[x] - pad[x], low[x] + (c + m) * size[x] + pad[x]) for x, c in ((0, i), (1, j)))
            return tuple(e for pair in edges for e in pair)

        for batch in batches:
            rows, found = [], []
            for group in batch.column(0).to_pylist():
                gi, gj = divmod(group, -(-n // SIDE))
                some = _candidates(a, b, every, box(gi * SIDE, gj * SIDE, SIDE))
                for i in range(gi * SIDE, min(n, (gi + 1) * SIDE)):
                    for j in range(gj * SIDE, min(n, (gj + 1) * SIDE)):
                        rows.append((i, j))
                        found.append(_candidates(a, b, some, box(i, j, 1)))
            count = [len(f) for f in found]
            own = np.concatenate(found)
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (own, a[own], b[own])]
            yield pa.RecordBatch.from_arrays([pa.array([r[x] for r in rows], pa.int32()) for x in (0, 1)] + lists,
                                             names=["ci", "cj", "number", "clat", "clon"])

    reach(spark)
    groups = (-(-n // SIDE)) ** 2
    cells = materialize(spark.range(0, groups, 1, max(1, min(groups, spark.sparkContext.defaultParallelism * 4))).mapInArrow(
        work, "ci int, cj int, number array<long>, clat array<double>, clon array<double>"), "zone-cells")
    named = spark.createDataFrame(pa.table({"__number": pa.array(np.arange(k)), "__zone": pa.array(names.tolist(), pa.string())}))
    here = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    placed = points.withColumns({"__ci": F.when(here, _cell(F.col(lat), low[0], size[0], n)),
                                 "__cj": F.when(here, _cell(F.col(lon), low[1], size[1], n))})
    met = placed.join(cells, (F.col("__ci") == F.col("ci")) & (F.col("__cj") == F.col("cj")), "left")
    d = F.zip_with(F.zip_with("clat", "clon", lambda a, b: (F.col(lat) - a) * (F.col(lat) - a) + (F.col(lon) - b) * (F.col(lon) - b)),
                   "number", lambda d2, z: F.struct(d2.alias("d"), z.alias("z")))
    best = met.withColumn("__number", F.array_min(d).getField("z")).drop("__ci", "__cj", "ci", "cj", "number", "clat", "clon")
    return best.join(named, "__number", "left").withColumn(out, F.col("__zone")).drop("__number", "__zone")
