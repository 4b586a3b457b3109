"""Nearest zone by candidate cells equals comparing every zone (C4)."""

import numpy as np
import pytest

from zonecast.operators import zone_index
from zonecast.operators.zones import assign_zone, fixed_zones


def plain(points, zones):
    out = {}
    z = np.array([(a, b) for _, a, b in zones])
    for i, a, b in points:
        if a is None or b is None:
            out[i] = None
            continue
        d = (a - z[:, 0]) * (a - z[:, 0]) + (b - z[:, 1]) * (b - z[:, 1])
        out[i] = zones[int(d.argmin())][0]                       # the first on ties
    return out


def frame(spark, points):
    return spark.createDataFrame(points, "ride_id long, pickup_lat double, pickup_long double").repartition(3)


@pytest.mark.parametrize("name", ["spread", "crowded", "grid", "line", "one"])
def test_cells_equal_every_zone(spark, name):
    rng = np.random.default_rng(6)
    zones = {"spread": rng.random((900, 2)) + [37, -122], "crowded": np.concatenate([rng.normal(0, 1e-4, (500, 2)), rng.random((40, 2)) * 50]),
             "grid": np.array([(i // 20, i % 20) for i in range(400)], dtype=float), "line": np.stack([np.full(300, 5.0), np.arange(300.0)], 1),
             "one": np.array([[1.0, 2.0]])}[name]
    rows = [(str(i), float(a), float(b)) for i, (a, b) in enumerate(zones)]
    if name == "grid":                                           # equal places: the first zone has the point
        rows += [(str(400 + i), *rows[i][1:]) for i in range(50)]
    lo, hi = zones.min(0) - 3, zones.max(0) + 3
    at = np.concatenate([rng.random((600, 2)) * (hi - lo) + lo, zones[rng.integers(0, len(zones), 200)],
                         np.round(rng.random((300, 2)) * (hi - lo) + lo) + 0.5])      # outside, on zones, half way (ties)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(at)] + [(9000, None, 1.0), (9001, 1.0, None), (9002, *rows[0][1:])]
    got = zone_index.assign_many(frame(spark, points), fixed_zones(spark, rows[::-1]), "pickup_lat", "pickup_long").collect()
    assert len(got) == len(points)
    assert {r.ride_id: r.zone_id for r in got} == plain(points, rows)


def test_fifty_thousand_zones(spark):
    """Beyond the inline limit: no error, the same zone as by comparing all."""
    rng = np.random.default_rng(9)
    rows = [(str(i), float(a), float(b)) for i, (a, b) in enumerate(rng.random((50_000, 2)))]
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.random((1500, 2)))]
    got = assign_zone(frame(spark, points), fixed_zones(spark, rows)).collect()
    assert {r.ride_id: r.zone_id for r in got} == plain(points, rows)


def test_no_zones_is_an_error(spark):
    with pytest.raises(ValueError, match="no centroids"):
        zone_index.assign_many(frame(spark, [(1, 0.0, 0.0)]), fixed_zones(spark, [("1", 0.0, 0.0)]).where("zone_id = '2'"), "pickup_lat", "pickup_long")
