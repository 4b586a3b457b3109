"""JSON requests (L2, L3), dated features (A4), stored zones (A6, A7), scenario
forecasts (J12) and JSON records (G19)."""

import datetime as dt
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from zonecast.plans import context as C
from zonecast.streaming import requests as R

NOW = dt.datetime(2024, 1, 2, 9, 30)
LINES = [
    ('{"request_id": "a", "timestamp": "2024-01-01T10:05:00", "total_drivers": 150}', "a", dt.datetime(2024, 1, 1, 10, 5), 150, None),
    ('{"request_id": "b", "timestamp": "2024-01-01 10:05:00"}', "b", dt.datetime(2024, 1, 1, 10, 5), 100, None),
    ('{"request_id": "c"}', "c", NOW, 100, None),
    ('{"request_id": "d", "timestamp": "", "total_drivers": null}', "d", NOW, 100, None),
    ('{"request_id": "e", "timestamp": null, "total_drivers": "60"}', "e", NOW, 60, None),
    ('{"request_id": "f", "total_drivers": 12.0}', "f", NOW, 12, None),
    ('{"request_id": "g", "total_drivers": 12.5}', "g", None, None, R.BAD_DRIVERS),
    ('{"request_id": "h", "total_drivers": -1}', "h", None, None, R.BAD_DRIVERS),
    ('{"request_id": "i", "total_drivers": true}', "i", None, None, R.BAD_DRIVERS),
    ('{"request_id": "j", "total_drivers": 99999999999}', "j", None, None, R.BAD_DRIVERS),
    ('{"request_id": "k", "timestamp": "yesterday"}', "k", None, None, R.BAD_TIME),
    ('{"request_id": "l", "timestamp": ', None, None, None, R.BAD_JSON),
    ('', None, None, None, R.BAD_JSON),
    ('[1, 2]', None, None, None, R.BAD_JSON),
    ('"text"', None, None, None, R.BAD_JSON),
    (None, None, None, None, R.BAD_JSON),
    ('{"timestamp": "2024-01-01T10:05:00", "other": {"x": 1}}', None, dt.datetime(2024, 1, 1, 10, 5), 100, None),
]


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_allocation_requests_are_parsed_and_checked(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(LINES)], "i int, value string")
    for (line, rid, ts, fleet, error) in LINES:
        one = df.where(F.col("value").eqNullSafe(F.lit(line)))
        r = R.parse_allocation(one, now()).first()
        assert (r.request_ts, r.fleet, r.error) == (ts, fleet, error), line
        assert r.request_id == rid if rid else re.fullmatch("raw:[0-9a-f]{64}", r.request_id), line


def test_prediction_requests_are_parsed_and_checked(spark):
    lines = [('{"request_id": "a", "timestamp": "2024-01-01T10:05:00", "zone_id": "3"}', "3", 10.0, None),
             ('{"request_id": "b", "timestamp": "2024-01-01T10:05:00", "zone_id": 4, "active_drivers": 7}', "4", 7.0, None),
             ('{"request_id": "c", "zone_id": "3"}', None, None, R.BAD_TIME),
             ('{"request_id": "d", "timestamp": "2024-01-01T10:05:00"}', None, None, R.BAD_ZONE),
             ('{"request_id": "e", "timestamp": "2024-01-01T10:05:00", "zone_id": "3", "active_drivers": "x"}', None, None, R.BAD_DRIVERS),
             ('nothing', None, None, R.BAD_JSON)]
    got = R.parse_prediction(spark.createDataFrame([(x[0],) for x in lines], "value string")).collect()
    found = {r.request_id: (r.zone_id, r.active_drivers, r.error) for r in got}
    for line, zone, drivers, error in lines:
        key = json.loads(line)["request_id"] if line.startswith("{") else next(k for k in found if k.startswith("raw:"))
        assert found[key] == (zone, drivers, error), line


@pytest.fixture()
def forecast(spark):
    rows = [(z, h, d, float(1 + int(z) + h % 3), 0.0, 0.0) for z in ("0", "1", "2") for h in range(24) for d in range(7)
            if (z, h) != ("1", 10)]
    return spark.createDataFrame(rows, "zone_id string, hour int, day_of_week int, pred_15m double, pred_30m double, pred_60m double")


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_a_repeated_batch_or_request_changes_nothing(spark, forecast, tmp_path):
    base = str(tmp_path / "answers")
    lines = spark.createDataFrame([(x[0],) for x in LINES] + [(LINES[0][0],)], "value string")
    R.answer_batch(lines, 0, forecast, base, now())
    first = R.answers(spark, base)
    want = rows_of(first)
    good = sum(x[4] is None for x in LINES)
    assert len(want) == 3 * good + len(LINES) - good - 1      # the null and the empty line are one id
    for fleet, total in first.where("error is null").groupBy("request_id").agg(
            F.max("fleet"), F.sum("allocated_drivers")).select("max(fleet)", "sum(allocated_drivers)").collect():
        assert fleet == total
    R.answer_batch(lines, 0, forecast, base, now())             # the batch again
    assert rows_of(R.answers(spark, base)) == want
    later = F.lit(dt.datetime(2024, 1, 5, 3, 0)).cast("timestamp_ntz")
    R.answer_batch(lines, 1, forecast, base, later)             # the same requests, sent again later
    assert rows_of(R.answers(spark, base)) == want
    R.answer_batch(spark.createDataFrame([('{"request_id": "new"}',)], "value string"), 2, forecast, base, later)
    assert R.answers(spark, base).count() == len(want) + 3


def test_stream_of_requests_resumes(spark, forecast, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(x[0],) for x in LINES[:3]], "value string").coalesce(1).write.mode("append").text(src)
    stream = lambda: spark.readStream.schema("value string").text(src)
    assert R.allocate_requests(spark, stream(), forecast, now(), path=base).count() == 9
    assert R.allocate_requests(spark, stream(), forecast, now(), path=base).count() == 9
    spark.createDataFrame([(x[0],) for x in LINES[2:5]], "value string").coalesce(1).write.mode("append").text(src)
    assert R.allocate_requests(spark, stream(), forecast, now(), path=base).count() == 15


def test_no_requests(spark, forecast, tmp_path):
    base = str(tmp_path / "none")
    R.answer_batch(spark.createDataFrame([], "value string"), 0, forecast, base, now())
    assert R.answers(spark, base).count() == 0


def test_simulation_bin_reads_one_date_folder(spark):
    from zonecast.operators.split import chronological_split
    from zonecast.plans.catalog import QUERIES
    q = QUERIES["alloc_at_bin"](spark, SF_SMALL)
    rows = q.collect()
    table, counts = C.features_by_date(spark, SF_SMALL)
    assert table.select("date").distinct().count() > 3
    assert sum(r["rows"] for r in counts.collect()) == table.count()
    s = chronological_split(table.drop("date")).where("split = 'test'").agg(F.min("time_bin")).first()[0]
    assert {r.time_bin for r in rows} == {s}
    plan = q._jdf.queryExecution().executedPlan().toString()
    dated = [x for x in plan.split("FileScan parquet")[1:] if "PartitionFilters: [isnotnull(date" in x]
    assert dated and "dynamicpruning" not in dated[0] and "Subquery" in dated[0].split("PushedFilters")[0]


def test_table_version_follows_the_files(spark, tmp_path):
    from zonecast.sources.tables import table_version
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    before = table_version(spark, path)
    spark.range(10).write.mode("append").parquet(path)
    assert table_version(spark, path) != before


def test_zones_are_fitted_once_stored_and_used(spark, tmp_path):
    from zonecast.operators.zones import assign_zone, model_centroids, zones_of_model
    rng = np.random.default_rng(5)
    rides = spark.createDataFrame([(i, float(37.7 + x), float(-122.5 + y)) for i, (x, y) in enumerate(rng.random((400, 2)) / 10)],
                                  "ride_id int, pickup_lat double, pickup_long double")
    calls = []

    def get():
        calls.append(1)
        return rides

    path = str(tmp_path / "model")
    model = zones_of_model(spark, path, get, k=5, n_init=2)
    again = zones_of_model(spark, path, get, k=5, n_init=2)
    assert len(calls) == 1 and np.array_equal(model.centers, again.centers)
    got = {r.ride_id: int(r.zone_id) for r in assign_zone(rides, model_centroids(again)).collect()}
    for r in rides.collect():
        d = ((again.centers - (r.pickup_lat, r.pickup_long)) ** 2).sum(1)
        assert d[got[r.ride_id]] == d.min()


def test_scenario_forecast_takes_the_model_and_falls_back(spark):
    from zonecast.operators.forecast import train
    from zonecast.operators.scenario import baseline_forecast, lag_profile, scenario_alloc, scenario_forecast, scenario_grid
    f = C.features_table(spark, SF_SMALL)
    fc, _ = train(f, max_iter=4, with_supply=False)
    assert len(fc.features) == 15
    profile = lag_profile(f)
    zones = C.zones(spark)
    gone = f.first().zone_id
    base = baseline_forecast(f)
    part = scenario_forecast(profile.where("hour <> 5"), fc, zones.where(F.col("zone_id") != gone), base).cache()
    n = f.select("zone_id").distinct().count()
    assert part.count() == n * 168
    wrong = part.where((F.col("source") == "baseline") != ((F.col("hour") == 5) | (F.col("zone_id") == gone)))
    assert wrong.count() == 0
    assert part.where("pred_15m < 0 or pred_15m is null").count() == 0
    # the same as scoring a feature row made by hand
    r = part.where("source = 'model' and day_of_week = 2 and hour = 7").orderBy("zone_id").first()
    p = profile.where((F.col("zone_id") == r.zone_id) & (F.col("hour") == 7) & (F.col("day_of_week") == 2)).first()
    z = zones.where(F.col("zone_id") == r.zone_id).first()
    x = {"hour": 7, "minute": 0, "day_of_week": 2, "is_weekend": 0, "month": p.month, "hour_sin": float(np.sin(2 * np.pi * 7 / 24)),
         "hour_cos": float(np.cos(2 * np.pi * 7 / 24)), "day_sin": float(np.sin(4 * np.pi / 7)), "day_cos": float(np.cos(4 * np.pi / 7)),
         "lag_1": p.lag_1, "lag_4": p.lag_4, "lag_96": p.lag_96, "rolling_mean_4": p.rolling_mean_4,
         "zone_lat": z.zone_lat, "zone_lon": z.zone_lon}
    one = fc.predict(spark.createDataFrame([tuple(x.values())], list(x))).first()
    assert abs(one.pred_15m - r.pred_15m) <= 0.5 / 1024 + 1e-9
    grid = scenario_grid(f, fleets=(20, 150), fares=(5.0,), capacities=(3.0,))
    a = scenario_alloc(grid, part)
    assert a.count() == grid.count() * n and "source" in a.columns
    full, _ = train(f, max_iter=1)
    with pytest.raises(ValueError, match="active_drivers"):
        scenario_forecast(profile, full, zones, base)
