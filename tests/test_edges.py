"""Edge rules on small hand-made frames (blueprint FIXTURES F8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonecast import params as P
from zonecast.functions.pricing import allocation_surge, point_surge, trip_price
from zonecast.operators.demand import demand_grid, supply_fill
from zonecast.operators.features import add_features
from zonecast.operators.fleet import add_revenue, allocate
from zonecast.operators.zones import fixed_zones


def T(h, m=0, d=1):
    return dt.datetime(2024, 1, d, h, m)


def _alloc(spark, preds, fleet=150):
    df = spark.createDataFrame([("g", z, float(p)) for z, p in preds], "g string, zone_id string, predicted_demand double")
    return {r.zone_id: r for r in allocate(df, ["g"], fleet=fleet).collect()}


def test_remainder_goes_to_first_of_tied_maxima(spark):
    # three equal maxima: shares 1/3 * 100 = 33.33 -> 33 each, remainder +1 to the first
    out = _alloc(spark, [("2", 1.0), ("10", 1.0), ("1", 1.0)], fleet=100)
    assert sum(r.allocated_drivers for r in out.values()) == 100
    assert out["1"].allocated_drivers == 34       # '1' < '10' < '2' in string order
    assert out["10"].allocated_drivers == 33 and out["2"].allocated_drivers == 33


def test_remainder_may_be_negative(spark):
    # two equal zones, 3 drivers: shares 1.5 -> rint 2 + 2 = 4, remainder -1 on the first
    out = _alloc(spark, [("a", 1.0), ("b", 1.0)], fleet=3)
    assert out["a"].allocated_drivers == 1 and out["b"].allocated_drivers == 2


def test_half_to_even_rounding(spark):
    # shares 12.5 and 37.5 of 50 drivers -> rint 12 and 38 (not 13 / 38)
    out = _alloc(spark, [("a", 1.0), ("b", 3.0)], fleet=50)
    assert out["a"].allocated_drivers == 12 and out["b"].allocated_drivers == 38


def test_zero_demand_branch(spark):
    out = _alloc(spark, [("a", 0.0), ("b", 0.0), ("c", 0.0)], fleet=100)
    for r in out.values():
        assert r.allocated_drivers == 33        # int(100 / 3), no remainder
        assert r.prob is None and r.surge_multiplier == 1.0 and r.action == "Move Out"


def test_surge_thresholds(spark):
    df = spark.createDataFrame([(1.0,), (1.0000001,), (100.0,)], "dsr double")
    s = [r[0] for r in df.select(allocation_surge(F.col("dsr"))).collect()]
    assert s[0] == 1.0                      # dsr == 1: no surge
    assert abs(s[1] - 1.3466) < 1e-4        # jumps just above 1
    assert s[2] == 3.0                      # capped


def test_point_surge_edges(spark):
    df = spark.createDataFrame([(5.0, 0.0), (4.0, 4.0), (8.0, 4.0), (100.0, 1.0)], "d double, s double")
    got = [r[0] for r in df.select(point_surge(F.col("d"), F.col("s"))).collect()]
    assert got[0] == 3.0 and got[1] == 1.0 and got[3] == 3.0
    assert got[2] == round(min(max(1.0, 1 + 0.8 * __import__("math").log(2.1)), 3.0), 2)


def test_trip_price(spark):
    df = spark.createDataFrame([(10.0, 20.0, 1.5)], "km double, mins double, s double")
    assert df.select(trip_price(F.col("km"), F.col("mins"), F.col("s"))).first()[0] == 37.5


def test_actions_are_strict(spark):
    # gap 5 and -3 are both Hold
    out = _alloc(spark, [("a", 5.0), ("b", 0.0)], fleet=0)
    assert out["a"].gap == 5.0 and out["a"].action == "Hold"
    out = _alloc(spark, [("a", 1.0), ("b", 0.0)], fleet=4)
    assert out["a"].allocated_drivers == 4 and out["a"].gap == -3.0 and out["a"].action == "Hold"


def test_revenue_invariants(spark):
    df = spark.createDataFrame([("g", str(i), float(i % 7)) for i in range(20)],
                               "g string, zone_id string, predicted_demand double")
    rows = add_revenue(allocate(df, ["g"], fleet=30)).collect()
    assert sum(r.allocated_drivers for r in rows) == 30
    for r in rows:
        assert 1.0 <= r.surge_multiplier <= 3.0
        assert r.fulfilled_rides <= 3.0 * r.allocated_drivers + 1e-9


def test_fill_order_zone_missing_in_first_bin(spark):
    # zone 'b' first appears in bin 2; zone ranks: a=1, b=2 (first bin, then label)
    demand = spark.createDataFrame([
        (T(0, 0), "a", 1, 4.0, 0), (T(0, 15), "b", 1, 9.0, 0), (T(0, 30), "a", 2, None, 0),
    ], "time_bin timestamp_ntz, zone_id string, demand long, active_drivers double, is_cancelled long")
    g = {(r.time_bin, r.zone_id): r for r in supply_fill(demand_grid(demand, 900)).collect()}
    assert len(g) == 6                                  # 3 bins x 2 zones
    assert g[(T(0, 0), "a")].active_drivers == 4.0
    assert g[(T(0, 0), "b")].active_drivers == 4.0      # carried from zone a, same bin
    assert g[(T(0, 15), "a")].active_drivers == 4.0     # from the previous bin's last value
    assert g[(T(0, 15), "b")].active_drivers == 9.0
    assert g[(T(0, 30), "a")].active_drivers == 9.0     # null supply is carried across bins
    assert g[(T(0, 30), "b")].active_drivers == 9.0
    assert g[(T(0, 15), "a")].demand == 0 and g[(T(0, 30), "a")].demand == 2


def test_fill_carries_across_days(spark):
    # supply seen only on day 1; day 3 bins still get it (blocked scan)
    demand = spark.createDataFrame([
        (T(23, 45, 1), "a", 1, 7.0, 0), (T(0, 0, 3), "a", 1, None, 0),
    ], "time_bin timestamp_ntz, zone_id string, demand long, active_drivers double, is_cancelled long")
    g = supply_fill(demand_grid(demand, 900))
    assert g.count() == 98
    assert g.where(F.col("active_drivers") != 7.0).count() == 0


def test_rolling_mean_needs_four_rows(spark):
    grid = spark.createDataFrame([(T(0, 15 * i), "0", 1, i, 1.0, 0) for i in range(3)],
                                 "time_bin timestamp_ntz, zone_id string, zone_rank int, demand long, "
                                 "active_drivers double, is_cancelled long")
    for method in ("shift", "window"):
        assert add_features(grid, fixed_zones(spark), method=method).count() == 0   # lag_96 / targets null


@pytest.mark.parametrize("method", ["shift", "window"])
def test_feature_forms_agree(spark, method):
    from zonecast.plans import context as C
    base = C.features(spark, "/root/testdata/sf0.001", method="shift")
    other = C.features(spark, "/root/testdata/sf0.001", method=method)
    assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0


def test_grid_and_feature_invariants(spark):
    from zonecast.plans import catalog as K
    from zonecast.plans import context as C
    sf = "/root/testdata/sf0.001"
    d = K._demand(spark, sf)
    g = demand_grid(d, 900)
    bins = g.select("time_bin").distinct().count()
    zones = g.select("zone_id").distinct().count()
    assert g.count() == bins * zones
    assert g.agg(F.sum("demand")).first()[0] == C.rides(spark, sf).count()
    assert C.features(spark, sf).count() == (bins - 100) * zones


def test_stream_equals_batch_for_closed_windows(spark):
    from zonecast.plans import catalog as K
    sf = "/root/testdata/sf0.001"
    s = K.QUERIES["stream_zone_demand"](spark, sf)
    b = K._demand(spark, sf)
    cut = b.agg(F.max("time_bin")).first()[0]
    closed = b.where(F.col("time_bin") < cut - dt.timedelta(minutes=45))
    assert s.exceptAll(b).count() == 0                       # nothing the batch does not have
    assert closed.exceptAll(s).count() == 0                  # every clearly closed window emitted


def test_allocate_stream_foreach_batch(spark):
    from zonecast.operators.scenario import baseline_forecast
    from zonecast.plans import context as C
    from zonecast.streaming.demand_stream import allocate_stream
    import tempfile
    base = baseline_forecast(C.features(spark, "/root/testdata/sf0.001")).cache()
    src = tempfile.mkdtemp(prefix="req-")
    spark.createDataFrame([(1, T(17, 0, 5), 150), (2, None, None)],
                          "request_id int, request_ts timestamp_ntz, total_drivers int") \
        .write.mode("overwrite").parquet(src + "/in")
    got = []
    req = spark.readStream.schema("request_id int, request_ts timestamp_ntz, total_drivers int").parquet(src + "/in")
    q = allocate_stream(req, base, lambda df, eid: got.extend(df.collect())) \
        .option("checkpointLocation", src + "/chk").trigger(availableNow=True).start()
    q.awaitTermination()
    first = [r for r in got if r.request_id == 1]
    assert first and sum(r.allocated_drivers for r in first) in (150, len(first) * (150 // len(first)))


def test_ride_sample_is_exact_and_spread(spark):
    """exactly n distinct rides, spread over the whole id range (the
    sample order has no ties, so it is not the earliest rides of a key)."""
    from zonecast.operators.profiles import sample_rides
    from zonecast.plans import context as C
    from conftest import SF_SMALL
    r = C.rides(spark, SF_SMALL)
    lo, hi = r.agg(F.min("ride_id"), F.max("ride_id")).first()
    ids = [x.ride_id for x in sample_rides(r, 100).collect()]
    assert len(ids) == len(set(ids)) == 100
    deciles = [0] * 10
    for i in ids:
        deciles[min(9, (i - lo) * 10 // (hi - lo + 1))] += 1
    assert all(3 <= d <= 20 for d in deciles), deciles
    assert sample_rides(r, 10 ** 6).count() == r.count()      # n above the rows: all of them


def test_grid_fills_bin_gaps(spark):
    """C1 + C2: every bin from the first to the last, for every observed
    zone; bins without rides get demand 0 and no cancellations, and supply
    is carried from the last seen value (E4)."""
    d = spark.createDataFrame(
        [(T(0), "a", 3, 2.0, 1), (T(2), "b", 1, 5.0, 0)],
        "time_bin timestamp_ntz, zone_id string, demand long, active_drivers double, is_cancelled long")
    g = supply_fill(demand_grid(d, 900)).orderBy("time_bin", "zone_rank").collect()
    assert len(g) == 9 * 2                                      # 00:00 .. 02:00 by 15 min, 2 zones
    assert sum(r.demand for r in g) == 4 and sum(r.is_cancelled for r in g) == 1
    gap = [r for r in g if T(0) < r.time_bin < T(2)]
    assert len(gap) == 14 and all(r.demand == 0 and r.active_drivers == 2.0 for r in gap)
    assert [(r.zone_id, r.active_drivers) for r in g if r.time_bin == T(2)] == [("a", 2.0), ("b", 5.0)]


def test_weekday_profile_single_day(spark):
    """D5 on one day of data: all seven weekdays listed, six without a mean."""
    from zonecast.operators.profiles import dow_profile
    f = spark.createDataFrame([(2, 4), (2, 6)], "day_of_week int, demand long")   # Wednesday only
    rows = {r.day_of_week: r for r in dow_profile(f).collect()}
    assert sorted(rows) == list(range(7))
    assert rows[2].day_name == P.DAY_NAMES[2] and rows[2].avg_demand == 5.0
    assert all(rows[d].avg_demand is None for d in rows if d != 2)


def test_request_scoring_stream_equals_batch(spark):
    """L2: a file stream of requests scores exactly as the same batch."""
    import tempfile
    from zonecast.operators.forecast import train
    from zonecast.plans import context as C
    from zonecast.streaming.demand_stream import run_to_table
    from zonecast.streaming.request_scoring import history_lookup, score_requests
    sf = "/root/testdata/sf0.001"
    fc, data = train(C.features_table(spark, sf), max_iter=3)
    lookup = history_lookup(data.where(F.col("split") == "train")).cache()
    req = data.where(F.col("split") == "test").select(
        F.col("time_bin").alias("request_ts"), "zone_id", "active_drivers")
    src = tempfile.mkdtemp(prefix="score-") + "/in"
    req.repartition(3).write.parquet(src)
    batch = score_requests(spark.read.parquet(src), fc, lookup, C.zones(spark))
    stream = score_requests(spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1).parquet(src),
                            fc, lookup, C.zones(spark))
    got = run_to_table(spark, stream, "scored")
    assert got.count() == req.count() > 0
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def _allocation_by_rule(preds, fleet):
    """The allocation rule in plain Python (brute-force check of H1, H2, E8)."""
    total, n = sum(preds), len(preds)
    if total <= 0:
        return [int(fleet / n)] * n
    alloc = [round(p / total * fleet) for p in preds]          # round() is half-to-even
    first = min(range(n), key=lambda i: (-preds[i], f"z{i:02d}"))
    alloc[first] += fleet - sum(alloc)
    return alloc


def test_allocation_matches_rule_property(spark):
    """Random groups (whole-number demand, so sums are exact in any order):
    Spark's allocation equals the rule, and a group with demand allocates
    exactly its fleet."""
    from hypothesis import given, settings, strategies as st

    group = st.tuples(st.lists(st.integers(0, 40), min_size=1, max_size=12), st.integers(1, 400))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(group, min_size=1, max_size=25))
    def check(groups):
        rows = [(g, f"z{i:02d}", float(p), fleet)
                for g, (preds, fleet) in enumerate(groups) for i, p in enumerate(preds)]
        df = spark.createDataFrame(rows, "g int, zone_id string, predicted_demand double, fleet int")
        got = {}
        for r in allocate(df, ["g"], fleet=F.col("fleet")).collect():
            got.setdefault(r.g, {})[r.zone_id] = r.allocated_drivers
        for g, (preds, fleet) in enumerate(groups):
            want = _allocation_by_rule(preds, fleet)
            assert [got[g][f"z{i:02d}"] for i in range(len(preds))] == want
            if sum(preds) > 0:
                assert sum(want) == fleet

    check()


def test_supply_fill_matches_global_ffill_property(spark):
    """E4 + E5: the two-level fill equals a plain forward fill over the whole
    grid in (bin, first-appearance rank) order, on random sparse demand
    spread over several days (so the day blocks and their carries matter)."""
    from hypothesis import given, settings, strategies as st

    start = dt.datetime(2024, 1, 1)
    rec = st.tuples(st.integers(0, 3 * 96 - 1), st.sampled_from("abcde"),
                    st.one_of(st.none(), st.integers(1, 9)))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(rec, min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1])))
    def check(recs):
        rows = [(start + dt.timedelta(minutes=15 * b), z, 1, None if s is None else float(s), 0)
                for b, z, s in recs]
        d = spark.createDataFrame(
            rows, "time_bin timestamp_ntz, zone_id string, demand long, active_drivers double, is_cancelled long")
        got = {(r.time_bin, r.zone_id): r.active_drivers for r in supply_fill(demand_grid(d, 900)).collect()}
        first = {}
        for b, z, _ in recs:
            first[z] = min(first.get(z, b), b)
        zones = sorted(first, key=lambda z: (first[z], z))
        seen = {(b, z): s for b, z, s in recs}
        last, want = None, {}
        for b in range(min(first.values()), max(b for b, _, _ in recs) + 1):
            for z in zones:
                s = seen.get((b, z))
                last = float(s) if s is not None else last
                want[(start + dt.timedelta(minutes=15 * b), z)] = last if last is not None else 0.0
        assert got == want

    check()


def test_feature_forms_agree_hourly(spark):
    """The interval is a parameter: at 1 hour the shift form and the window
    form still agree, and lag_4 is the demand four hours earlier."""
    from zonecast.plans import context as C
    sf = "/root/testdata/sf0.01"
    shift, window, halo = (C.features(spark, sf, interval=3600, method=m).cache() for m in ("shift", "window", "halo"))
    assert shift.count() == window.count() == halo.count() > 0
    assert shift.exceptAll(window).count() == 0 and halo.exceptAll(window).count() == 0
    a = shift.select("time_bin", "zone_id", "lag_4")
    b = shift.select((F.col("time_bin") + F.expr("INTERVAL 4 HOURS")).alias("time_bin"), "zone_id",
                     F.col("demand").alias("lag_4"))
    assert a.join(b, ["time_bin", "zone_id", "lag_4"], "left_anti").where(
        F.col("time_bin") >= F.lit(shift.agg(F.min("time_bin")).first()[0]) + F.expr("INTERVAL 4 HOURS")
    ).count() == 0


def test_stream_of_part_files_in_mixed_order_equals_batch(spark, tmp_path):
    from zonecast.plans import context as C
    from zonecast.plans.catalog import _demand
    from zonecast.streaming.demand_stream import events_stream, run_to_table, zone_demand_stream
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    stream = zone_demand_stream(events_stream(spark, str(tmp_path), 1), C.centroids(), delay=None)
    path = f"{tmp_path}/job"
    got = run_to_table(spark, stream, keys=("time_bin", "zone_id"), path=path)
    want = _demand(spark, str(tmp_path))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    again = run_to_table(spark, stream, keys=("time_bin", "zone_id"), path=path)  # resumes: nothing new
    assert again.count() == want.count()


def test_every_ride_is_priced(spark):
    from zonecast.plans.catalog import QUERIES
    priced, rides = (QUERIES[q](spark, "/root/testdata/sf0.001") for q in ("trip_price", "rides_scan"))
    assert priced.count() == rides.count() == priced.where("price is not null").count()


def test_daily_queries_reach_every_branch(spark):
    from zonecast.plans.catalog import QUERIES
    alloc, bands = (QUERIES[q](spark, "/root/testdata/sf0.01") for q in ("alloc_daily", "surge_bands_daily"))
    assert {r[0] for r in alloc.select("action").distinct().collect()} == {"Request Influx", "Hold", "Move Out"}
    assert alloc.where("surge_multiplier > 1").count() and alloc.where("gap > 5").count()
    assert {r[0] for r in bands.select("surge_band").distinct().collect()} == {"low", "mid", "high"}


def test_unknown_zones_and_hours_are_kept(spark):
    from pyspark.sql import functions as F

    from zonecast.operators.scenario import scenario_alloc, scenario_grid, whole_week
    from zonecast.operators.zones import attach_centroids, fixed_zones
    rows = spark.createDataFrame([("0", 1), ("99", 2)], "zone_id string, n int")
    assert {(r.zone_id, r.zone_lat is None) for r in attach_centroids(rows, fixed_zones(spark)).collect()} == {("0", False), ("99", True)}
    fc = spark.createDataFrame([("0", 8, 1, 2.0, 2.2, 2.6), ("1", 8, 1, 4.0, 4.4, 5.2)],
                               "zone_id string, hour int, day_of_week int, pred_15m double, pred_30m double, pred_60m double")
    assert whole_week(fc).count() == 2 * 168
    seen = spark.createDataFrame([(8, 1), (3, 6)], "hour int, day_of_week int")
    out = scenario_alloc(scenario_grid(seen, fleets=(10, 20), fares=(5.0,), capacities=(1.0, 3.0)), fc)
    assert out.count() == 2 * 2 * 2 * 2
    per = out.groupBy("fleet", "capacity", "hour").agg(F.sum("allocated_drivers").alias("s"))
    assert per.where("s <> fleet").count() == 0


def test_sample_is_spread(spark):
    from zonecast.plans.catalog import QUERIES
    ids = sorted(r.ride_id for r in QUERIES["ride_sample"](spark, "/root/testdata/sf0.01").collect())
    gaps = {b - a for a, b in zip(ids, ids[1:], strict=False)}
    assert len(ids) == 1000 and len(gaps) > 30


def test_halo_blocks_equal_the_window(spark):
    """Blocks barely wider than their halo, zones of every length, one of a single bin;
    rows shuffled stay near one a grid row at the default block."""
    import datetime as dt
    import random

    from zonecast.operators.features import BLOCK, _halo_columns, _window_columns
    rng, start = random.Random(4), dt.datetime(2023, 2, 27, 22, 15)
    rows = [(start + dt.timedelta(minutes=15 * (i + 50 * z)), str(z), rng.randrange(9))
            for z, n in enumerate((1, 5, 96, 97, 400)) for i in range(n)]
    grid = spark.createDataFrame(rows, "time_bin timestamp_ntz, zone_id string, demand long").repartition(3).cache()
    want = _window_columns(grid)
    for block in (96, 100, BLOCK):
        got = _halo_columns(grid, 900, block).select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    with pytest.raises(ValueError, match="block"):
        _halo_columns(grid, 900, 95)
    assert (96 + 4) / BLOCK <= 0.2


def test_policy_solves_its_equation(spark):
    """q equals reward + 0.9 E[max q(next)] to 1e-6, with several actions a state; a state
    without a way on is worth nothing; ties go to the first action."""
    from zonecast.operators.policy import policy
    t = [("Balanced", "Day", "Hold", "Balanced", "Day", 3, 30.0), ("Balanced", "Day", "Hold", "Surplus", "Day", 1, 2.0),
         ("Balanced", "Day", "Move Out", "Surplus", "Day", 2, 40.0), ("Surplus", "Day", "Hold", "Balanced", "Day", 5, 5.0),
         ("Surplus", "Day", "Request Influx", "Balanced", "Day", 5, 5.0), ("Surplus", "Day", "Move Out", "Shortage", "Night", 1, 9.0)]
    names = "gap_level string, time_of_day string, action string, next_gap_level string, next_time_of_day string, transitions long, reward_sum double"
    rows = policy(spark.createDataFrame(t, names)).collect()
    q = {tuple(r[:3]): r.q for r in rows}
    v: dict = {}
    for (g, d, _), x in q.items():
        v[g, d] = max(v.get((g, d), x), x)
    for key, value in q.items():
        own = [r for r in t if r[:3] == key]
        n = sum(r[5] for r in own)
        assert value == pytest.approx(sum(r[6] for r in own) / n + 0.9 * sum(r[5] * v.get(r[3:5], 0.0) for r in own) / n, abs=1e-6)
    assert {(r.gap_level, r.greedy_action) for r in rows} == {("Balanced", "Move Out"), ("Surplus", "Hold")}
    assert sum(r.is_greedy for r in rows) == 2 and len(rows) == 5
    assert policy(spark.createDataFrame([], names)).count() == 0


def test_a_zone_without_a_centroid_is_an_error(spark):
    """The feature build names the zone instead of dropping its rows."""
    from zonecast.operators.features import build_features
    from zonecast.operators.zones import fixed_zones
    rides = spark.createDataFrame([(i, dt.datetime(2023, 1, 1) + dt.timedelta(minutes=9 * i), 37.7, -122.4, 3.0, 0) for i in range(400)],
                                  "ride_id long, ride_ts timestamp_ntz, pickup_lat double, pickup_long double, active_drivers double, is_cancelled int")
    known, centroids = fixed_zones(spark, [("0", 37.7, -122.4)]), [("99", 37.7, -122.4)]
    with pytest.raises(Exception, match="unknown zone 99"):
        build_features(rides, known, centroids=centroids).collect()
    assert build_features(rides, known).count() > 0


def test_labels(spark):
    from zonecast.functions.pricing import gap_label, surge_label
    values = [0.25, -0.25, 0.75, 12.0, -3.5, 0.0, 1.0625]
    df = spark.createDataFrame([(v,) for v in values], "g double")
    assert [r[0] for r in df.select(gap_label(F.col("g"))).collect()] == [f"{v:+.1f}" for v in values]
    assert [r[0] for r in df.select(surge_label(F.col("g"))).collect()][3:6] == ["12.0x", "-3.5x", "0.0x"]
