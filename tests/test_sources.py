"""Sources, sinks and persistence (A1-A8): round trips through the writers."""

import tempfile

import pytest
from pyspark.sql import functions as F

from zonecast.sources.rides import read_features, read_rides_csv
from zonecast.sources.tables import build_if_absent, require_path, write_table

from conftest import SF_SMALL


def test_missing_input_guard():
    with pytest.raises(FileNotFoundError):
        require_path("/nonexistent/rides.csv")


def test_ride_csv_round_trip(spark):
    from zonecast.plans import context as C
    rides = C.rides(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="rides-") + "/csv"
    write_table(rides.withColumnRenamed("ride_ts", "timestamp")
                .select("timestamp", "pickup_lat", "pickup_long", "active_drivers", "is_cancelled", "ride_id"),
                out, fmt="csv")
    back = read_rides_csv(spark, out)
    assert back.columns == list(rides.columns)
    assert back.exceptAll(rides).count() == 0 and rides.exceptAll(back).count() == 0


def test_feature_sink_partitioned_overwrite(spark):
    from zonecast.plans import context as C
    f = C.features(spark, SF_SMALL).withColumn("date", F.to_date("time_bin"))
    out = tempfile.mkdtemp(prefix="feat-") + "/t"
    write_table(f, out, partition_by=("date",))
    first_day = f.agg(F.min("date")).first()[0]
    # overwrite one day only: the others stay
    write_table(f.where(F.col("date") == first_day), out, partition_by=("date",))
    back = read_features(spark, out)
    assert back.count() == f.count()
    assert dict(back.dtypes)["zone_id"] == "string"


def test_build_if_absent(spark):
    out = tempfile.mkdtemp(prefix="bia-") + "/t"
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert build_if_absent(spark, out, build).count() == 5
    assert build_if_absent(spark, out, build).count() == 5
    assert len(calls) == 1


def test_kmeans_save_load(spark):
    from zonecast.operators.zones import fit_kmeans, load_kmeans, save_kmeans
    from zonecast.plans import context as C
    model, cost = fit_kmeans(C.rides(spark, SF_SMALL), k=4, n_init=2, max_iter=5)
    path = tempfile.mkdtemp(prefix="km-") + "/m"
    save_kmeans(model, path)
    assert len(load_kmeans(path).clusterCenters()) == 4 and cost > 0


def test_forecaster_save_load_and_metrics(spark):
    from zonecast.operators.forecast import Forecaster, metrics, train
    from zonecast.plans import context as C
    fc, data = train(C.features(spark, SF_SMALL), max_iter=3)
    path = tempfile.mkdtemp(prefix="fc-") + "/m"
    fc.save(path)
    back = Forecaster.load(path)
    assert set(back.models) == {"15m", "30m", "60m"}
    m = {r.horizon: r for r in metrics(back.predict(data)).collect()}
    assert set(m) == {"15m", "30m", "60m"} and all(r.rmse >= 0 for r in m.values())
    preds = back.predict(data).select("pred_15m", "pred_30m", "pred_60m")
    assert preds.where((F.col("pred_15m") < 0) | (F.col("pred_60m") < 0)).count() == 0


def test_kmeans_folded_duplicates_keep_the_objective(spark):
    """Each point twice: the folded (weighted) fit's cost equals the sum
    over the raw points of the squared distance to the nearest centre."""
    from zonecast.operators.zones import fit_kmeans
    from zonecast.plans import context as C
    r = C.rides(spark, SF_SMALL).select("pickup_lat", "pickup_long")
    doubled = r.unionByName(r)
    # tol 0: run until no centre moves, so the reported cost is at the final centres
    model, cost = fit_kmeans(doubled, k=4, n_init=1, max_iter=300, tol=0.0)
    centres = [tuple(map(float, c)) for c in model.clusterCenters()]
    d2 = F.least(*[(F.col("pickup_lat") - a) ** 2 + (F.col("pickup_long") - b) ** 2 for a, b in centres])
    raw = doubled.agg(F.sum(d2)).first()[0]
    assert raw == pytest.approx(cost, rel=1e-9)


def test_forecast_keeps_the_best_round_under_patience(spark):
    """The kept trees end at the validation errors' least round, and the trees of a
    fit with more patience begin with them; a saved model forecasts the same."""
    from zonecast.operators import forecast as fo
    from zonecast.plans import catalog, context as C
    assert catalog.ML_ITER == 500
    ft = C.features_table(spark, SF_SMALL)
    data = fo.prepare(ft)
    fc, _ = fo.train(ft, max_iter=12, step_size=0.9, horizons=fo.P.HORIZONS[:2], patience=3, data=data)
    full, _ = fo.train(ft, max_iter=12, step_size=0.9, horizons=fo.P.HORIZONS[:2], patience=12, data=data)
    val = data.where("is_val").toPandas()
    x = val[fc.features].to_numpy(dtype=float)
    for h, target in fo.P.HORIZONS[:2]:
        short, whole = fc.models[h], full.models[h]
        errors, y = [], val[target].to_numpy(dtype=float)
        for n in range(len(whole.trees) + 1):
            errors.append(((type(whole)(whole.base, whole.trees[:n]).predict(x) - y) ** 2).sum())
        assert len(whole.trees) == min(range(len(errors)), key=errors.__getitem__)
        assert 0 < len(short.trees) <= len(whole.trees)
        for a, b in zip(short.trees, whole.trees, strict=False):
            assert all((a[f] == b[f]).all() for f in a)
    path = tempfile.mkdtemp(prefix="fc-") + "/m"
    fc.save(path)
    back = fo.Forecaster.load(path)
    cols = ("time_bin", "zone_id", "pred_15m", "pred_30m")
    a, b = (f.predict(data).select(*cols) for f in (fc, back))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_forecast_fit_is_reproducible(spark):
    """Same data: the same trees (row layout fixed before the fit)."""
    from zonecast.operators.forecast import train
    from zonecast.plans import context as C
    ft = C.features_table(spark, SF_SMALL)
    (a, _), (b, _) = train(ft, max_iter=3), train(ft.repartition(5), max_iter=3)
    for h in a.models:
        assert len(a.models[h].trees) == 3
        for t, u in zip(a.models[h].trees, b.models[h].trees, strict=True):
            assert all((t[f] == u[f]).all() for f in t)


def test_kmeans_fit_is_reproducible(spark):
    from zonecast.operators.zones import fit_kmeans
    from zonecast.plans import context as C
    r = C.rides(spark, SF_SMALL)
    (m1, c1), (m2, c2) = (fit_kmeans(r, k=5, n_init=2, max_iter=10) for _ in range(2))
    assert c1 == c2
    assert [list(c) for c in m1.clusterCenters()] == [list(c) for c in m2.clusterCenters()]


def test_row_id_is_consecutive_in_scan_order(spark):
    """E11 over a multi-file table: ids 1..N, each file's rows consecutive
    and in file order."""
    import pyarrow.parquet as pq
    from zonecast.operators.scans import with_row_id
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts")
    path = tempfile.mkdtemp(prefix="rowid-") + "/t"
    ev.repartition(4, "event_id").sortWithinPartitions("ts", "event_id").write.parquet(path)
    t = spark.read.parquet(path).withColumn("__file", F.input_file_name())
    rows = with_row_id(t, "rid").select("__file", "event_id", "rid").collect()
    n = len(rows)
    assert n == ev.count() and sorted(r.rid for r in rows) == list(range(1, n + 1))
    by_id = {r.event_id: r.rid for r in rows}
    for f in sorted({r["__file"] for r in rows}):
        ids = [by_id[e] for e in pq.read_table(f.replace("file://", "")).column("event_id").to_pylist()]
        assert ids == list(range(ids[0], ids[0] + len(ids)))


def test_feature_list_follows_present_columns(spark):
    """The 15 base features, then active_drivers and gap only when the
    table has them (and in that order)."""
    from zonecast import params as P
    from zonecast.operators.forecast import feature_list
    from zonecast.plans import context as C
    ft = C.features_table(spark, SF_SMALL)
    assert len(P.BASE_FEATURES) == 15
    assert feature_list(ft) == list(P.BASE_FEATURES) + ["active_drivers", "gap"]
    assert feature_list(ft.drop("gap")) == list(P.BASE_FEATURES) + ["active_drivers"]
    assert feature_list(ft.drop("active_drivers", "gap")) == list(P.BASE_FEATURES)
    assert feature_list(ft, with_supply=False) == list(P.BASE_FEATURES)


def test_metrics_equal_regression_evaluator(spark):
    """The one-aggregate RMSE / MAE / R2 equal Spark ML's evaluator."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from zonecast.operators.forecast import metrics, train
    from zonecast.plans import context as C
    fc, data = train(C.features_table(spark, SF_SMALL), max_iter=3)
    test = fc.predict(data.where(F.col("split") == "test")).cache()
    m = {r.horizon: r for r in metrics(test).collect()}
    for h, target in (("15m", "target_15m"), ("30m", "target_30m"), ("60m", "target_60m")):
        df = test.select(F.col(target).cast("double").alias("y"), F.col(f"pred_{h}").alias("p"))
        for name in ("rmse", "mae", "r2"):
            want = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
            assert getattr(m[h], name) == pytest.approx(want, rel=1e-9, abs=1e-12)
