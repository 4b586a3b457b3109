"""Histogram boosting (J5, J6, J8, J9) against plain Python; equi-depth ranges."""

import pickle
import random
import time

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from zonecast.operators import boosting
from zonecast.operators.forecast import Forecaster, importance_table, model_card, nodes
from zonecast.operators.profiles import quantiles, ranked_values

FEATURES = ("a", "b", "c")
TARGETS = (("15m", "y"), ("30m", "z"))


@pytest.fixture(scope="module")
def rows():
    """Whole numbers, so that sums are the same in any order."""
    rng = random.Random(3)
    out = []
    for i in range(400):
        a, b, c = rng.randrange(6), rng.randrange(40), rng.choice([0.5, 1.5, 7.0])
        out.append((i, a, b, c, 3 * (a > 2) + b // 10, (b > 20) * 5 + rng.randrange(2), i % 5 == 0))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id long, a int, b int, c double, y long, z long, is_val boolean").repartition(3).cache()


def plain_tree(x, r, leaves, levels, min_rows):
    """(feature, cut) -> the best splits level by level, by trying every cut."""
    parts, splits, done = [np.arange(len(x))], 0, []
    for _ in range(levels):
        found = []
        for i, own in enumerate(parts):
            best = None
            for f in range(x.shape[1]):
                for cut in np.unique(x[own, f])[:-1]:
                    left = own[x[own, f] <= cut]
                    if min(len(left), len(own) - len(left)) < min_rows:
                        continue
                    sl, s = r[left].sum(), r[own].sum()
                    gain = sl ** 2 / len(left) + (s - sl) ** 2 / (len(own) - len(left)) - s ** 2 / len(own)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, cut, left, np.setdiff1d(own, left))
            if best and best[0] > 1e-9:
                found.append((best, i))
        found = sorted(found, key=lambda b: -b[0][0])[:leaves - 1 - splits]
        splits += len(found)
        for (gain, f, cut, left, right), i in found:
            parts[i] = None
            parts += [left, right]
            done.append((f, float(cut), gain))
        parts = [p for p in parts if p is not None]
    out = np.zeros(len(x))
    for own in parts:
        out[own] = r[own].mean()
    return done, out


@pytest.mark.parametrize(("leaves", "levels", "block"), [(4, 3, 10_000), (6, 4, 60), (31, 5, 10_000)])
def test_trees_equal_trying_every_cut(rows, table, leaves, levels, block):
    """Every split, its gain and the forecasts of three rounds; one block or many."""
    models = boosting.fit(table, FEATURES, TARGETS, "is_val", ("id",), rounds=3, rate=0.5, leaves=leaves, levels=levels,
                          min_rows=10, patience=9, rows_per_block=block)
    x = np.array([r[1:4] for r in rows], dtype=float)
    fit = np.array([not r[6] for r in rows])
    for k, (h, _) in enumerate(TARGETS):
        y = np.array([r[4 + k] for r in rows], dtype=float)
        now = np.full(len(x), y[fit].mean())
        assert models[h].base == pytest.approx(y[fit].mean())
        for t in models[h].trees:
            splits, step = plain_tree(x[fit], (y - now)[fit], leaves, levels, 10)
            got = sorted(float(g) for f, g in zip(t["feature"], t["gain"], strict=True) if f >= 0)
            assert got == pytest.approx(sorted(g for *_, g in splits), rel=1e-6)
            grown = boosting.Trees(0.0, [t]).predict(x)
            assert grown[fit] == pytest.approx(0.5 * step, abs=1e-6)
            leaf = t["feature"] < 0
            assert t["rows"][leaf].sum() == fit.sum() and t["rows"][0] == fit.sum() and leaf.sum() <= leaves
            now = now + grown


def test_cuts_hold_equal_shares(spark):
    values = [1] * 500 + list(range(100, 1100)) + [10 ** 12]
    df = spark.createDataFrame([(v, 7) for v in values], "v long, w int")
    wide, flat = boosting.feature_cuts(df, ["v", "w"], 10)
    assert len(flat) == 0
    assert 6 <= len(wide) <= 9 and wide[0] == 1 and (np.diff(wide) > 0).all() and wide[-1] < 1100


def test_an_outlier_leaves_the_ranges_even(spark):
    """One value of 1e12 among thousands: no range holds above twice the mean number
    of distinct values, and the quantiles stay exact."""
    rng = random.Random(1)
    values = [rng.random() for _ in range(6000)] + [1e12] + [0.25] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranked_values(df, ["v"]).groupBy("block").count().collect()]
        got = quantiles(df, ["v"]).first()["q"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert got == pytest.approx(list(np.percentile(values, [25, 50, 75])))


def test_forecasts_are_clamped_and_keep_rows(spark, table):
    models = {"15m": boosting.Trees(-2.0, []), "30m": boosting.Trees(1.5, [])}
    got = boosting.predict(table, models, FEATURES).select("id", "pred_15m", "pred_30m").collect()
    assert len(got) == 400 and {(r.pred_15m, r.pred_30m) for r in got} == {(0.0, 1.5)}
    assert boosting.predict(table.where("id < 0"), models, FEATURES).count() == 0


def test_no_training_rows_is_an_error(table):
    with pytest.raises(ValueError, match="training rows"):
        boosting.fit(table.where("is_val"), FEATURES, TARGETS, "is_val", ("id",), rounds=1)


def test_importance_and_card_from_500_trees(spark):
    """Counts equal a walk over the trees, in seconds that don't follow the driver."""
    rng = np.random.default_rng(5)
    trees = []
    for _ in range(500):
        feature = np.array([rng.integers(0, 3), rng.integers(0, 3), -1, -1, -1], dtype=np.int32)
        trees.append({"feature": feature, "cut": rng.random(5), "left": np.array([1, 3, -1, -1, -1], dtype=np.int32),
                      "right": np.array([2, 4, -1, -1, -1], dtype=np.int32), "value": rng.random(5),
                      "gain": np.where(feature >= 0, rng.random(5), 0.0), "rows": np.full(5, 9, dtype=np.int64)})
    fc = Forecaster(["a", "b", "c", "unused"], {"15m": boosting.Trees(1.0, trees), "30m": boosting.Trees(2.0, [])}, {"step_size": 0.05})
    importance_table(spark, fc).collect()                                # compiled once
    begin = time.time()
    table, card = importance_table(spark, fc).collect(), {r.horizon: r for r in model_card(spark, fc).collect()}
    assert time.time() - begin < 6
    want = {f: sum(int((t["feature"] == i).sum()) for t in trees) for i, f in enumerate(fc.features)}
    assert {r.feature: r.splits for r in table if r.horizon == "15m"} == want
    assert [r.rank for r in sorted((r for r in table if r.horizon == "15m"), key=lambda r: r.rank)] == [1, 2, 3, 4]
    assert sum(r.importance for r in table if r.horizon == "15m") == pytest.approx(1)
    assert (card["15m"].num_trees, card["15m"].total_nodes, card["15m"].num_leaves) == (500, 2500, 1500)
    assert (card["30m"].num_trees, card["30m"].num_leaves) == (0, 0)
    back = boosting.models_of(nodes(spark, fc), {"15m": 1.0, "30m": 2.0})
    x = rng.random((50, 4))
    assert (back["15m"].predict(x) == fc.models["15m"].predict(x)).all() and not back["30m"].trees


@pytest.mark.parametrize(("block", "fan"), [(10_000, 32), (40, 32), (40, 2)])
def test_histograms_stay_in_the_cluster(spark, monkeypatch, block, fan):
    """What the driver gets of a pass follows the leaves, not features and codes; the
    trees are the same however the partial sums are gathered."""
    rng = random.Random(8)
    rows = [(i, *[rng.random() for _ in FEATURES], rng.randrange(64), rng.randrange(64), False) for i in range(512)]
    table = spark.createDataFrame(rows, "id long, a double, b double, c double, y long, z long, is_val boolean").repartition(3).cache()
    sizes, collect = [], RDD.collect

    def counted(self):
        out = collect(self)
        sizes.append(len(pickle.dumps(out)))
        return out

    args = (table, FEATURES, TARGETS, "is_val", ("id",), 1, 0.5, 16, 4, 10)
    want = boosting.fit(*args, rows_per_block=10_000)
    monkeypatch.setattr(RDD, "collect", counted)
    monkeypatch.setattr(boosting, "FAN", fan)
    got = boosting.fit(*args, rows_per_block=block)
    # a set of histograms is 765 codes of 16 bytes a leaf and target: 24 KB and more a pass
    assert len(sizes) > 4 and max(sizes) < 6000
    for h, _ in TARGETS:
        for f in ("feature", "cut", "left", "right", "rows"):
            assert (got[h].trees[0][f] == want[h].trees[0][f]).all()
        assert got[h].trees[0]["value"] == pytest.approx(want[h].trees[0]["value"], abs=1e-9)
