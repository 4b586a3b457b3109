"""Generator rate table and supply regimes, re-aimed as queries.

The reference's generator draws rides per 5-minute window at rate
5 x hour weight x day weight and raises the cancellation probability when
the window's drivers are fewer than its rides. Instead of simulating, these
compare the observed rides with that model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.timefn import time_floor, weekday_mon0
from ..session import materialize
from .scans import time_spine


def _lookup(values, idx: Column) -> Column:
    """Literal-array lookup (a 24- or 7-entry table): no join needed."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), idx + 1)


def expected_rate(rides: DataFrame, window_s: int = P.SUPPLY_WINDOW_SECONDS) -> DataFrame:
    """Per (weekday, hour): windows in the observed span, expected rides
    (sum of base x hour weight x day weight over the windows) and observed
    rides."""
    w = rides.select(time_floor(F.col("ride_ts"), window_s).alias("win"))
    # one pass over the rides; the per-window counts (one row per window)
    # are written once and feed both the bounds and the join below
    observed = materialize(w.groupBy("win").agg(F.count(F.lit(1)).alias("rides")), "window-rides")
    bounds = observed.agg(F.min("win").alias("lo"), F.max("win").alias("hi"))   # from the aggregate
    spine = time_spine(bounds, "lo", "hi", window_s, out_col="win")
    rate = (F.lit(P.BASE_RATE_PER_5MIN) * _lookup(P.HOUR_WEIGHTS, F.hour("win"))
            * _lookup(P.DAY_WEIGHTS, weekday_mon0(F.col("win"))))
    per_win = spine.join(observed, "win", "left").select(
        weekday_mon0(F.col("win")).alias("day_of_week"), F.hour("win").alias("hour"),
        rate.alias("expected"), F.coalesce(F.col("rides"), F.lit(0)).alias("rides"))
    return per_win.groupBy("day_of_week", "hour").agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum("expected").alias("expected_rides"),
        F.sum("rides").alias("observed_rides"),
    ).withColumn("ratio", F.try_divide(F.col("observed_rides"), F.col("expected_rides")))


def cancel_by_regime(rides: DataFrame, window_s: int = P.SUPPLY_WINDOW_SECONDS) -> DataFrame:
    """Each 5-minute window is 'shortage' when its drivers are fewer
    than its rides, else 'normal'; cancellation rate per regime next to the
    generator's probability for it."""
    per_win = rides.groupBy(time_floor(F.col("ride_ts"), window_s).alias("win")).agg(
        F.count(F.lit(1)).alias("rides"), F.max("active_drivers").alias("drivers"),
        F.sum("is_cancelled").alias("cancelled"))
    regime = F.when(F.col("drivers") < F.col("rides"), F.lit("shortage")).otherwise(F.lit("normal"))
    r = per_win.withColumn("regime", regime).groupBy("regime").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("rides").alias("rides"),
        F.sum("cancelled").cast("long").alias("cancelled"))
    model_p = F.when(F.col("regime") == "shortage", F.lit(P.CANCEL_P_SHORTAGE)).otherwise(F.lit(P.CANCEL_P_NORMAL))
    return r.select("regime", "windows", "rides", "cancelled",
                    (F.col("cancelled") / F.col("rides")).alias("cancel_rate"),
                    model_p.alias("model_cancel_p"))
