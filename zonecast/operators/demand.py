"""Zone demand, the dense (bin x zone) grid and the supply fill.

B1 D1 D2 C1 C2 E4 E5.

Plan shape (rides are the only large input):

* ``zone_demand``: one aggregate on (time_bin, zone_id); count / avg / sum
  are algebraic, so Spark combines map-side before the shuffle and a hot
  zone costs no more than a cold one.
* ``demand_grid``: bins x observed zones. The per-zone table has at most
  as many rows as the zone table (k). The bin sequence is generated in
  chunks of ``chunk`` bins that are spread over tasks, so no task makes a
  whole zone's history.  The left join of demand onto the grid is written
  as union + aggregate on a partitioning by day, which the fill then reuses
  without another shuffle.
* ``supply_fill``: the reference carries the last seen supply forward in
  (bin, zone order) across *all* zones. One scan a day (a window over 96 bins x
  k zones at 15 minutes), one row a day with the day's last value, carried over
  the days, and one join of that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.timefn import interval_seconds, time_floor
from .scans import DAY_SECONDS, time_spine

DAY = "__day"


def zone_demand(rides: DataFrame, interval: str | int = P.INTERVAL_SECONDS,
                ts_col: str = "ride_ts") -> DataFrame:
    """Per (time_bin, zone_id) ride count, mean supply, cancellations.

    Supply and cancellation columns are aggregated only when present.
    """
    cols = set(rides.columns)
    aggs = [F.count("ride_id").alias("demand")]
    if "active_drivers" in cols:
        aggs.append(F.avg("active_drivers").alias("active_drivers"))
    if "is_cancelled" in cols:
        aggs.append(F.sum("is_cancelled").cast("long").alias("is_cancelled"))
    return (rides.withColumn("time_bin", time_floor(F.col(ts_col), interval))
            .groupBy("time_bin", "zone_id").agg(*aggs))


def zone_extent(demand: DataFrame) -> DataFrame:
    """D2 + E5: one row per observed zone with its first-appearance rank
    and the global bin extent. At most k rows (k = zone table size), so the
    two small windows here are cheap."""
    z = demand.groupBy("zone_id").agg(F.min("time_bin").alias("first_bin"),
                                      F.max("time_bin").alias("last_bin"))
    everything = Window.partitionBy()
    return z.select(
        "zone_id",
        F.row_number().over(Window.orderBy("first_bin", "zone_id")).alias("zone_rank"),
        F.min("first_bin").over(everything).alias("grid_start"),
        F.max("last_bin").over(everything).alias("grid_end"),
    )


def grid_spine(extent: DataFrame, interval: str | int = P.INTERVAL_SECONDS) -> DataFrame:
    """Every bin from grid_start to grid_end for every zone in ``extent``
    (chunked generation, see ``scans.time_spine``)."""
    spine = time_spine(extent, "grid_start", "grid_end", interval_seconds(interval),
                       keys=("zone_id", "zone_rank"), out_col="time_bin")
    return spine.select("time_bin", "zone_id", "zone_rank")


def demand_grid(demand: DataFrame, interval: str | int = P.INTERVAL_SECONDS) -> DataFrame:
    """C1 + C2: dense grid; demand and cancellations 0 where no ride was seen,
    supply left null (``supply_fill`` fills it).

    Output partitioned by day; columns time_bin, zone_id,
    zone_rank, demand, active_drivers (raw), is_cancelled.
    """
    return _day_rows(demand, interval).drop(DAY)


def filled_grid(demand: DataFrame, interval: str | int = P.INTERVAL_SECONDS) -> DataFrame:
    """``supply_fill`` of the ``demand_grid``, in the grid's own partitioning."""
    return supply_fill(_day_rows(demand, interval))


def _day(time_bin: str = "time_bin") -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", epoch, F.col(time_bin)) / DAY_SECONDS)


def _day_rows(demand: DataFrame, interval: str | int) -> DataFrame:
    """The grid with its day, partitioned by it."""
    extent = zone_extent(demand)
    spine = grid_spine(extent, interval)
    has_supply = "active_drivers" in demand.columns
    has_cancel = "is_cancelled" in demand.columns
    null_d = F.lit(None).cast("double")
    grid_rows = spine.select(
        "time_bin", "zone_id", "zone_rank", F.lit(0).cast("long").alias("demand"),
        null_d.alias("active_drivers"), F.lit(0).cast("long").alias("is_cancelled"))
    ranks = F.broadcast(extent.select("zone_id", "zone_rank"))  # k rows
    seen = demand.join(ranks, "zone_id").select(
        "time_bin", "zone_id", "zone_rank", "demand",
        (F.col("active_drivers") if has_supply else null_d).alias("active_drivers"),
        (F.col("is_cancelled") if has_cancel else F.lit(0).cast("long")).alias("is_cancelled"))
    merged = (grid_rows.unionByName(seen).withColumn(DAY, _day()).repartition(DAY)
              .groupBy(DAY, "time_bin", "zone_id", "zone_rank")
              .agg(F.sum("demand").alias("demand"),
                   F.max("active_drivers").alias("active_drivers"),
                   F.sum("is_cancelled").alias("is_cancelled")))
    cols = [DAY, "time_bin", "zone_id", "zone_rank", "demand"]
    if has_supply:
        cols.append("active_drivers")
    if has_cancel:
        cols.append("is_cancelled")
    return merged.select(*cols)


def supply_fill(grid: DataFrame) -> DataFrame:
    """Carry supply forward in (time_bin, zone_rank) order across all
    zones, then 0. Grid must carry ``zone_rank`` (E5)."""
    if "active_drivers" not in grid.columns:
        return grid.drop(DAY)
    ad = F.col("active_drivers")
    g = grid if DAY in grid.columns else grid.withColumn(DAY, _day())
    upto = (Window.partitionBy(DAY).orderBy("time_bin", "zone_rank")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = g.groupBy(DAY).agg(F.max_by(ad, F.when(ad.isNotNull(), F.struct("time_bin", "zone_rank"))).alias("_last"))
    earlier = Window.orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)          # one row a day
    carry = last.select(DAY, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    return (g.withColumn("_in", F.last(ad, ignorenulls=True).over(upto)).join(carry, DAY)
            .withColumn("active_drivers", F.coalesce(F.col("_in"), F.col("_carry"), F.lit(0.0)))
            .drop("_in", "_carry", DAY))
