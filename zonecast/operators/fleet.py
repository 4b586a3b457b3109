"""Fleet allocation, surge, revenue and KPIs per group.

The reference allocates one time bin (or one what-if scenario) at a time.
Here every group is allocated in the same job: all windows are partitioned
by the group key (a bin or a scenario), and a group holds one row per zone,
so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.pricing import (action_label, allocation_surge, conversion_rate,
                                 demand_supply_ratio, optimal_supply)

ALLOC_COLUMNS = ("prob", "allocated_drivers", "optimal_supply", "gap", "dsr",
                 "surge_multiplier", "action")
REVENUE_COLUMNS = ("conversion_rate", "effective_demand", "fulfilled_rides", "revenue")


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def allocate(df: DataFrame, group_cols: Sequence[str], fleet=P.PIPELINE_FLEET,
             demand_col: str = "predicted_demand", tie_cols: Sequence[str] = ("zone_id",),
             capacity: float = P.CAPACITY_PER_DRIVER, shortage: float = P.SHORTAGE_LIMIT,
             surplus: float = P.SURPLUS_LIMIT) -> DataFrame:
    """Proportional allocation of ``fleet`` drivers per group.

    allocated = rint(share * fleet); the remainder fleet - sum(allocated),
    possibly negative, goes to the zone with the largest demand (first in
    ``tie_cols`` order on ties). A group whose total demand is <= 0 gives
    every zone int(fleet / zones) (H2) and no share. ``fleet`` is a number or
    a column (per-scenario fleet).
    """
    pred = F.col(demand_col)
    fleet_c = _as_col(fleet)
    g = Window.partitionBy(*group_cols)
    ranked = Window.partitionBy(*group_cols).orderBy(pred.desc(), *[F.col(c) for c in tie_cols])
    d = df.withColumns({
        "__total": F.sum(pred).over(g),
        "__n": F.count(F.lit(1)).over(g),
        "__rn": F.row_number().over(ranked),
    })
    prob = F.when(F.col("__total") > 0, pred / F.col("__total"))
    d = d.withColumn("prob", prob)
    d = d.withColumn("__a0", F.rint(F.col("prob") * fleet_c).cast("int"))
    d = d.withColumn("__diff", fleet_c - F.sum("__a0").over(g))
    allocated = (F.when(F.col("__total") <= 0, (fleet_c / F.col("__n")).cast("int"))
                 .otherwise(F.col("__a0") + F.when(F.col("__rn") == 1, F.col("__diff")).otherwise(0)))
    d = d.withColumn("allocated_drivers", allocated.cast("int"))
    drivers = F.col("allocated_drivers")
    d = d.withColumns({
        "optimal_supply": optimal_supply(pred, capacity),
        "gap": pred - drivers,
        "dsr": demand_supply_ratio(pred, drivers),
    })
    d = d.withColumns({
        "surge_multiplier": allocation_surge(F.col("dsr")),
        "action": action_label(F.col("gap"), shortage, surplus),
    })
    return d.drop("__total", "__n", "__rn", "__a0", "__diff")


def add_revenue(df: DataFrame, fare=P.DEFAULT_FARE, capacity: float = P.CAPACITY_PER_DRIVER,
                elasticity: float = P.ELASTICITY, demand_col: str = "predicted_demand") -> DataFrame:
    """Conversion, effective demand, fulfilled rides, revenue."""
    surge = F.col("surge_multiplier")
    d = df.withColumn("conversion_rate", conversion_rate(surge, elasticity))
    d = d.withColumn("effective_demand", F.col(demand_col) * F.col("conversion_rate"))
    d = d.withColumn("fulfilled_rides", F.least(F.col("effective_demand"),
                                                F.col("allocated_drivers") * F.lit(capacity)))
    return d.withColumn("revenue", F.col("fulfilled_rides") * (_as_col(fare) * surge))


def fleet_kpis(df: DataFrame, group_cols: Sequence[str], demand_col: str = "predicted_demand",
               shortage: float = P.SHORTAGE_LIMIT) -> DataFrame:
    """D17 + D18 + B5 per group: revenue, service level, mean surge, total
    demand, zones, shortage zones. One partial aggregate; no window."""
    pred = F.col(demand_col)
    total = F.sum(pred)
    return df.groupBy(*group_cols).agg(
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.try_divide(F.sum("fulfilled_rides"), total) * 100, 1).alias("service_level"),
        F.round(F.avg("surge_multiplier"), 2).alias("avg_surge"),
        total.alias("total_demand"),
        F.count(F.lit(1)).alias("zones"),
        F.count_if(F.col("gap") > shortage).alias("shortage_zones"),
        F.sum("allocated_drivers").alias("allocated_total"),
    )


def revenue_share(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Each zone's share of the group's revenue."""
    w = Window.partitionBy(*group_cols)
    return df.withColumn("revenue_share", F.try_divide(F.col("revenue"), F.sum("revenue").over(w)))


def top_by_demand(df: DataFrame, group_cols: Sequence[str], n: int = 10,
                  demand_col: str = "predicted_demand",
                  tie_cols: Sequence[str] = ("zone_id",)) -> DataFrame:
    """the n zones of largest demand per group, first on ties."""
    w = Window.partitionBy(*group_cols).orderBy(F.col(demand_col).desc(), *[F.col(c) for c in tie_cols])
    return df.withColumn("demand_rank", F.row_number().over(w)).where(F.col("demand_rank") <= n)


def action_mix(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Action counts, descending, with their share."""
    counts = df.groupBy(*group_cols, "action").agg(F.count(F.lit(1)).alias("zones"))
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    return counts.withColumn("share", F.col("zones") / F.sum("zones").over(w))
