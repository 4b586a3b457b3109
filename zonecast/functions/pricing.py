"""Surge, price, conversion and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def demand_supply_ratio(demand: Column, drivers: Column, eps: float = P.DSR_EPSILON) -> Column:
    """H5: demand / (drivers + eps)."""
    return demand / (drivers + F.lit(eps))


def allocation_surge(dsr: Column, slope: float = P.ALLOC_SURGE_SLOPE,
                     shift: float = P.ALLOC_SURGE_SHIFT, floor: float = P.SURGE_FLOOR,
                     cap: float = P.SURGE_CAP) -> Column:
    """H6: 1 when dsr <= 1, else clip(1 + slope * ln(dsr + shift), floor, cap)."""
    curve = F.lit(1.0) + F.lit(slope) * F.ln(dsr + F.lit(shift))
    return F.when(dsr > 1, F.least(F.lit(cap), F.greatest(F.lit(floor), curve))).otherwise(F.lit(1.0))


def point_surge(demand: Column, supply: Column, slope: float = P.POINT_SURGE_SLOPE,
                shift: float = P.POINT_SURGE_SHIFT, floor: float = P.SURGE_FLOOR,
                cap: float = P.SURGE_CAP) -> Column:
    """H7: supply 0 -> cap; dsr <= 1 -> 1; else round(clip(curve), 2)."""
    dsr = F.try_divide(demand, supply)   # no division by zero in ANSI mode
    curve = F.lit(1.0) + F.lit(slope) * F.ln(dsr + F.lit(shift))
    return (F.when(supply == 0, F.lit(cap))
            .when(dsr <= 1, F.lit(1.0))
            .otherwise(F.round(F.least(F.greatest(F.lit(floor), curve), F.lit(cap)), 2)))


def trip_price(distance_km: Column, duration_min: Column, surge: Column,
               base: float = P.PRICE_BASE_FARE, per_km: float = P.PRICE_PER_KM,
               per_min: float = P.PRICE_PER_MIN) -> Column:
    """H8: (base + per_km * km + per_min * min) * surge, rounded to 2."""
    cost = F.lit(base) + distance_km * F.lit(per_km) + duration_min * F.lit(per_min)
    return F.round(cost * surge, 2)


def optimal_supply(demand: Column, capacity: float = P.CAPACITY_PER_DRIVER) -> Column:
    """H3: ceil(demand / capacity) as DOUBLE."""
    return F.ceil(demand / F.lit(capacity)).cast("double")


def conversion_rate(surge: Column, elasticity: float = P.ELASTICITY) -> Column:
    """H9: 1 / surge ** elasticity."""
    return F.lit(1.0) / F.pow(surge, F.lit(elasticity))


def action_label(gap: Column, shortage: float = P.SHORTAGE_LIMIT,
                 surplus: float = P.SURPLUS_LIMIT) -> Column:
    """Gap > shortage -> Request Influx; gap < surplus -> Move Out; else Hold."""
    return (F.when(gap > shortage, F.lit(P.ACTION_INFLUX))
            .when(gap < surplus, F.lit(P.ACTION_MOVE_OUT))
            .otherwise(F.lit(P.ACTION_HOLD)))


def surge_band(surge: Column) -> Column:
    """<= 1.1 low, <= 1.5 mid, else high."""
    return (F.when(surge <= P.SURGE_BAND_LOW, F.lit("low"))
            .when(surge <= P.SURGE_BAND_MID, F.lit("mid")).otherwise(F.lit("high")))


def gap_sign(gap: Column) -> Column:
    """Gap > 0 shortage, else surplus."""
    return F.when(gap > 0, F.lit("shortage")).otherwise(F.lit("surplus"))


def zone_label(zone_id: Column) -> Column:
    """G17: 'Z-{id}'."""
    return F.concat(F.lit("Z-"), zone_id)


def gap_label(gap: Column) -> Column:
    """A signed gap with one decimal, ties of its decimal form to the even digit
    (gaps of an allocation are multiples of 1/1024, which decimals hold exactly)."""
    return F.format_string("%+.1f", F.bround(gap, 1))


def surge_label(surge: Column) -> Column:
    """The multiplier with up to two decimals and an x."""
    return F.concat(F.round(surge, 2).cast("string"), F.lit("x"))
