"""Temporal, spatial and statistical summaries of the feature and ride tables.

D3-D16 E6 F5-F7 A10 A11 B4 G16.

Every summary is one partial aggregate (map-side combine) over the input,
followed by work on the aggregated rows only (24 hours, 7 days, k zones,
60 histogram bins, one row per bin). The histogram bounds are the one
scalar pair read back to the driver (as ``RDD.histogram`` does); no rows
are collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..session import materialize
from ..functions.timefn import time_floor
from .scans import running_sum, time_spine


def hourly_profile(features: DataFrame) -> DataFrame:
    """D3 + D4: mean demand per hour (zero rows count) and the peak hour
    (largest mean, first hour on ties)."""
    h = features.groupBy("hour").agg(F.avg("demand").alias("avg_demand"))
    w = Window.orderBy(F.col("avg_demand").desc(), "hour")   # 24 rows
    return h.withColumn("is_peak", (F.row_number().over(w) == 1).cast("int"))


def day_name(dow: Column) -> Column:
    """Monday = 0 -> 'Mon'."""
    return F.element_at(F.array(*[F.lit(n) for n in P.DAY_NAMES]), dow + 1)


def dow_profile(features: DataFrame) -> DataFrame:
    """Mean demand per weekday with its name; all seven days listed
    (a day without data has a null mean)."""
    spark = features.sparkSession
    days = spark.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    m = features.groupBy("day_of_week").agg(F.avg("demand").alias("avg_demand"))
    return (days.join(m, "day_of_week", "left")
            .select("day_of_week", day_name(F.col("day_of_week")).alias("day_name"), "avg_demand"))


def hour_day(features: DataFrame) -> DataFrame:
    """Mean demand per (weekday, hour)."""
    return features.groupBy("day_of_week", "hour").agg(F.avg("demand").alias("avg_demand"))


def hour_day_pivot(features: DataFrame, value_round: int | None = 6) -> DataFrame:
    """Weekdays as rows, hours 0..23 as columns ``h00``..``h23``, missing 0.

    The pivot values are given, so Spark needs no extra job to find them.
    """
    p = features.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.avg("demand"))
    cols = [F.coalesce(F.col(str(h)), F.lit(0.0)) for h in range(24)]
    if value_round is not None:
        cols = [F.round(c, value_round) + F.lit(0.0) for c in cols]
    return p.select("day_of_week", *[c.alias(f"h{h:02d}") for h, c in enumerate(cols)])


def zone_profile(features: DataFrame) -> DataFrame:
    """D8 + F7: mean demand per zone, rank by mean (descending) and the
    numeric zone order."""
    z = features.groupBy("zone_id").agg(F.avg("demand").alias("avg_demand"))
    return z.select(
        "zone_id", "avg_demand",
        F.row_number().over(Window.orderBy(F.col("avg_demand").desc(), "zone_id")).alias("demand_rank"),
        F.row_number().over(Window.orderBy(F.col("zone_id").cast("int"))).alias("zone_order"),
    )


def zone_hourly(features: DataFrame, zones: Sequence[str] | None = None, first_n: int = 3) -> DataFrame:
    """B4 + D9 + D10: per selected zone, hourly demand from the zone's first
    to last hour; empty hours 0. Default selection: the first ``first_n``
    zones in numeric order."""
    f = features.select("time_bin", "zone_id", "demand")
    if zones is not None:
        f = f.where(F.col("zone_id").isin(list(zones)))
    else:
        order = f.select("zone_id").distinct().withColumn(
            "__o", F.row_number().over(Window.orderBy(F.col("zone_id").cast("int"))))
        picked = order.where(F.col("__o") <= first_n).select("zone_id")
        f = f.join(F.broadcast(picked), "zone_id", "left_semi")   # <= first_n rows
    per_bin = f.groupBy("time_bin", "zone_id").agg(F.sum("demand").alias("demand"))
    hourly = per_bin.groupBy(time_floor(F.col("time_bin"), 3600).alias("hour_ts"), "zone_id") \
        .agg(F.sum("demand").alias("demand"))
    bounds = hourly.groupBy("zone_id").agg(F.min("hour_ts").alias("lo"), F.max("hour_ts").alias("hi"))
    spine = time_spine(bounds, "lo", "hi", 3600, keys=("zone_id",), out_col="hour_ts")
    return (spine.join(hourly, ["zone_id", "hour_ts"], "left")
            .select("zone_id", "hour_ts", F.coalesce(F.col("demand"), F.lit(0)).cast("long").alias("demand")))


def cumulative_demand(features: DataFrame) -> DataFrame:
    """D11 + E6: city demand per bin and its running total (blocked scan:
    no single-partition window over the bins)."""
    per_bin = features.groupBy("time_bin").agg(F.sum("demand").alias("demand"))
    return running_sum(per_bin, "time_bin", "demand", "cumulative")


def dataset_kpis(features: DataFrame, rides: DataFrame) -> DataFrame:
    """Rows, columns, zones, whole days spanned, raw rides. One row."""
    n_cols = len(features.columns)
    k = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("zone_id").alias("zones"),
        F.min("time_bin").alias("__lo"), F.max("time_bin").alias("__hi"))
    raw = rides.agg(F.count(F.lit(1))).scalar()
    return k.select(
        "rows", F.lit(n_cols).alias("columns"), "zones",
        F.floor((F.col("__hi") - F.col("__lo")).cast("long") / 86400).alias("days"),
        raw.alias("raw_rides"))


def ranked_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, v, c, last, n, block): every distinct value of each column, how
    often it occurs, how many rows are not above it, and the column's rows.

    Equal values are counted first (combined map-side). The counted values are then
    dealt into ranges of about equally many of them (``repartitionByRange``, so an
    outlier or a crowded stretch makes no range heavier), and the running counts are
    taken inside each range and over one row a range. No task holds a column.
    """
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]
    counts = (df.select(F.inline(F.array(*pairs))).where("v is not null")
              .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c")))
    rows = materialize(counts.repartitionByRange("column_name", "v").withColumn("block", F.spark_partition_id()), "value-ranges")
    earlier = Window.partitionBy("column_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("column_name", "block").agg(F.sum("c").alias("b"))
              .select("column_name", "block", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("before"),
                      F.sum("b").over(Window.partitionBy("column_name")).alias("n")))
    inside = Window.partitionBy("column_name", "block").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("upto", F.sum("c").over(inside)).join(before, ["column_name", "block"])
            .select("column_name", "v", "c", (F.col("before") + F.col("upto")).alias("last"), "n", "block"))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles (linear interpolation) at any size: (column_name, q), the
    values at the wanted ranks of ``ranked_values``."""
    rows = ranked_values(df, columns)
    last = F.col("last")
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        for side, rank in (("l", F.floor(pos)), ("h", F.ceil(pos))):
            aggs.append(F.max(F.when((last - F.col("c") <= rank) & (rank < last), F.col("v"))).alias(f"{side}{i}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"f{i}"))
    q = [F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * F.col(f"f{i}") for i in range(len(probs))]
    return rows.groupBy("column_name").agg(*aggs).select("column_name", F.array(*q).alias("q"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std (n-1), min, 25/50/75 % (linear interpolation),
    max per column, one output row per column.

    One wide aggregate over all columns (one pass, partial aggregation), then an
    unpivot of its one row; the quartiles are exact, see ``quantiles``.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(f"__{c}"))
    wide = df.agg(*aggs)
    long = wide.select(F.inline(F.array(*[F.col(f"__{c}") for c in columns])))
    return long.join(quantiles(df, columns), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def describe_time(df: DataFrame, column: str = "time_bin") -> DataFrame:
    """D13, timestamp column: count, mean, min, 25/50/75 % (linear
    interpolation), max, all as TIMESTAMP_NTZ (no std), one row.

    Works in whole epoch seconds (interval-aligned bins are whole seconds):
    the mean is an exact decimal sum divided with DIV, the quartiles are
    exact dyadic interpolations, both then taken to microseconds.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    t = F.col(column)
    sec = F.timestamp_diff("SECOND", epoch, t)
    agg = df.agg(
        F.count(t).alias("count"),
        F.sum(sec.cast("decimal(38,0)")).alias("__sum"),
        F.min(t).alias("min"), F.max(t).alias("max"), F.lit("__sec").alias("column_name"))
    quarters = quantiles(df.select(sec.alias("__sec")), ["__sec"]).withColumnRenamed("q", "__q")
    agg = agg.join(quarters, "column_name", "left")

    def at_us(us: Column) -> Column:
        return F.timestamp_add("MICROSECOND", us, epoch)

    mean_us = F.expr("CAST(__sum * 1000000 DIV count AS BIGINT)")
    q_us = [F.round(F.col("__q")[i] * F.lit(1000000.0)).cast("long") for i in range(3)]
    return agg.select(F.lit(column).alias("column_name"), "count", at_us(mean_us).alias("mean"), "min",
                      at_us(q_us[0]).alias("p25"), at_us(q_us[1]).alias("p50"),
                      at_us(q_us[2]).alias("p75"), "max")


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 60) -> DataFrame:
    """D14 for several columns in two passes over ``df`` whatever their
    number: ``bins`` equal-width bins from min to max of each column (the
    last one closed), all bins listed with their bounds and counts, one
    ``axis`` value per column.

    Pass 1 is one aggregate of every (min, max) (two numbers per column to
    the driver, as Spark's own ``RDD.histogram``); pass 2 emits one
    (axis, bin) pair per non-null value and counts them (map-side
    combined). The bin list is a ``range`` of bins x columns, no cross join.
    """
    cols = list(columns)
    xs = [F.col(c).cast("double") for c in cols]
    row = df.agg(*[f(x) for x in xs for f in (F.min, F.max)]).first()
    bounds = [(row[2 * i], row[2 * i + 1]) for i in range(len(cols))]

    def lit(v):
        return F.lit(v).cast("double")

    pairs = []
    for i, (x, (lo, hi)) in enumerate(zip(xs, bounds)):
        width = (lit(hi) - lit(lo)) / F.lit(float(bins))
        idx = F.when(width > 0, F.least(F.floor((x - lit(lo)) / width), F.lit(bins - 1))).otherwise(F.lit(0))
        pairs.append(F.when(x.isNotNull(), F.struct(F.lit(i).alias("a"), idx.cast("int").alias("bin"))))
    counts = (df.select(F.explode(F.array(*pairs)).alias("p")).where(F.col("p").isNotNull())
              .groupBy(F.col("p.a").alias("a"), F.col("p.bin").alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    every = spark.range(bins * len(cols)).select((F.col("id") / bins).cast("int").alias("a"),
                                                 (F.col("id") % bins).cast("int").alias("bin"))

    def per_axis(vals):
        out = F.lit(None)
        for i, v in reversed(list(enumerate(vals))):
            out = F.when(F.col("a") == i, v).otherwise(out)
        return out

    lo_c = per_axis([lit(lo) for lo, _ in bounds])
    width_c = per_axis([(lit(hi) - lit(lo)) / F.lit(float(bins)) for lo, hi in bounds])
    b = F.col("bin")
    return (every.join(counts, ["a", "bin"], "left")
            .select(per_axis([F.lit(c) for c in cols]).alias("axis"), "bin",
                    (lo_c + b * width_c).alias("bin_start"), (lo_c + (b + 1) * width_c).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """D14 for one column (see ``histograms``)."""
    return histograms(df, [column], bins).drop("axis")


def corr_matrix(df: DataFrame, columns: Sequence[str] = P.CORR_COLUMNS) -> DataFrame:
    """Pairwise Pearson correlation, long form (x, y, corr).

    The sums of the n(n+1)/2 products are computed once, of values centred by
    their means (one small aggregate before), and all coefficients derived from
    them; then the mirror and the unit diagonal. As in SQL, a pair counts the
    rows that have both values, and the coefficient is null without variance.
    """
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    x = df.select(*[(F.col(c).cast("double") - F.lit(means[c] if means[c] is not None else 0.0)).alias(c) for c in cols])
    full = not any(f.nullable for f in df.select(*cols).schema) or x.where(
        " or ".join(f"`{c}` is null" for c in cols)).isEmpty()
    if full:
        squares = [F.sum(F.col(c) * F.col(c)).alias(f"{c}|{c}") for c in cols]
        wide = x.agg(*squares, *[F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in pairs])
        coef = {(a, b): F.try_divide(F.col(f"`{a}|{b}`"), F.sqrt(F.col(f"`{a}|{a}`") * F.col(f"`{b}|{b}`")))
                for a, b in pairs}
    else:
        wide = x.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
        coef = {(a, b): F.col(f"`{a}|{b}`") for a, b in pairs}
    entries = []
    for (a, b), v in coef.items():
        entries.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), v.alias("corr")))
        entries.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), v.alias("corr")))
    for a in cols:
        entries.append(F.struct(F.lit(a).alias("x"), F.lit(a).alias("y"), F.lit(1.0).alias("corr")))
    return wide.select(F.inline(F.array(*entries)))


def head_rows(df: DataFrame, order_cols: Sequence[str], n: int = 200) -> DataFrame:
    """first n rows in key order (top-k per partition, then a merge)."""
    return df.orderBy(*order_cols).limit(n)


def sample_rides(rides: DataFrame, n: int = 1000, seed: int = P.SEED) -> DataFrame:
    """exactly min(n, rows) rides without replacement, seeded.

    Rides are ordered by the MD5 digest of the seed and ride_id and the first
    n kept: a top-k (n rows per task, then a merge), no global sort. Same
    seed, same sample, on any engine; rides that share an id are ordered by
    their time and place.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("ride_id").cast("string")).cast("binary"))
    return rides.withColumn("sample_key", key).orderBy("sample_key", "ride_ts", "pickup_lat", "pickup_long").limit(n)


def pickup_density(rides: DataFrame, cell: float = 0.001) -> DataFrame:
    """A10: heat-map points as a density table: pickups per small cell."""
    i = F.floor(F.col("pickup_lat") / F.lit(cell))
    j = F.floor(F.col("pickup_long") / F.lit(cell))
    c = rides.groupBy(i.alias("cell_lat"), j.alias("cell_lon")).agg(F.count(F.lit(1)).alias("pickups"))
    return c.select("cell_lat", "cell_lon",
                    ((F.col("cell_lat") + 0.5) * F.lit(cell)).alias("lat"),
                    ((F.col("cell_lon") + 0.5) * F.lit(cell)).alias("lon"), "pickups")


def zone_markers(df: DataFrame, value_col: str) -> DataFrame:
    """Marker per zone: location, radius 2 * sqrt(v) (5 when v <= 0),
    popup text; plus the map centre (middle of the city bounds)."""
    v = F.col(value_col)
    return df.select(
        "zone_id", "zone_lat", "zone_lon", v.alias("value"),
        F.when(v > 0, F.sqrt(v) * 2).otherwise(F.lit(5.0)).alias("radius"),
        F.concat(F.lit("Zone: "), F.col("zone_id"), F.lit("<br>Demand: "), v.cast("string")).alias("popup"),
        F.lit((P.CITY_LAT_MIN + P.CITY_LAT_MAX) / 2).alias("center_lat"),
        F.lit((P.CITY_LON_MIN + P.CITY_LON_MAX) / 2).alias("center_lon"),
    )
