"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark plans: plain global windows, cross
joins and ``arg_min`` where the Spark side uses blocked scans, shifted
copies and literal expressions. The driver runs them on its pre-registered
views (``events`` ...). Columns that pass through ln / pow / sin / cos or
through order-dependent double sums are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from .. import params as P

# Fixed zones as a VALUES list (FIXTURES F5).
ZONES = "zones AS (SELECT * FROM (VALUES\n" + ",\n".join(
    f"  ('{z}', CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE))" for z, a, b in P.FIXED_ZONES
) + "\n) AS z(zone_id, zone_lat, zone_lon))"

# Rides over events (FIXTURES F6).
RIDES = """rides AS (SELECT event_id AS ride_id, ts AS ride_ts,
  least(greatest((CASE WHEN event_id % 10 < 5 THEN CAST(37.75 AS DOUBLE) WHEN event_id % 10 < 8 THEN CAST(37.79 AS DOUBLE) ELSE CAST(37.78 AS DOUBLE) END)
    + CAST((user_id * 7919 + event_id * 31) % 2001 - 1000 AS DOUBLE) / CAST(50000 AS DOUBLE), CAST(37.70 AS DOUBLE)), CAST(37.82 AS DOUBLE)) AS pickup_lat,
  least(greatest((CASE WHEN event_id % 10 < 5 THEN CAST(-122.47 AS DOUBLE) WHEN event_id % 10 < 8 THEN CAST(-122.38 AS DOUBLE) ELSE CAST(-122.43 AS DOUBLE) END)
    + CAST((user_id * 104729 + event_id * 17) % 2001 - 1000 AS DOUBLE) / CAST(50000 AS DOUBLE), CAST(-122.52 AS DOUBLE)), CAST(-122.35 AS DOUBLE)) AS pickup_long,
  CAST(1 + ((EXTRACT(HOUR FROM ts) * 12 + CAST(FLOOR(EXTRACT(MINUTE FROM ts) / 5) AS BIGINT)) * 37) % 9 AS INT) AS active_drivers,
  CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INT) AS is_cancelled
FROM events)"""

ASSIGNED = """nearest AS (
  SELECT r.ride_id, arg_min(z.zone_id, (r.pickup_lat - z.zone_lat) * (r.pickup_lat - z.zone_lat)
                                      + (r.pickup_long - z.zone_lon) * (r.pickup_long - z.zone_lon)) AS zone_id
  FROM rides r CROSS JOIN zones z GROUP BY r.ride_id),
assigned AS (SELECT r.*, n.zone_id FROM rides r JOIN nearest n USING (ride_id))"""

DEMAND = """demand AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ride_ts) AS time_bin, zone_id,
         count(ride_id) AS demand, avg(active_drivers) AS active_drivers,
         CAST(sum(is_cancelled) AS BIGINT) AS is_cancelled
  FROM assigned GROUP BY ALL)"""

GRID = """zrank AS (
  SELECT zone_id, CAST(row_number() OVER (ORDER BY min(time_bin), zone_id) AS INT) AS zone_rank
  FROM demand GROUP BY zone_id),
bins AS (
  SELECT unnest(generate_series((SELECT min(time_bin) FROM demand), (SELECT max(time_bin) FROM demand),
                                INTERVAL 15 MINUTE)) AS time_bin),
grid AS (
  SELECT b.time_bin, z.zone_id, z.zone_rank, coalesce(d.demand, 0) AS demand,
         d.active_drivers AS ad_raw, CAST(coalesce(d.is_cancelled, 0) AS BIGINT) AS is_cancelled
  FROM bins b CROSS JOIN zrank z LEFT JOIN demand d ON d.time_bin = b.time_bin AND d.zone_id = z.zone_id),
filled AS (
  SELECT *, coalesce(last_value(ad_raw IGNORE NULLS) OVER (ORDER BY time_bin, zone_rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS active_drivers
  FROM grid)"""

FEAT = """feat0 AS (
  SELECT time_bin, zone_id, zone_rank, demand, active_drivers, is_cancelled,
    CAST(extract(hour FROM time_bin) AS INT) AS hour,
    CAST(extract(minute FROM time_bin) AS INT) AS minute,
    CAST(isodow(time_bin) - 1 AS INT) AS day_of_week,
    CAST(CASE WHEN isodow(time_bin) - 1 >= 5 THEN 1 ELSE 0 END AS INT) AS is_weekend,
    CAST(extract(month FROM time_bin) AS INT) AS month,
    lag(demand, 1) OVER w AS lag_1, lag(demand, 4) OVER w AS lag_4, lag(demand, 96) OVER w AS lag_96,
    CASE WHEN count(demand) OVER w4 = 4 THEN avg(demand) OVER w4 END AS rolling_mean_4,
    lead(demand, 1) OVER w AS target_15m, lead(demand, 2) OVER w AS target_30m,
    lead(demand, 4) OVER w AS target_60m,
    demand - active_drivers AS gap
  FROM filled
  WINDOW w AS (PARTITION BY zone_id ORDER BY time_bin),
         w4 AS (PARTITION BY zone_id ORDER BY time_bin ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
feat AS (
  SELECT f.time_bin, f.zone_id, f.zone_rank, f.demand, f.active_drivers, f.is_cancelled,
    f.hour, f.minute, f.day_of_week, f.is_weekend, f.month,
    sin(2 * pi() * f.hour / 24) AS hour_sin, cos(2 * pi() * f.hour / 24) AS hour_cos,
    sin(2 * pi() * f.day_of_week / 7) AS day_sin, cos(2 * pi() * f.day_of_week / 7) AS day_cos,
    f.lag_1, f.lag_4, f.lag_96, f.rolling_mean_4, f.target_15m, f.target_30m, f.target_60m,
    f.gap, z.zone_lat, z.zone_lon
  FROM feat0 f JOIN zones z USING (zone_id)
  WHERE f.lag_1 IS NOT NULL AND f.lag_4 IS NOT NULL AND f.lag_96 IS NOT NULL
    AND f.rolling_mean_4 IS NOT NULL AND f.target_15m IS NOT NULL
    AND f.target_30m IS NOT NULL AND f.target_60m IS NOT NULL)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


BASE = (ZONES, RIDES, ASSIGNED, DEMAND, GRID, FEAT)


def over_features(select_sql: str) -> str:
    """Statement over the full chain with the feature table as ``feat``."""
    return with_ctes(*BASE) + select_sql


FEATURE_SELECT = """SELECT time_bin, zone_id, demand, active_drivers, is_cancelled,
  hour, minute, day_of_week, is_weekend, month,
  round(hour_sin, 6) + 0.0 AS hour_sin, round(hour_cos, 6) + 0.0 AS hour_cos,
  round(day_sin, 6) + 0.0 AS day_sin, round(day_cos, 6) + 0.0 AS day_cos,
  lag_1, lag_4, lag_96, rolling_mean_4, target_15m, target_30m, target_60m,
  gap, zone_lat, zone_lon
FROM feat"""

SQL: dict[str, str] = {}

SQL["rides_scan"] = with_ctes(RIDES) + "SELECT * FROM rides"

SQL["assign_zone"] = with_ctes(ZONES, RIDES, ASSIGNED) + \
    "SELECT ride_id, ride_ts, pickup_lat, pickup_long, zone_id FROM assigned"

SQL["zone_demand"] = with_ctes(ZONES, RIDES, ASSIGNED, DEMAND) + "SELECT * FROM demand"

SQL["demand_grid"] = with_ctes(ZONES, RIDES, ASSIGNED, DEMAND, GRID) + \
    "SELECT time_bin, zone_id, zone_rank, demand, ad_raw AS active_drivers, is_cancelled FROM grid"

SQL["supply_fill"] = with_ctes(ZONES, RIDES, ASSIGNED, DEMAND, GRID) + \
    "SELECT time_bin, zone_id, zone_rank, round(active_drivers, 6) + 0.0 AS active_drivers FROM filled"

SQL["features"] = over_features(FEATURE_SELECT)


# ---------------------------------------------------------------- M3 fleet

def alloc_ctes(src: str, group: str, fleet: str = "150", fare: str = "15.0",
               tie: str = "zone_id", cap: str = "CAST(3.0 AS DOUBLE)") -> str:
    """Allocation + revenue over CTE ``src``(group, zone_id, predicted_demand ...);
    defines a1..a6, alloc, rv."""
    return f"""a1 AS (SELECT *, sum(predicted_demand) OVER (PARTITION BY {group}) AS total,
         count(*) OVER (PARTITION BY {group}) AS n,
         row_number() OVER (PARTITION BY {group} ORDER BY predicted_demand DESC, {tie}) AS rn
  FROM {src}),
a2 AS (SELECT *, CASE WHEN total > 0 THEN predicted_demand / total END AS prob FROM a1),
a3 AS (SELECT *, CAST(round_even(prob * {fleet}, 0) AS INTEGER) AS a0 FROM a2),
a4 AS (SELECT *, {fleet} - sum(a0) OVER (PARTITION BY {group}) AS diff FROM a3),
a5 AS (SELECT *, CAST(CASE WHEN total <= 0 THEN CAST(trunc({fleet} / n) AS BIGINT)
                          ELSE a0 + CASE WHEN rn = 1 THEN diff ELSE 0 END END AS INTEGER) AS allocated_drivers
  FROM a4),
a6 AS (SELECT *, CAST(ceil(predicted_demand / {cap}) AS DOUBLE) AS optimal_supply,
         predicted_demand - allocated_drivers AS gap,
         predicted_demand / (allocated_drivers + CAST(1e-5 AS DOUBLE)) AS dsr FROM a5),
alloc AS (SELECT *, CASE WHEN dsr > 1 THEN least(CAST(3.0 AS DOUBLE), greatest(CAST(1.0 AS DOUBLE),
                  CAST(1.0 AS DOUBLE) + CAST(0.5 AS DOUBLE) * ln(dsr + CAST(1.0 AS DOUBLE))))
                  ELSE CAST(1.0 AS DOUBLE) END AS surge_multiplier,
           CASE WHEN gap > 5 THEN 'Request Influx' WHEN gap < -3 THEN 'Move Out' ELSE 'Hold' END AS action
  FROM a6),
rv1 AS (SELECT *, CAST(1.0 AS DOUBLE) / pow(surge_multiplier, CAST(0.8 AS DOUBLE)) AS conversion_rate FROM alloc),
rv2 AS (SELECT *, predicted_demand * conversion_rate AS effective_demand FROM rv1),
rv3 AS (SELECT *, least(effective_demand, allocated_drivers * {cap}) AS fulfilled_rides FROM rv2),
rv AS (SELECT *, fulfilled_rides * (CAST({fare} AS DOUBLE) * surge_multiplier) AS revenue FROM rv3)"""


BIN_ALLOC = (
    "ain AS (SELECT time_bin, zone_id, rolling_mean_4 AS predicted_demand FROM feat)",
    alloc_ctes("ain", "time_bin"),
)

SIM_BIN = """ordered AS (SELECT time_bin, row_number() OVER (ORDER BY time_bin, zone_id) - 1 AS row_idx,
                  count(*) OVER () AS n_rows FROM feat),
simbin AS (SELECT time_bin FROM ordered
           WHERE row_idx = CAST(trunc(CAST(0.8 AS DOUBLE) * n_rows) AS BIGINT))"""

ALLOC_SELECT = """SELECT time_bin, zone_id, predicted_demand, prob, allocated_drivers, optimal_supply,
  gap, dsr, round(surge_multiplier, 6) + 0.0 AS surge_multiplier, action FROM rv"""


def over_alloc(select_sql: str, *extra: str) -> str:
    return with_ctes(*BASE, *BIN_ALLOC, *extra) + select_sql


SQL["alloc"] = over_alloc(ALLOC_SELECT)
# Whole days as bins, four fleets: demand from far above to far below the fleet.
DAILY = ("""dd AS (SELECT CAST(date_trunc('day', ride_ts) AS TIMESTAMP) AS time_bin, zone_id, count(ride_id) AS demand
  FROM assigned GROUP BY ALL)""", """dgrid AS (
  SELECT b.time_bin, z.zone_id, f.fleet, CAST(coalesce(d.demand, 0) AS DOUBLE) AS predicted_demand
  FROM (SELECT unnest(generate_series((SELECT min(time_bin) FROM dd), (SELECT max(time_bin) FROM dd), INTERVAL 1 DAY)) AS time_bin) b
  CROSS JOIN (SELECT DISTINCT zone_id FROM dd) z CROSS JOIN (VALUES (60), (150), (300), (600)) f(fleet)
  LEFT JOIN dd d ON d.time_bin = b.time_bin AND d.zone_id = z.zone_id)""",
         alloc_ctes("dgrid", "fleet, time_bin", fleet="fleet"))


def over_daily(select_sql: str) -> str:
    return with_ctes(ZONES, RIDES, ASSIGNED, *DAILY) + select_sql


SQL["alloc_daily"] = over_daily("""SELECT fleet, time_bin, zone_id, predicted_demand, prob, allocated_drivers,
  optimal_supply, gap, round(dsr, 6) + 0.0 AS dsr, round(surge_multiplier, 6) + 0.0 AS surge_multiplier, action FROM rv""")
SQL["revenue_daily"] = over_daily("""SELECT fleet, time_bin, zone_id, round(conversion_rate, 6) + 0.0 AS conversion_rate,
  round(effective_demand, 6) + 0.0 AS effective_demand, round(fulfilled_rides, 6) + 0.0 AS fulfilled_rides,
  round(revenue, 6) + 0.0 AS revenue FROM rv""")
SQL["surge_bands_daily"] = over_daily("""SELECT fleet, time_bin, zone_id,
  CASE WHEN surge_multiplier <= 1.1 THEN 'low' WHEN surge_multiplier <= 1.5 THEN 'mid' ELSE 'high' END AS surge_band,
  CASE WHEN gap > 0 THEN 'shortage' ELSE 'surplus' END AS gap_sign FROM rv""")
SQL["kpis_daily"] = over_daily("""SELECT fleet, time_bin, round(sum(revenue), 2) AS total_revenue,
  round(CASE WHEN sum(predicted_demand) <> 0 THEN sum(fulfilled_rides) / sum(predicted_demand) END * 100, 1)
    AS service_level,
  round(avg(surge_multiplier), 2) AS avg_surge, sum(predicted_demand) AS total_demand,
  count(*) AS zones, count_if(gap > 5) AS shortage_zones,
  CAST(sum(allocated_drivers) AS BIGINT) AS allocated_total FROM rv GROUP BY fleet, time_bin""")
SQL["policy_states_daily"] = over_daily(""", st AS (
  SELECT time_bin, zone_id, action, revenue,
    CASE WHEN gap > 5 THEN 'Shortage' WHEN gap < -3 THEN 'Surplus' ELSE 'Balanced' END AS gap_level
  FROM rv WHERE fleet = 60)
SELECT a.gap_level, 'Night' AS time_of_day, a.action, b.gap_level AS next_gap_level, 'Night' AS next_time_of_day,
  count(*) AS transitions, round(sum(a.revenue), 6) + 0.0 AS reward_sum
FROM st a JOIN st b ON b.zone_id = a.zone_id AND b.time_bin = a.time_bin + INTERVAL 1 DAY
GROUP BY ALL""")
SQL["alloc_at_bin"] = over_alloc(ALLOC_SELECT + " WHERE time_bin = (SELECT time_bin FROM simbin)", SIM_BIN)
SQL["alloc_matrix"] = over_alloc(
    """SELECT zone_id AS Zone, predicted_demand AS Demand, allocated_drivers AS Drivers, gap AS Gap,
  round(surge_multiplier, 6) + 0.0 AS Surge, action AS Action FROM rv
  WHERE time_bin = (SELECT time_bin FROM simbin)""", SIM_BIN)
SQL["revenue"] = over_alloc(
    """SELECT time_bin, zone_id, predicted_demand, allocated_drivers,
  round(surge_multiplier, 6) + 0.0 AS surge_multiplier, round(conversion_rate, 6) + 0.0 AS conversion_rate,
  round(effective_demand, 6) + 0.0 AS effective_demand, round(fulfilled_rides, 6) + 0.0 AS fulfilled_rides,
  round(revenue, 6) + 0.0 AS revenue FROM rv""")
SQL["revenue_share"] = over_alloc(
    """SELECT time_bin, zone_id, round(revenue, 6) + 0.0 AS revenue,
  round(CASE WHEN sum(revenue) OVER (PARTITION BY time_bin) <> 0
             THEN revenue / sum(revenue) OVER (PARTITION BY time_bin) END, 6) + 0.0 AS revenue_share FROM rv""")
SQL["fleet_kpis"] = over_alloc(
    """SELECT time_bin, round(sum(revenue), 2) AS total_revenue,
  round(CASE WHEN sum(predicted_demand) <> 0 THEN sum(fulfilled_rides) / sum(predicted_demand) END * 100, 1)
    AS service_level,
  round(avg(surge_multiplier), 2) AS avg_surge, sum(predicted_demand) AS total_demand,
  count(*) AS zones, count_if(gap > 5) AS shortage_zones,
  CAST(sum(allocated_drivers) AS BIGINT) AS allocated_total
FROM rv GROUP BY time_bin""")
SQL["surge_bands"] = over_alloc(
    """SELECT time_bin, zone_id, round(surge_multiplier, 6) + 0.0 AS surge_multiplier,
  CASE WHEN surge_multiplier <= 1.1 THEN 'low' WHEN surge_multiplier <= 1.5 THEN 'mid' ELSE 'high' END AS surge_band,
  CASE WHEN gap > 0 THEN 'shortage' ELSE 'surplus' END AS gap_sign,
  printf('%+.1f', gap) AS gap_label, CAST(round(surge_multiplier, 2) AS VARCHAR) || 'x' AS surge_label,
  CAST(row_number() OVER (PARTITION BY time_bin ORDER BY surge_multiplier, zone_id) AS INT) AS surge_rank
FROM rv""")
SQL["alloc_json_fields"] = over_alloc(
    """SELECT time_bin, round(sum(revenue) OVER (PARTITION BY time_bin), 2) AS total_revenue,
  round(CASE WHEN sum(predicted_demand) OVER (PARTITION BY time_bin) <> 0 THEN sum(fulfilled_rides) OVER (PARTITION BY time_bin)
    / sum(predicted_demand) OVER (PARTITION BY time_bin) END * 100, 1) AS service_level,
  round(avg(surge_multiplier) OVER (PARTITION BY time_bin), 2) AS avg_surge,
  zone_id, predicted_demand, allocated_drivers, action, round(surge_multiplier, 6) + 0.0 AS surge_multiplier FROM rv""")
SQL["action_mix"] = over_alloc(
    """SELECT action, count(*) AS zones,
  round(count(*) / sum(count(*)) OVER (), 6) + 0.0 AS share FROM rv GROUP BY action""")
SQL["top_zones"] = over_alloc(
    """SELECT time_bin, zone_id, predicted_demand, CAST(rn AS INT) AS demand_rank,
  'Z-' || zone_id AS zone_label FROM rv WHERE rn <= 10""")

POINT_SURGE = """CASE WHEN active_drivers = 0 THEN CAST(3.0 AS DOUBLE)
  WHEN demand / active_drivers <= 1 THEN CAST(1.0 AS DOUBLE)
  ELSE round(least(greatest(CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE) + CAST(0.8 AS DOUBLE)
       * ln(demand / active_drivers + CAST(0.1 AS DOUBLE))), CAST(3.0 AS DOUBLE)), 2) END"""

SQL["surge_point"] = over_features(
    f"SELECT time_bin, zone_id, demand, active_drivers, {POINT_SURGE} AS surge FROM feat")

SQL["trip_price"] = with_ctes(*BASE) + f""", q AS (
  SELECT a.ride_id, time_bucket(INTERVAL 15 MINUTE, a.ride_ts) AS time_bin, a.zone_id,
    sqrt(((a.pickup_lat - z.zone_lat) * CAST(111.32 AS DOUBLE)) * ((a.pickup_lat - z.zone_lat) * CAST(111.32 AS DOUBLE))
       + ((a.pickup_long - z.zone_lon) * CAST(88.0 AS DOUBLE)) * ((a.pickup_long - z.zone_lon) * CAST(88.0 AS DOUBLE))) AS distance_km
  FROM assigned a JOIN zones z USING (zone_id)),
s AS (SELECT time_bin, zone_id, {POINT_SURGE} AS surge FROM filled)
SELECT q.ride_id, q.time_bin, q.zone_id, round(distance_km, 6) + 0.0 AS distance_km,
  round(distance_km * CAST(2.0 AS DOUBLE), 6) + 0.0 AS duration_min, s.surge,
  round((CAST(5.0 AS DOUBLE) + distance_km * CAST(1.5 AS DOUBLE) + (distance_km * CAST(2.0 AS DOUBLE)) * CAST(0.25 AS DOUBLE)) * s.surge, 2) AS price
FROM q LEFT JOIN s USING (time_bin, zone_id)"""


# ---------------------------------------------------------------- M4 summaries

def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"


SQL["hourly_profile"] = over_features(""", h AS (SELECT hour, avg(demand) AS avg_demand FROM feat GROUP BY hour)
SELECT hour, round(avg_demand, 6) + 0.0 AS avg_demand,
  CAST(CASE WHEN row_number() OVER (ORDER BY avg_demand DESC, hour) = 1 THEN 1 ELSE 0 END AS INT) AS is_peak
FROM h""")

DAY_LIST = "[" + ", ".join(f"'{d}'" for d in P.DAY_NAMES) + "]"

SQL["dow_profile"] = over_features(f""", m AS (SELECT day_of_week, avg(demand) AS avg_demand FROM feat GROUP BY 1),
d AS (SELECT CAST(range AS INT) AS day_of_week FROM range(7))
SELECT d.day_of_week, {DAY_LIST}[d.day_of_week + 1] AS day_name, round(m.avg_demand, 6) + 0.0 AS avg_demand
FROM d LEFT JOIN m USING (day_of_week)""")

SQL["hour_day"] = over_features("""SELECT day_of_week, hour, round(avg(demand), 6) + 0.0 AS avg_demand
FROM feat GROUP BY day_of_week, hour""")

SQL["hour_day_pivot"] = over_features(
    "SELECT day_of_week, " + ", ".join(
        f"round(coalesce(avg(CASE WHEN hour = {h} THEN demand END), CAST(0.0 AS DOUBLE)), 6) + 0.0 AS h{h:02d}"
        for h in range(24)) + " FROM feat GROUP BY day_of_week")

SQL["zone_profile"] = over_features(""", z AS (SELECT zone_id, avg(demand) AS avg_demand FROM feat GROUP BY zone_id)
SELECT zone_id, round(avg_demand, 6) + 0.0 AS avg_demand,
  CAST(row_number() OVER (ORDER BY avg_demand DESC, zone_id) AS INT) AS demand_rank,
  CAST(row_number() OVER (ORDER BY CAST(zone_id AS INT)) AS INT) AS zone_order
FROM z""")

SQL["zone_hourly"] = over_features(""", picked AS (
  SELECT zone_id FROM (SELECT DISTINCT zone_id FROM feat) ORDER BY CAST(zone_id AS INT) LIMIT 3),
hourly AS (SELECT zone_id, time_bucket(INTERVAL 1 HOUR, time_bin) AS hour_ts, sum(demand) AS demand
  FROM feat WHERE zone_id IN (SELECT zone_id FROM picked) GROUP BY ALL),
b AS (SELECT zone_id, min(hour_ts) AS lo, max(hour_ts) AS hi FROM hourly GROUP BY zone_id),
sp AS (SELECT zone_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM b)
SELECT sp.zone_id, sp.hour_ts, CAST(coalesce(h.demand, 0) AS BIGINT) AS demand
FROM sp LEFT JOIN hourly h USING (zone_id, hour_ts)""")

SQL["cumulative_demand"] = over_features(""", pb AS (SELECT time_bin, sum(demand) AS demand FROM feat GROUP BY time_bin)
SELECT time_bin, CAST(demand AS BIGINT) AS demand,
  CAST(sum(demand) OVER (ORDER BY time_bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM pb""")

SQL["dataset_kpis"] = over_features("""SELECT count(*) AS "rows", CAST(24 AS INT) AS columns,
  count(DISTINCT zone_id) AS zones,
  CAST(floor(epoch(max(time_bin) - min(time_bin)) / 86400) AS BIGINT) AS days,
  (SELECT count(*) FROM rides) AS raw_rides
FROM feat""")

_DESCRIBE = ("demand", "active_drivers", "is_cancelled", "hour", "minute", "day_of_week", "is_weekend",
             "month", "hour_sin", "hour_cos", "day_sin", "day_cos", "lag_1", "lag_4", "lag_96",
             "rolling_mean_4", "target_15m", "target_30m", "target_60m", "gap", "zone_lat", "zone_lon",
             "zone_num")


def _describe_one(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS column_name, count({x}) AS count, {r6(f'avg({x})', 'mean')}, "
            f"{r6(f'stddev_samp({x})', 'std')}, {r6(f'min({x})', 'min')}, "
            f"{r6(f'quantile_cont({x}, 0.25)', 'p25')}, {r6(f'quantile_cont({x}, 0.5)', 'p50')}, "
            f"{r6(f'quantile_cont({x}, 0.75)', 'p75')}, {r6(f'max({x})', 'max')} FROM f2")


SQL["describe"] = over_features(", f2 AS (SELECT *, CAST(zone_id AS INT) AS zone_num FROM feat)\n"
                                + "\nUNION ALL\n".join(_describe_one(c) for c in _DESCRIBE))


SQL["describe_time"] = over_features("""SELECT 'time_bin' AS column_name, count(time_bin) AS count,
  make_timestamp(CAST(sum(epoch(time_bin)::HUGEINT) * 1000000 // count(time_bin) AS BIGINT)) AS mean,
  min(time_bin) AS min,
  make_timestamp(CAST(round(quantile_cont(epoch(time_bin)::BIGINT, 0.25) * 1000000.0) AS BIGINT)) AS p25,
  make_timestamp(CAST(round(quantile_cont(epoch(time_bin)::BIGINT, 0.5) * 1000000.0) AS BIGINT)) AS p50,
  make_timestamp(CAST(round(quantile_cont(epoch(time_bin)::BIGINT, 0.75) * 1000000.0) AS BIGINT)) AS p75,
  max(time_bin) AS max
FROM feat""")


def hist_sql(table: str, col: str, bins: int = 60, axis: str | None = None) -> str:
    x = f"CAST({col} AS DOUBLE)"
    ax = f", '{axis}' AS axis" if axis else ""
    return f"""(WITH st AS (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}),
w AS (SELECT lo, hi, (hi - lo) / CAST({bins}.0 AS DOUBLE) AS width FROM st),
c AS (SELECT CAST(CASE WHEN w.width > 0 THEN least(floor(({x} - w.lo) / w.width), {bins - 1}) ELSE 0 END AS INT) AS bin,
             count(*) AS cnt FROM {table}, w WHERE {col} IS NOT NULL GROUP BY 1)
SELECT CAST(b.range AS INT) AS bin, round(w.lo + b.range * w.width, 6) + 0.0 AS bin_start,
  round(w.lo + (b.range + 1) * w.width, 6) + 0.0 AS bin_end, coalesce(c.cnt, 0) AS count{ax}
FROM range({bins}) b CROSS JOIN w LEFT JOIN c ON c.bin = b.range)"""


SQL["demand_hist"] = over_features("SELECT * FROM " + hist_sql("feat", "demand"))
SQL["lat_hist"] = with_ctes(RIDES) + "SELECT * FROM " + hist_sql("rides", "pickup_lat", axis="pickup_lat") \
    + " UNION ALL SELECT * FROM " + hist_sql("rides", "pickup_long", axis="pickup_long")


def _corr_sql() -> str:
    cols = list(P.CORR_COLUMNS)
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            v = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) + 0.0"
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {v} AS corr FROM feat")
            parts.append(f"SELECT '{b}' AS x, '{a}' AS y, {v} AS corr FROM feat")
        parts.append(f"SELECT '{a}' AS x, '{a}' AS y, CAST(1.0 AS DOUBLE) AS corr")
    return "\nUNION ALL\n".join(parts)


SQL["corr_matrix"] = over_features(_corr_sql())

SQL["head_rows"] = over_features(FEATURE_SELECT + " ORDER BY zone_id, time_bin LIMIT 200")

SQL["ride_sample"] = with_ctes(RIDES) + """SELECT ride_id, md5('42:' || CAST(ride_id AS VARCHAR)) AS sample_key,
  pickup_lat, pickup_long FROM rides ORDER BY sample_key LIMIT 1000"""


# ---------------------------------------------------------------- M5 spatial, rates

SQL["pickup_density"] = with_ctes(RIDES) + """, c AS (
  SELECT CAST(floor(pickup_lat / CAST(0.001 AS DOUBLE)) AS BIGINT) AS cell_lat,
         CAST(floor(pickup_long / CAST(0.001 AS DOUBLE)) AS BIGINT) AS cell_lon, count(*) AS pickups
  FROM rides GROUP BY 1, 2)
SELECT cell_lat, cell_lon, (cell_lat + CAST(0.5 AS DOUBLE)) * CAST(0.001 AS DOUBLE) AS lat,
  (cell_lon + CAST(0.5 AS DOUBLE)) * CAST(0.001 AS DOUBLE) AS lon, pickups FROM c"""

_CENTER_LAT = repr((P.CITY_LAT_MIN + P.CITY_LAT_MAX) / 2)
_CENTER_LON = repr((P.CITY_LON_MIN + P.CITY_LON_MAX) / 2)

SQL["zone_markers"] = over_alloc(f"""SELECT rv.zone_id, z.zone_lat, z.zone_lon, rv.predicted_demand AS value,
  CASE WHEN rv.predicted_demand > 0 THEN sqrt(rv.predicted_demand) * 2 ELSE CAST(5.0 AS DOUBLE) END AS radius,
  'Zone: ' || rv.zone_id || '<br>Demand: ' || CAST(rv.predicted_demand AS VARCHAR) AS popup,
  CAST({_CENTER_LAT} AS DOUBLE) AS center_lat, CAST({_CENTER_LON} AS DOUBLE) AS center_lon
FROM rv JOIN zones z USING (zone_id) WHERE rv.time_bin = (SELECT time_bin FROM simbin)""", SIM_BIN)

_NLAT = int((P.CITY_LAT_MAX - P.CITY_LAT_MIN) / P.GRID_SIZE_LAT)
_NLON = int((P.CITY_LON_MAX - P.CITY_LON_MIN) / P.GRID_SIZE_LON)
_D = "AS DOUBLE)"

SQL["grid_cells"] = with_ctes(RIDES) + f""", cells AS (
  SELECT CAST(trunc(range / {_NLON}) AS INT) AS cell_i, CAST(range % {_NLON} AS INT) AS cell_j FROM range({_NLAT * _NLON})),
rc AS (SELECT CAST(trunc((pickup_lat - CAST({P.CITY_LAT_MIN!r} AS DOUBLE)) / CAST({P.GRID_SIZE_LAT!r} AS DOUBLE)) AS INT) AS cell_i,
              CAST(trunc((pickup_long - CAST({P.CITY_LON_MIN!r} AS DOUBLE)) / CAST({P.GRID_SIZE_LON!r} AS DOUBLE)) AS INT) AS cell_j,
              count(*) AS rides FROM rides GROUP BY 1, 2)
SELECT CAST(cell_i AS VARCHAR) || '_' || CAST(cell_j AS VARCHAR) AS cell_id, cell_i, cell_j,
  CAST({P.CITY_LAT_MIN!r} {_D} + cell_i * CAST({P.GRID_SIZE_LAT!r} {_D} AS lat_start,
  CAST({P.CITY_LAT_MIN!r} {_D} + (cell_i + 1) * CAST({P.GRID_SIZE_LAT!r} {_D} AS lat_end,
  CAST({P.CITY_LON_MIN!r} {_D} + cell_j * CAST({P.GRID_SIZE_LON!r} {_D} AS lon_start,
  CAST({P.CITY_LON_MIN!r} {_D} + (cell_j + 1) * CAST({P.GRID_SIZE_LON!r} {_D} AS lon_end,
  coalesce(rc.rides, 0) AS rides
FROM cells LEFT JOIN rc USING (cell_i, cell_j)"""

_HW = "[" + ", ".join(f"CAST({w!r} AS DOUBLE)" for w in P.HOUR_WEIGHTS) + "]"
_DW = "[" + ", ".join(f"CAST({w!r} AS DOUBLE)" for w in P.DAY_WEIGHTS) + "]"

SQL["expected_rate"] = with_ctes(RIDES) + f""", w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ride_ts) AS win FROM rides),
obs AS (SELECT win, count(*) AS rides FROM w GROUP BY win),
sp AS (SELECT unnest(generate_series((SELECT min(win) FROM w), (SELECT max(win) FROM w), INTERVAL 5 MINUTE)) AS win),
pw AS (SELECT CAST(isodow(sp.win) - 1 AS INT) AS day_of_week, CAST(extract(hour FROM sp.win) AS INT) AS hour,
  CAST(5.0 AS DOUBLE) * {_HW}[extract(hour FROM sp.win) + 1] * {_DW}[isodow(sp.win)] AS expected,
  coalesce(o.rides, 0) AS rides
  FROM sp LEFT JOIN obs o USING (win))
SELECT day_of_week, hour, count(*) AS windows, round(sum(expected), 6) + 0.0 AS expected_rides,
  CAST(sum(rides) AS BIGINT) AS observed_rides, round(sum(rides) / sum(expected), 6) + 0.0 AS ratio
FROM pw GROUP BY day_of_week, hour"""

SQL["cancel_by_regime"] = with_ctes(RIDES) + """, pw AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ride_ts) AS win, count(*) AS rides, max(active_drivers) AS drivers,
         sum(is_cancelled) AS cancelled FROM rides GROUP BY 1),
r AS (SELECT CASE WHEN drivers < rides THEN 'shortage' ELSE 'normal' END AS regime, count(*) AS windows,
             CAST(sum(rides) AS BIGINT) AS rides, CAST(sum(cancelled) AS BIGINT) AS cancelled FROM pw GROUP BY 1)
SELECT regime, windows, rides, cancelled, round(cancelled / rides, 6) + 0.0 AS cancel_rate,
  CASE WHEN regime = 'shortage' THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END AS model_cancel_p
FROM r"""


# ---------------------------------------------------------------- M6 scenarios

BASELINE = """bl AS (SELECT zone_id, hour, day_of_week, round_even(avg(demand) * 1024, 0) / 1024 AS pred_15m
  FROM feat GROUP BY zone_id, hour, day_of_week)"""

SCEN = (BASELINE, """sc AS (SELECT dh.*, fleet, CAST(fare AS DOUBLE) AS fare, CAST(capacity AS DOUBLE) AS capacity
  FROM (SELECT DISTINCT day_of_week, hour FROM feat) dh CROSS JOIN (VALUES (20), (150), (1000)) a(fleet)
  CROSS JOIN (VALUES (5), (15), (100)) b(fare) CROSS JOIN (VALUES (1), (3), (10)) c(capacity)),
sin AS (SELECT sc.fleet, sc.fare, sc.capacity, sc.day_of_week, sc.hour, bl.zone_id, CAST(bl.zone_id AS INT) AS zone_num,
  bl.pred_15m AS predicted_demand, bl.pred_15m * CAST(1.1 AS DOUBLE) AS pred_30m,
  bl.pred_15m * CAST(1.3 AS DOUBLE) AS pred_60m
  FROM sc JOIN bl USING (day_of_week, hour))""",
        alloc_ctes("sin", "fleet, fare, capacity, day_of_week, hour", fleet="fleet", fare="fare", tie="zone_num", cap="capacity"))

SQL["baseline_forecast"] = with_ctes(*BASE, BASELINE) + """SELECT zone_id, hour, day_of_week, pred_15m,
  round(pred_15m * CAST(1.1 AS DOUBLE), 6) + 0.0 AS pred_30m, round(pred_15m * CAST(1.3 AS DOUBLE), 6) + 0.0 AS pred_60m
FROM bl"""

SQL["scenario_alloc"] = with_ctes(*BASE, *SCEN) + """SELECT fleet, fare, capacity, day_of_week, hour, zone_id, predicted_demand,
  round(pred_30m, 6) + 0.0 AS pred_30m, round(pred_60m, 6) + 0.0 AS pred_60m, prob, allocated_drivers, gap, round(dsr, 6) + 0.0 AS dsr,
  round(surge_multiplier, 6) + 0.0 AS surge_multiplier, action, round(revenue, 6) + 0.0 AS revenue FROM rv"""

SQL["scenario_kpis"] = with_ctes(*BASE, *SCEN) + """SELECT fleet, fare, capacity, day_of_week, hour,
  round(sum(revenue), 2) AS total_revenue,
  round(CASE WHEN sum(predicted_demand) <> 0 THEN sum(fulfilled_rides) / sum(predicted_demand) END * 100, 1)
    AS service_level,
  round(avg(surge_multiplier), 2) AS avg_surge, sum(predicted_demand) AS total_demand,
  count(*) AS zones, count_if(gap > 5) AS shortage_zones,
  CAST(sum(allocated_drivers) AS BIGINT) AS allocated_total
FROM rv GROUP BY fleet, fare, capacity, day_of_week, hour"""

SQL["lag_profile"] = with_ctes(*BASE) + """SELECT zone_id, hour, day_of_week, round(avg(lag_1), 6) + 0.0 AS lag_1,
  round(avg(lag_4), 6) + 0.0 AS lag_4, round(avg(lag_96), 6) + 0.0 AS lag_96,
  round(avg(rolling_mean_4), 6) + 0.0 AS rolling_mean_4, CAST(extract(month FROM max(time_bin)) AS INT) AS month
FROM feat GROUP BY ALL"""

# Requests: events by the last three bits of their id, as the JSON lines state them.
REQUESTS = (BASELINE, """wk AS (SELECT z.zone_id, CAST(h.h AS INT) AS hour, CAST(d.d AS INT) AS day_of_week, coalesce(bl.pred_15m, z.m) AS predicted_demand
  FROM (SELECT zone_id, avg(pred_15m) AS m FROM bl GROUP BY zone_id) z CROSS JOIN (SELECT unnest(range(24)) AS h) h
  CROSS JOIN (SELECT unnest(range(7)) AS d) d LEFT JOIN bl ON bl.zone_id = z.zone_id AND bl.hour = h.h AND bl.day_of_week = d.d)""",
            """rq0 AS (SELECT event_id, event_id % 8 AS kind, CAST((event_id % 5 + 1) * 60 AS INT) AS f,
  date_trunc('second', ts) AS t, (SELECT max(ts) FROM events) AS last FROM events)""",
            """rq AS (SELECT CASE WHEN kind = 3 THEN 'raw:' || sha256('{"request_id": "' || event_id || '", "timestamp": "'
    || strftime(t, '%Y-%m-%dT%H:%M:%S') || '"') ELSE CAST(event_id AS VARCHAR) END AS request_id,
  CASE WHEN kind IN (0, 1) THEN last WHEN kind IN (2, 6, 7) THEN t END AS request_ts,
  CASE WHEN kind IN (0, 2) THEN 100 WHEN kind IN (1, 6, 7) THEN f END AS fleet,
  CASE kind WHEN 3 THEN 'bad JSON' WHEN 4 THEN 'bad timestamp' WHEN 5 THEN 'bad driver count' END AS error FROM rq0)""",
            """cs AS (SELECT DISTINCT isodow(request_ts) - 1 AS dw, extract(hour FROM request_ts) AS hr, fleet FROM rq WHERE error IS NULL)""",
            """cz AS (SELECT cs.dw, cs.hr, cs.fleet, wk.zone_id, CAST(wk.zone_id AS INT) AS zone_num, wk.predicted_demand
  FROM cs JOIN wk ON wk.day_of_week = cs.dw AND wk.hour = cs.hr)""",
            alloc_ctes("cz", "dw, hr, fleet", fleet="fleet", tie="zone_num"))

SQL["allocate_requests"] = with_ctes(*BASE, *REQUESTS) + """SELECT rq.request_id, rq.request_ts, CAST(rq.fleet AS INT) AS fleet, rv.zone_id,
  round(predicted_demand, 6) + 0.0 AS predicted_demand, allocated_drivers, action,
  round(surge_multiplier, 6) + 0.0 AS surge_multiplier, round(revenue, 6) + 0.0 AS revenue, error
FROM rq LEFT JOIN rv ON rv.dw = isodow(rq.request_ts) - 1 AND rv.hr = extract(hour FROM rq.request_ts) AND rv.fleet = rq.fleet"""

# ---------------------------------------------------------------- M7 split

SQL["time_split"] = over_features(""", o AS (SELECT time_bin, zone_id,
    row_number() OVER (ORDER BY time_bin, zone_id) - 1 AS row_idx, count(*) OVER () AS n_rows FROM feat)
SELECT time_bin, zone_id, row_idx,
  CASE WHEN row_idx < CAST(trunc(CAST(0.8 AS DOUBLE) * n_rows) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM o""")

# The baseline fitted on the training slice, applied to the test slice.
TEST_BASELINE = ("""o AS (SELECT *, row_number() OVER (ORDER BY time_bin, zone_id) - 1 AS row_idx, count(*) OVER () AS n_rows FROM feat)""",
                 """sp AS (SELECT *, CASE WHEN row_idx < CAST(trunc(CAST(0.8 AS DOUBLE) * n_rows) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM o)""",
                 """bt AS (SELECT zone_id, hour, day_of_week, round_even(avg(demand) * 1024, 0) / 1024 AS p
  FROM sp WHERE split = 'train' GROUP BY ALL)""",
                 """te AS (SELECT sp.*, coalesce(bt.p, 0) AS predicted_demand FROM sp LEFT JOIN bt USING (zone_id, hour, day_of_week)
  WHERE split = 'test')""")

SQL["baseline_test_alloc"] = with_ctes(
    *BASE, *TEST_BASELINE, "ain AS (SELECT time_bin, zone_id, predicted_demand FROM te)", alloc_ctes("ain", "time_bin")) + """SELECT time_bin, zone_id,
  predicted_demand, round(prob, 6) + 0.0 AS prob, allocated_drivers, optimal_supply, gap, round(dsr, 6) + 0.0 AS dsr,
  round(surge_multiplier, 6) + 0.0 AS surge_multiplier, action, round(revenue, 6) + 0.0 AS revenue FROM rv"""


def _test_metric(horizon: str, target: str, factor: str) -> str:
    e = f"(predicted_demand * CAST({factor} AS DOUBLE) - {target})"
    return f"""SELECT '{horizon}' AS horizon, round(sqrt(avg({e} * {e})), 6) + 0.0 AS rmse, round(avg(abs({e})), 6) + 0.0 AS mae,
  round(CAST(1.0 AS DOUBLE) - sum({e} * {e}) / (sum({target} * {target}) - CAST(sum({target}) AS DOUBLE) * sum({target}) / count(*)), 6) + 0.0 AS r2,
  count(*) AS n_test FROM te"""


SQL["baseline_test_metrics"] = with_ctes(*BASE, *TEST_BASELINE) + "\nUNION ALL\n".join(
    _test_metric(*x) for x in (("15m", "target_15m", "1.0"), ("30m", "target_30m", "1.1"), ("60m", "target_60m", "1.3")))

# ---------------------------------------------------------------- M8 policy, streaming

SQL["policy_states"] = over_alloc(""", st AS (
  SELECT time_bin, zone_id, action, revenue,
    CASE WHEN gap > 5 THEN 'Shortage' WHEN gap < -3 THEN 'Surplus' ELSE 'Balanced' END AS gap_level,
    CASE WHEN extract(hour FROM time_bin) >= 6 AND extract(hour FROM time_bin) < 11 THEN 'Morning'
         WHEN extract(hour FROM time_bin) >= 11 AND extract(hour FROM time_bin) < 17 THEN 'Day'
         WHEN extract(hour FROM time_bin) >= 17 AND extract(hour FROM time_bin) < 22 THEN 'Evening'
         ELSE 'Night' END AS time_of_day
  FROM rv)
SELECT a.gap_level, a.time_of_day, a.action, b.gap_level AS next_gap_level, b.time_of_day AS next_time_of_day,
  count(*) AS transitions, round(sum(a.revenue), 6) + 0.0 AS reward_sum
FROM st a JOIN st b ON b.zone_id = a.zone_id AND b.time_bin = a.time_bin + INTERVAL 15 MINUTE
GROUP BY ALL""")

HISTORY_STATES = """, st AS (
  SELECT rv.time_bin, rv.zone_id, rv.action, rv.revenue,
    CASE WHEN f.gap > 5 THEN 'Shortage' WHEN f.gap < -3 THEN 'Surplus' ELSE 'Balanced' END AS gap_level,
    CASE WHEN extract(hour FROM rv.time_bin) >= 6 AND extract(hour FROM rv.time_bin) < 11 THEN 'Morning'
         WHEN extract(hour FROM rv.time_bin) >= 11 AND extract(hour FROM rv.time_bin) < 17 THEN 'Day'
         WHEN extract(hour FROM rv.time_bin) >= 17 AND extract(hour FROM rv.time_bin) < 22 THEN 'Evening'
         ELSE 'Night' END AS time_of_day
  FROM rv JOIN feat f USING (time_bin, zone_id)),
tr AS (
  SELECT a.gap_level, a.time_of_day, a.action, b.gap_level AS next_gap_level, b.time_of_day AS next_time_of_day,
    count(*) AS transitions, sum(a.revenue) AS reward_sum
  FROM st a JOIN st b ON b.zone_id = a.zone_id AND b.time_bin = a.time_bin + INTERVAL 15 MINUTE
  GROUP BY ALL)"""

SQL["policy_states_history"] = over_alloc(
    HISTORY_STATES + """
SELECT gap_level, time_of_day, action, next_gap_level, next_time_of_day, transitions,
  round(reward_sum, 6) + 0.0 AS reward_sum FROM tr""")


def _policy_q_sql(steps: int = 400, gamma: float = 0.9) -> str:
    """The fixed-point equation q = r + gamma E[max q(next)], iterated from 0 until
    0.9^400 of the distance is left, which is below the rounding of the values."""
    return over_alloc(HISTORY_STATES + f""", sa AS (
  SELECT gap_level, time_of_day, action, sum(transitions) AS n, sum(reward_sum) / sum(transitions) AS r FROM tr GROUP BY ALL),
it AS (
  SELECT 0 AS step, gap_level, time_of_day, max(0.0::DOUBLE) AS v FROM sa GROUP BY ALL
  UNION ALL
  SELECT step + 1, gap_level, time_of_day, max(q) AS v FROM (
    SELECT i.step, s.gap_level, s.time_of_day, s.action,
      s.r + {gamma!r}::DOUBLE * sum(t.transitions * i.v) / s.n AS q
    FROM it i JOIN tr t ON t.next_gap_level = i.gap_level AND t.next_time_of_day = i.time_of_day
    JOIN sa s ON s.gap_level = t.gap_level AND s.time_of_day = t.time_of_day AND s.action = t.action
    WHERE i.step < {steps} GROUP BY i.step, s.gap_level, s.time_of_day, s.action, s.r, s.n)
  GROUP BY step, gap_level, time_of_day),
q AS (
  SELECT s.gap_level, s.time_of_day, s.action,
    s.r + {gamma!r}::DOUBLE * coalesce(sum(t.transitions * i.v), 0) / s.n AS q
  FROM sa s JOIN tr t USING (gap_level, time_of_day, action)
  LEFT JOIN it i ON i.step = {steps} AND i.gap_level = t.next_gap_level AND i.time_of_day = t.next_time_of_day
  GROUP BY s.gap_level, s.time_of_day, s.action, s.r, s.n)
SELECT gap_level, time_of_day, action, round(q, 4) + 0.0 AS q, best AS greedy_action, (action = best)::INTEGER AS is_greedy
FROM (SELECT *, first_value(action) OVER (PARTITION BY gap_level, time_of_day ORDER BY q DESC,
        CASE action WHEN 'Hold' THEN 1 WHEN 'Request Influx' THEN 2 ELSE 3 END) AS best FROM q)""")


SQL["policy_q"] = _policy_q_sql().replace("WITH ", "WITH RECURSIVE ", 1)

SQL["stream_zone_demand"] = SQL["zone_demand"]

SQL["pipeline_kpis"] = SQL["fleet_kpis"]
