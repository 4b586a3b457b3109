"""Parameters and fixed values.

Everything an operator needs is passed in as a parameter; the defaults live
here.  The block marked FIXED VALUES holds numbers that must equal the
reference application's for equal results; they are stated plainly, in
their natural order.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (must match the reference's constants)
# --------------------------------------------------------------------------

# City bounding box in degrees.
CITY_LAT_MIN = 37.70
CITY_LAT_MAX = 37.82
CITY_LON_MIN = -122.52
CITY_LON_MAX = -122.35

# Grid zone cell size in degrees.
GRID_SIZE_LAT = 0.01
GRID_SIZE_LON = 0.01

# Number of K-Means demand zones.
NUM_CLUSTERS = 20

# Ride generator: mean rides per 5-minute window and its weights.
BASE_RATE_PER_5MIN = 5.0
# Hour of day 0..23.
HOUR_WEIGHTS = (
    0.2, 0.1, 0.1, 0.1, 0.2, 0.5, 0.8, 1.2, 1.5, 1.2,
    1.0, 0.9, 1.0, 1.0, 1.1, 1.3, 1.6, 2.0, 1.8, 1.5,
    1.2, 1.0, 0.8, 0.5,
)
# Day of week, Monday = 0 .. Sunday = 6.
DAY_WEIGHTS = (1.0, 1.0, 1.0, 1.1, 1.3, 1.5, 1.4)
# Cancellation probability, normal and when drivers < rides in the window.
CANCEL_P_NORMAL = 0.05
CANCEL_P_SHORTAGE = 0.2

# Day names, Monday first.
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

# Fleet allocation and revenue rules.
DEFAULT_FLEET = 100           # API default fleet
DEFAULT_REQUEST_DRIVERS = 10  # API default active drivers of a prediction request
PIPELINE_FLEET = 150          # batch pipeline fleet
DEFAULT_FARE = 15.0
CAPACITY_PER_DRIVER = 3.0     # rides per driver per period
SHORTAGE_LIMIT = 5            # gap > 5  -> 'Request Influx'
SURPLUS_LIMIT = -3            # gap < -3 -> 'Move Out'
DSR_EPSILON = 1e-5            # dsr = demand / (drivers + 1e-5)
ELASTICITY = 0.8              # conversion = surge ** -0.8
ACTION_HOLD = "Hold"
ACTION_INFLUX = "Request Influx"
ACTION_MOVE_OUT = "Move Out"

# Allocation surge: dsr <= 1 -> 1, else clip(1 + 0.5 * ln(dsr + 1), 1, 3).
ALLOC_SURGE_SLOPE = 0.5
ALLOC_SURGE_SHIFT = 1.0
# Point surge: supply 0 -> 3, dsr <= 1 -> 1,
# else round(clip(1 + 0.8 * ln(dsr + 0.1), 1, 3), 2).
POINT_SURGE_SLOPE = 0.8
POINT_SURGE_SHIFT = 0.1
SURGE_FLOOR = 1.0
SURGE_CAP = 3.0

# Trip price: (base + per_km * km + per_min * min) * surge, rounded to 2.
PRICE_BASE_FARE = 5.0
PRICE_PER_KM = 1.5
PRICE_PER_MIN = 0.25

# Surge display bands: <= 1.1 low, <= 1.5 mid, else high.
SURGE_BAND_LOW = 1.1
SURGE_BAND_MID = 1.5

# Fallback forecast multipliers for the 30 and 60 minute horizons.
FALLBACK_MULT_30M = 1.1
FALLBACK_MULT_60M = 1.3

# Forecast features, in the reference's order; supply columns are added
# when present.
BASE_FEATURES = (
    "hour", "minute", "day_of_week", "is_weekend", "month",
    "hour_sin", "hour_cos", "day_sin", "day_cos",
    "lag_1", "lag_4", "lag_96", "rolling_mean_4",
    "zone_lat", "zone_lon",
)
SUPPLY_FEATURES = ("active_drivers", "gap")
HORIZONS = (("15m", "target_15m"), ("30m", "target_30m"), ("60m", "target_60m"))

# Correlation matrix columns of the model page.
CORR_COLUMNS = (
    "demand", "hour", "day_of_week", "lag_1", "lag_4", "rolling_mean_4",
    "target_15m", "target_30m", "target_60m",
)

# Q-learning rates.
Q_ALPHA = 0.1
Q_GAMMA = 0.9

# Zone centroids (zone_id, lat, lon) of the reference's saved zone map.
FIXED_ZONES = (
    ("0", 37.79839583782415, -122.50794496726378),
    ("1", 37.771050219083534, -122.41725927102163),
    ("2", 37.76859456561531, -122.46799018007198),
    ("3", 37.74321099917841, -122.40316620684268),
    ("4", 37.75688122638139, -122.5021115424324),
    ("5", 37.80500080695202, -122.40029762994337),
    ("6", 37.71296708089475, -122.40875070212162),
    ("7", 37.76375193426986, -122.43830149160452),
    ("8", 37.7230879208515, -122.47644411235316),
    ("9", 37.80399008513248, -122.44047982883328),
    ("10", 37.77478903011335, -122.36972567026211),
    ("11", 37.755158961830205, -122.44151296482728),
    ("12", 37.713788170311176, -122.3696207599602),
    ("13", 37.71920084559543, -122.50694272941664),
    ("14", 37.79587421988269, -122.3996214156619),
    ("15", 37.778733597120606, -122.42105672830482),
    ("16", 37.71978043526528, -122.4420666964264),
    ("17", 37.80483511147016, -122.36495985300712),
    ("18", 37.74266531679465, -122.36754846831484),
    ("19", 37.80162629337404, -122.47763868084834),
)

# Ride view over the driver's `events` table: three hotspots picked by
# event_id % 10 (< 5, < 8, else) and integer noise, as in FIXTURES F6.
EVENT_HOTSPOTS = ((37.75, -122.47), (37.79, -122.38), (37.78, -122.43))
EVENT_HOTSPOT_CUTS = (5, 8)
EVENT_NOISE_LAT = (7919, 31)      # (user_id *, event_id *) % 2001 - 1000
EVENT_NOISE_LON = (104729, 17)
EVENT_NOISE_MOD = 2001
EVENT_NOISE_SCALE = 50000.0

# --------------------------------------------------------------------------
# Our own defaults (not from the reference)
# --------------------------------------------------------------------------

INTERVAL_SECONDS = 15 * 60        # demand bin
SUPPLY_WINDOW_SECONDS = 5 * 60    # generator supply window
# Policy table time-of-day cut-offs (hour starts of Morning, Day, Evening,
# Night); the reference names the buckets but fixes no cut-offs.
TOD_CUTS = (6, 11, 17, 22)
# Largest zone table that is inlined as literals in the assignment
# expression (its size is checked before it is read).
MAX_INLINE_ZONES = 4096
# Sample seed.
SEED = 42
