"""Class codes, job statuses, thresholds and name patterns.

Everything here must equal the published product definition for results to be
right, so it is kept as plain text in one place.
"""

from __future__ import annotations

# --- fixed values: pixel classes -------------------------------------------
WET = 110
DRY = 115
SNOW_FREE = 120
NOT_WET = 125
CLOUD = 205
WATER = 210
FOREST = 220
NON_MOUNTAIN = 240
MASKED = 250
NODATA = 255

ICE_WATER = 1
ICE_ICE = 100
ICE_CLOUD = 205
ICE_OTHER = 254

SNOW_GAPS = (205, 255)
WET_SNOW_GAPS = (115, 120, 125, 200, 205, 210, 220, 230, 240, 255)

# (layer, code, meaning)
CLASS_CODES = (
    ("snow_fraction", 205, "cloud"),
    ("snow_fraction", 255, "nodata"),
    ("wet_dry_snow", 110, "wet snow"),
    ("wet_dry_snow", 115, "dry snow"),
    ("wet_dry_snow", 120, "snow free"),
    ("wet_dry_snow", 205, "cloud"),
    ("wet_dry_snow", 210, "water"),
    ("wet_dry_snow", 220, "forest"),
    ("wet_dry_snow", 250, "masked"),
    ("wet_dry_snow", 255, "nodata"),
    ("wet_snow", 110, "wet snow"),
    ("wet_snow", 125, "not wet"),
    ("wet_snow", 210, "water"),
    ("wet_snow", 220, "forest"),
    ("wet_snow", 240, "non mountain"),
    ("wet_snow", 250, "masked"),
    ("wet_snow", 255, "nodata"),
    ("river_ice", 1, "water"),
    ("river_ice", 100, "ice"),
    ("river_ice", 205, "cloud"),
    ("river_ice", 254, "other"),
    ("river_ice", 255, "nodata"),
    ("persistent_snow", 0, "no persistent snow"),
    ("persistent_snow", 1, "persistent snow"),
    ("persistent_snow", 255, "nodata"),
)
# (layer, lowest value, highest value)
VALUE_RANGES = (("snow_fraction", 0, 100), ("quality", 0, 3))

# --- fixed values: job statuses and log levels -----------------------------
JOB_STATUS = (
    (1, "initialized"),
    (2, "configured"),
    (3, "ready"),
    (4, "queued"),
    (5, "started"),
    (6, "pre_processing"),
    (7, "processing"),
    (8, "post_processing"),
    (9, "processed"),
    (10, "start_publication"),
    (11, "published"),
    (12, "done"),
    (13, "internal_error"),
    (14, "external_error"),
    (15, "error_checked"),
    (16, "cancelled"),
)
STATUS = {name: code for code, name in JOB_STATUS}

LOG_LEVELS = ((50, "CRITICAL"), (40, "ERROR"), (30, "WARNING"), (20, "INFO"), (10, "DEBUG"))

# previous status (0 = none) -> allowed next statuses
ALLOWED_NEXT = {
    0: (1, 5, 13, 16),
    1: (2, 13, 14, 16),
    2: (3, 13, 16),
    3: (4, 13, 14, 16),
    4: (5, 13),
    5: (6, 13, 14, 16),
    6: (7, 13, 14, 16),
    7: (8, 13, 14, 16),
    8: (9, 13, 14, 16),
    9: (10, 12, 13, 14, 16),
    10: (11, 13, 14, 16),
    11: (12,),
    12: (13, 14),
    13: (13, 14, 15),
    14: (5, 13, 14, 15),
    15: (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16),
    16: (13,),
}

# minutes a job may stay in a status before it counts as stuck
STUCK_MINUTES = {4: 60, 5: 30, 6: 30, 7: 270}
PUBLICATION_RETRIES = 3

# --- fixed values: planning thresholds -------------------------------------
BACKWARD_JOBS = 8
CONSECUTIVE_DAYS = 60
NRT_SOURCE_HOURS = 24
NRT_HUB_HOURS = 3
HOLD_HOURS = 3
REACH_LIMIT = 70000
MIN_OVERLAP_M2 = 10 * 1e6
SEARCH_GAP_DAYS = 5
KPI_HOURS = 3

# family -> (lower, upper) jobs created on a nominal day
PRODUCTION_BANDS = (
    ("optical", 400, 600),
    ("radar_ice", 80, 120),
    ("paired_ice", 80, 150),
    ("wet_snow", 150, 300),
    ("gap_filled", 850, 1150),
)

# --- fixed values: snow season statistics ----------------------------------
PERSISTENT_RATIO = 0.95
SUPPORT_ERROR = 5
SUPPORT_WARNING = 20

# --- fixed values: radar thresholds (dB, degrees) --------------------------
RATIO_STEPS = (-4.0, -3.5, -3.0, -2.5)
ANGLE_LOW = 20.0
ANGLE_HIGH = 45.0
ANGLE_WEIGHT = 0.5
NOISE_VH_DB = 32
NOISE_VV_DB = 30

# --- fixed values: name patterns -------------------------------------------
OPTICAL_SCENE = (
    r"(?i)^(S2A|S2B)_(MSI)(L1C)_(\d{8}T\d{6})_N(\d{4})_R(\d{3})_T([A-Z0-9]{5})_(\d{8}T\d{6})\.SAFE"
)
RADAR_SCENE = (
    r"(?i)^(S1A|S1B)_(S1|S2|S3|S4|S5|S6|IW|EW|WV)_(SLC|GRD|OCN)(F|H|M)_(1|2)(S|A)(SH|SV|DH|DV)_"
    r"(\d{8}T\d{6})_(\d{8}T\d{6})_(\d{6})_([A-Z0-9]{6})_([A-Z0-9]{4})\.SAFE"
)
SNOW_ICE_PRODUCT = (
    r"^([A-Z][A-Z0-9]+)_(\d{8}T\d{6}|\d{8}-\d{3}|\d{8}P\d+[DMY])_([A-Z0-9-]+)_T?([A-Z0-9]{5,6})_V(\d+)(?:_([0-9]+))?$"
)
TILE_NAME = r"^T?[0-9]{2}[A-Z0-9]{3}$"
LAEA_TILE_NAME = r"^[WE][0-9]{2}[SN][0-9]{2}$"

# --- fixed values: observation type codes ----------------------------------
SENSOR_CODES = (("Sentinel-1", 1), ("Sentinel-2", 2), ("Sentinel-1 Sentinel-2", 0))
SENSOR_OTHER = 999
