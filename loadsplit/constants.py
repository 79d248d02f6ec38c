"""Fixed values that must equal the reference's for identical results.

Fixed values (natural order, as published by the reference pipeline):
"""

# --- fixed values -----------------------------------------------------------
INTERVALS_PER_DAY = 96
PEAK_START_HOUR = 6            # peak is [6, 21)
PEAK_END_HOUR = 21
AC_PROXY_TEMP_C = 23.0         # strictly greater
N_CLUSTERS = 5
RANDOM_SEED = 42
N_INIT = 10                    # best of 10 initialisations (local path)
MAX_ITER = 20                  # notebook path
MIN_CONFIDENCE = 0.3
MIN_MAX_DISTANCE = 1e-9

SUMMARY_APPLIANCE_COLUMNS = ("hvac_kwh", "washer_kwh", "dryer_kwh", "cooking_kwh", "baseline_kwh")

RAW_COLUMNS = (
    "ESIID", "USAGE_DATE", "REVISION_DATE", "USAGE_START_TIME",
    "USAGE_END_TIME", "USAGE_KWH", "ESTIMATED_ACTUAL",
    "CONSUMPTION_SURPLUSGENERATION",
)
USAGE_DATE_FORMAT = "M/d/yyyy"           # one or two digits, as the reference's parser takes them
REVISION_TS_FORMAT = "M/d/yyyy H:m:s"
INTERVAL_START_FORMAT = "yyyy-MM-dd H:m"
METER_FILE_GLOB = "????????.csv"
METER_PATH_REGEX = r"^\d{4}/\d{2}/\d{8}\.csv$"   # below the data root

# per-file quality warnings (Q5): texts and separator
ISSUE_SEPARATOR = "; "
ISSUE_INTERVAL_COUNT = "file holds %d rows instead of {expected}"
ISSUE_NULL_KWH = "kWh missing in %d rows"
ISSUE_NEGATIVE_KWH = "kWh below zero in %d rows"
ISSUE_DUPLICATES = "%d rows repeat a meter and slot"

# rule-based load bands (dashboard); hour windows are inclusive
BAND_HVAC_DAY_HOURS = (10, 22)
BAND_MORNING_HOURS = (6, 8)
BAND_COOKING_EVENING_HOURS = (18, 20)
BAND_COOKING_NOON_HOURS = (12, 13)
BAND_WASHER_HOURS = (8, 17)
BAND_DRYER_HOURS = (9, 18)
BAND_BASELINE_CAP = 0.15
BAND_HOT_C = 23.0
BAND_HVAC_SPAN_C = 15.0
BAND_HVAC_DAY_FACTOR = 0.6     # hours 10..22 inclusive
BAND_HVAC_NIGHT_FACTOR = 0.2
BAND_MORNING_FACTOR = 0.35     # hours 6..8, kWh > 0.25
BAND_MORNING_MIN_KWH = 0.25
BAND_COOKING_EVENING = 0.40    # hours 18..20
BAND_COOKING_NOON = 0.25       # hours 12..13
BAND_WASHER_FACTOR = 0.20      # hours 8..17, kWh > 0.3
BAND_WASHER_MIN_KWH = 0.3
BAND_DRYER_FACTOR = 0.25       # hours 9..18, kWh > 0.35
BAND_DRYER_MIN_KWH = 0.35
BAND_SCALE_FLOOR = 1e-9

# cooling-load curve of the simulator (kW by outdoor temperature)
COOLING_KNEE_1_C = 22.0
COOLING_KNEE_2_C = 26.0
COOLING_KNEE_3_C = 32.0
COOLING_LIGHT_KW = 0.8
COOLING_MODERATE_KW = 1.2
COOLING_HEAVY_BASE_KW = 2.0
COOLING_HEAVY_SLOPE = 0.25
COOLING_MAX_KW = 3.5
NIGHT_FACTOR = 0.3             # hour < 7 or hour >= 23
NIGHT_END_HOUR = 7
NIGHT_START_HOUR = 23
HOURS_PER_INTERVAL = 0.25

FAHRENHEIT_AC_THRESHOLD = 73.4
