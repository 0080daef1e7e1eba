"""Domain tables.

FIXED VALUES: the numbers, names and texts below must equal the source system's
for results to agree (valid ranges, unit factors, AQI breakpoints, categories,
thresholds, lookup maps). They are kept here as plain data, in their natural
order; the operators turn them into Column expressions or tiny broadcast tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — quality thresholds
# ---------------------------------------------------------------------------
MIN_RECORDS = 10
MAX_NULL_PERCENT = 20.0
MAX_DUPLICATE_PERCENT = 5.0
IQR_MIN_ROWS = 10          # pipeline IQR runs only when a run has more rows than this
IQR_MULTIPLIER = 1.5
ZSCORE_THRESHOLD = 3.0

# ---------------------------------------------------------------------------
# FIXED VALUES — valid ranges (µg/m³ unless noted)
# ---------------------------------------------------------------------------
# pipeline and helper profile: six pollutants
PIPELINE_RANGES = {
    "pm25": (0, 1000),
    "pm10": (0, 2000),
    "no2": (0, 1000),
    "o3": (0, 1000),
    "co": (0, 50000),
    "so2": (0, 2000),
}
# rules profile: thirteen parameters
RULE_RANGES = {
    "pm25": (0, 1000),
    "pm10": (0, 2000),
    "pm1": (0, 500),
    "no2": (0, 1000),
    "no": (0, 500),
    "nox": (0, 1500),
    "o3": (0, 1000),
    "co": (0, 50000),
    "so2": (0, 2000),
    "bc": (0, 100),
    "temperature": (-50, 60),
    "humidity": (0, 100),
    "pressure": (800, 1200),
}

# ---------------------------------------------------------------------------
# FIXED VALUES — unit conversion to µg/m³
# ---------------------------------------------------------------------------
# pipeline: first matching (parameter or '*', unit substring) wins
PIPELINE_CONVERSIONS = [
    ("co", "ppm", 1000),
    ("no2", "ppb", 1.88),
    ("o3", "ppb", 2.0),
    ("so2", "ppb", 2.62),
    ("*", "mg/m³", 1000),
]
# helper: any ppm x1000; ppb only for these; mg/m³ x1000
HELPER_PPB_FACTORS = [("no2", 1.88), ("o3", 2.0), ("so2", 2.62)]
HELPER_PPM_FACTOR = 1000
HELPER_MG_FACTOR = 1000
# rules: exact (parameter, unit) lookup, then ('*', unit), else 1.0
RULE_CONVERSIONS = [
    ("co", "ppm", 1145),
    ("no2", "ppm", 1880),
    ("o3", "ppm", 1960),
    ("so2", "ppm", 2620),
    ("co", "ppb", 1.145),
    ("no2", "ppb", 1.88),
    ("o3", "ppb", 1.96),
    ("so2", "ppb", 2.62),
    ("*", "mg/m³", 1000),
    ("*", "mg/m3", 1000),
]
TARGET_UNIT = "µg/m³"

# ---------------------------------------------------------------------------
# FIXED VALUES — AQI breakpoints (conc_lo, conc_hi, aqi_lo, aqi_hi, level)
# ---------------------------------------------------------------------------
LEVELS = ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
          "Very Unhealthy", "Hazardous"]
COLORS = ["#00E400", "#FFFF00", "#FF7E00", "#FF0000", "#8F3F97", "#7E0023"]
LEVELS_VI = ["Tốt", "Trung bình", "Kém (Unhealthy for Sensitive Groups)",
             "Xấu (Unhealthy)", "Rất xấu (Very Unhealthy)", "Nguy hiểm (Hazardous)"]

PM25_PIPELINE = [
    (0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 500, 301, 500),
]
PM25_HELPER = [
    (0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 500.4, 301, 500),
]
# top segment open: any value >= 250.5 maps to 500
PM25_OPEN_TOP = [
    (0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, None, 301, 500),
]
PM10 = [
    (0, 54, 0, 50),
    (55, 154, 51, 100),
    (155, 254, 101, 150),
    (255, 354, 151, 200),
    (355, 424, 201, 300),
    (425, 604, 301, 500),
]
PM10_OPEN_TOP = [
    (0, 54, 0, 50),
    (55, 154, 51, 100),
    (155, 254, 101, 150),
    (255, 354, 151, 200),
    (355, 424, 201, 300),
    (425, None, 301, 500),
]
O3_PPB = [
    (0, 54, 0, 50),
    (55, 70, 51, 100),
    (71, 85, 101, 150),
    (86, 105, 151, 200),
    (106, 200, 201, 300),
]
NO2_PPB = [
    (0, 53, 0, 50),
    (54, 100, 51, 100),
    (101, 360, 101, 150),
    (361, 649, 151, 200),
    (650, 1249, 201, 300),
    (1250, 2049, 301, 500),
]
CO_PPM = [
    (0, 4.4, 0, 50),
    (4.5, 9.4, 51, 100),
    (9.5, 12.4, 101, 150),
    (12.5, 15.4, 151, 200),
    (15.5, 30.4, 201, 300),
    (30.5, 50.4, 301, 500),
]
SO2_PPB = [
    (0, 35, 0, 50),
    (36, 75, 51, 100),
    (76, 185, 101, 150),
    (186, 304, 151, 200),
    (305, 604, 201, 300),
    (605, 1004, 301, 500),
]
BREAKPOINT_TABLES = {
    "pm25": PM25_HELPER,
    "pm10": PM10,
    "o3": O3_PPB,
    "no2": NO2_PPB,
    "co": CO_PPM,
    "so2": SO2_PPB,
}

# AQI categories: (min, max, level, color, health message)
AQI_CATEGORIES = [
    (0, 50, "Good", "#00E400", "Chất lượng không khí tốt"),
    (51, 100, "Moderate", "#FFFF00", "Chất lượng không khí chấp nhận được"),
    (101, 150, "Unhealthy for Sensitive Groups", "#FF7E00", "Không tốt cho nhóm nhạy cảm"),
    (151, 200, "Unhealthy", "#FF0000", "Không tốt cho sức khỏe"),
    (201, 300, "Very Unhealthy", "#8F3F97", "Rất không tốt cho sức khỏe"),
    (301, 500, "Hazardous", "#7E0023", "Nguy hiểm"),
]

# AQI level ladder upper bounds (≤50, ≤100, ≤150, ≤200, ≤300, else)
LADDER_BOUNDS = [50, 100, 150, 200, 300]

# daily-mean PM2.5 level used by the summary view; its third label differs
VIEW_PM25_BOUNDS = [12, 35.4, 55.4, 150.4, 250.4]
VIEW_LEVELS = ["Good", "Moderate", "Unhealthy for Sensitive", "Unhealthy",
               "Very Unhealthy", "Hazardous"]

# ---------------------------------------------------------------------------
# FIXED VALUES — alert thresholds
# ---------------------------------------------------------------------------
ALERT_THRESHOLDS = {
    "aqi_unhealthy": 150,
    "aqi_very_unhealthy": 200,
    "aqi_hazardous": 300,
    "pm25_who_guideline": 15,
    "pm25_vn_standard": 50,
    "pm10_who_guideline": 45,
    "pm10_vn_standard": 100,
}
STREAM_AQI_THRESHOLD = 150.0
ALERT_SLOT_HOURS = [7, 17]          # local hours that open a one-hour alert slot
LOCAL_OFFSET = "+07:00"
LOCAL_OFFSET_HOURS = 7
EMAIL_BATCH_SIZE = 50

# dashboard colour steps: (upper-exclusive bound, colour) ... then final colour
BANDS = {
    "pm25": ([12, 35, 55], ["green", "yellow", "orange", "red"]),
    "pm10": ([54, 154, 254], ["green", "yellow", "orange", "red"]),
    "alerts": ([1, 5], ["green", "yellow", "red"]),
}

# ---------------------------------------------------------------------------
# FIXED VALUES — lookup maps
# ---------------------------------------------------------------------------
POLLUTANT_CODES = {"p2": "pm25", "p1": "pm10", "o3": "o3", "n2": "no2", "s2": "so2", "co": "co"}
POLLUTANT_DISPLAY = {"p2": "PM2.5", "p1": "PM10", "o3": "O₃ mass", "n2": "NO₂ mass",
                     "s2": "SO₂ mass", "co": "CO mass"}
COUNTRY_CODES = {"Vietnam": "VN", "United States": "US", "China": "CN", "Thailand": "TH",
                 "Japan": "JP"}
# parameter-name aliases after cleaning (lower, ' mass'/' concentration' removed, '_' '.' -> ' ')
PARAM_ALIASES = [
    (["p2", "pm25", "pm2.5", "pm 2.5"], "pm25"),
    (["p1", "pm10", "pm 10"], "pm10"),
    (["n2", "no2", "nitrogen dioxide"], "no2"),
    (["o3", "ozone"], "o3"),
    (["co", "carbon monoxide"], "co"),
    (["s2", "so2", "sulfur dioxide"], "so2"),
    (["aqi", "aqius", "aqi_us", "aqi-us"], "aqi_us"),
]
PROVIDER = "IQAir"
DIM_CITY = "Hanoi"
DIM_COUNTRY = "Vietnam"
