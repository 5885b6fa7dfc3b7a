"""Reference tables of the AIS domain.

Everything in this module is a FIXED VALUE: it must equal the published code tables (ITU-R M.585
country digits, ITU-R M.1371 status and ship-type codes) and the agreed boxes, limits and weights,
or results change.
"""

from __future__ import annotations

# Maritime identification digits -> ISO 3166-1 alpha-2 flag. Unlisted digits give no flag.
FLAG_BY_MID = {
    "204": "PT", "211": "DE", "215": "MT", "218": "DE", "219": "DK", "220": "DK",
    "224": "ES", "225": "ES", "226": "FR", "227": "FR", "228": "FR", "229": "MT",
    "232": "GB", "233": "GB", "234": "GB", "235": "GB", "244": "NL", "245": "NL",
    "246": "NL", "247": "IT", "248": "MT", "249": "MT", "255": "PT", "256": "MT",
    "257": "NO", "258": "NO", "259": "NO", "263": "PT", "265": "SE", "266": "SE",
    "269": "CH", "271": "TR", "273": "RU", "275": "LV", "276": "EE", "277": "LT",
    "278": "SI", "303": "US", "338": "US", "366": "US", "367": "US", "368": "US",
    "369": "US", "412": "CN", "413": "CN", "414": "CN", "416": "TW", "431": "JP",
    "432": "JP", "440": "KR", "441": "KR", "477": "HK", "503": "AU", "512": "NZ",
    "518": "CK", "632": "GN", "636": "LR", "637": "LR", "657": "NG", "667": "SL",
    "674": "TZ", "677": "TZ", "701": "AR", "710": "BR", "720": "BO",
}

# Navigational status codes; any other non-null code is labelled unknown_<code>.
NAV_STATUS = {
    0: "under_way_engine",
    1: "at_anchor",
    2: "not_under_command",
    3: "restricted_manoeuvrability",
    4: "constrained_by_draught",
    5: "moored",
    6: "aground",
    7: "engaged_in_fishing",
    8: "under_way_sailing",
    11: "towing_astern",
    12: "pushing_or_towing_alongside",
    14: "ais_sart_active",
    15: "undefined",
}

# Ship-type codes as inclusive ranges; any other non-null code is "other".
SHIP_TYPE_RANGES = [
    (0, 0, "unknown"),
    (20, 29, "wing_in_ground"),
    (30, 30, "fishing"),
    (31, 32, "tug"),
    (33, 35, "special_craft"),
    (36, 37, "sailing_or_pleasure"),
    (40, 49, "high_speed_craft"),
    (50, 51, "special_craft"),
    (52, 52, "tug"),
    (53, 59, "special_craft"),
    (60, 69, "passenger"),
    (70, 79, "cargo"),
    (80, 89, "tanker"),
    (90, 99, "other"),
]
SHIP_TYPE_FALLBACK = "other"
SHIP_TYPE_MISSING = "unknown"

# Speed limit in knots per ship category.
SPEED_LIMIT_KNOTS = {
    "cargo": 25.0,
    "tanker": 18.0,
    "fishing": 15.0,
    "passenger": 30.0,
    "tug": 14.0,
    "special_craft": 20.0,
    "sailing_or_pleasure": 20.0,
    "high_speed_craft": 50.0,
    "wing_in_ground": 100.0,
    "other": 35.0,
    "unknown": 35.0,
}
DEFAULT_SPEED_LIMIT_KNOTS = 35.0

# Ship categories with their own port_traffic column; all others count as other_vessels.
NAMED_PORT_CATEGORIES = [
    "cargo", "tanker", "passenger", "fishing", "tug",
    "special_craft", "sailing_or_pleasure", "high_speed_craft",
]

# Ocean boxes (lat_min, lat_max, lon_min, lon_max, region), inclusive; the first match wins.
OCEAN_BOXES = [
    (30.0, 37.0, -6.0, 37.0, "mediterranean"),
    (37.0, 46.0, -1.2, 27.5, "mediterranean"),
    (65.0, 90.0, -180.0, 180.0, "arctic_ocean"),
    (-90.0, -60.0, -180.0, 180.0, "southern_ocean"),
    (18.0, 50.0, -98.0, -60.0, "atlantic_ocean"),
    (9.2, 18.0, -88.0, -60.0, "atlantic_ocean"),
    (1.0, 60.0, 103.0, 147.0, "pacific_west"),
    (-60.0, 30.0, 20.0, 147.0, "indian_ocean"),
    (-60.0, 65.0, -70.0, 20.0, "atlantic_ocean"),
    (-60.0, 65.0, -180.0, -70.0, "pacific_east"),
    (-60.0, 65.0, 147.0, 180.0, "pacific_west"),
]
OCEAN_FALLBACK = "open_ocean"

# Port boxes (centre_lat, centre_lon, half_width_degrees, port, country).
PORT_BOXES = [
    (51.9, 4.1, 0.5, "Rotterdam", "NL"),
    (53.5, 9.9, 0.5, "Hamburg", "DE"),
    (31.2, 121.5, 0.5, "Shanghai", "CN"),
    (22.3, 114.2, 0.3, "Hong Kong", "HK"),
    (1.26, 103.8, 0.5, "Singapore", "SG"),
    (35.4, 139.7, 0.5, "Tokyo", "JP"),
    (33.7, -118.2, 0.5, "Los Angeles", "US"),
    (40.7, -74.0, 0.5, "New York", "US"),
    (-23.9, -46.3, 0.5, "Santos", "BR"),
    (18.9, 72.8, 0.5, "Mumbai", "IN"),
    (25.2, 55.3, 0.3, "Dubai", "AE"),
    (31.26, 32.3, 0.3, "Port Said", "EG"),
    (37.9, 23.7, 0.3, "Piraeus", "GR"),
    (41.3, 2.1, 0.3, "Barcelona", "ES"),
    (43.3, 5.4, 0.3, "Marseille", "FR"),
]

# Destination texts that mean "not given" (after upper and trim).
EMPTY_DESTINATIONS = [
    "", "NULL", "NONE", "N/A", "NA", "NIL", "UNKNOWN",
    "?", ".", "0", "00", "000", "TBD", "TBA",
]

# AIS "not available" values.
SOG_NOT_AVAILABLE = 102.3
COG_NOT_AVAILABLE = 360.0
HEADING_NOT_AVAILABLE = 511

# Distances.
EARTH_RADIUS_KM = 6371.0
KM_PER_NAUTICAL_MILE = 1.852
FLAT_KM_PER_DEGREE = 111.0

# Alert rules of the live path.
ALERT_SPEED_LIMIT_KNOTS = 35.0
SPOOFING_SPEED_CHANGE = 5.0
SUDDEN_SPEED_CHANGE = 10.0
SILENCE_MINUTES = 120

# Risk weights: dark points, port-change gaps, spoofing signals, speed anomalies, loiter events.
RISK_WEIGHTS = {
    "dark_score": 10, "port_change_gaps": 8, "spoofing_signals": 15,
    "speed_anomalies": 5, "loiter_events": 3,
}
DARK_SEVERITY_POINTS = {"CRITICAL": 3, "HIGH": 2}

SOURCE_SYSTEM = "aisstream_live"
PIPELINE_VERSION = "dev"
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
