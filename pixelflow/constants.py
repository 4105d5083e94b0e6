"""Fixed values the jobs must share with the original log format.

Everything in this module is a fixed value (field order, lookup tables,
regular expressions, markers); none of it is derived from data.
"""

# --- fixed values: impression log field order (tab separated, 59 fields) ---
LOG_FIELDS = (
    "bid", "wp_bucket", "ad_slot_id", "visibility", "geo_location",
    "google_id", "setting_id", "user_seg_list", "verticle_list", "date",
    "timestamp", "campaign_name", "jid", "campaign_id", "adgroup_id",
    "creative_id", "domain", "deal_id", "ip", "user_agent",
    "cookie", "service_type", "st_campaign_id", "st_adgroup_id", "st_creative_id",
    "click_flag", "imp_flag", "click_timestamp", "min_bid", "platform_type",
    "geo_target_id", "mobile", "model_id", "model_score", "gid_age",
    "audience_id", "browser", "os", "device", "creative_size",
    "sqi", "err_flag", "flag", "app_id", "carrier_id",
    "device_type", "is_app", "is_initial_request", "platform", "screen_orientation",
    "device_id", "location", "device_make", "device_model", "device_id_type",
    "seller_id", "geofence_id", "geo_long", "geo_lat",
)
# The CTR job reads the first 56 fields only (up to seller_id).
CTR_FIELD_COUNT = 56

# --- fixed values: hour (two-digit text) -> hour group ---
HOUR_GROUPS = {
    "07": "1", "08": "1", "09": "1", "10": "1", "11": "1", "12": "1", "13": "1",
    "14": "2", "15": "2", "16": "2", "17": "2",
    "18": "3", "19": "3", "20": "3", "21": "3", "22": "3", "23": "3", "00": "3",
    "01": "4", "02": "4", "03": "4", "04": "4", "05": "4", "06": "4",
}
# Hour groups the rate job aggregates.
RATE_HOUR_GROUPS = ("1", "2", "3", "4")

# --- fixed values: missing-value markers ---
MISSING = "-"
MISSING_TEXTS = ("", "unknown", "null")   # compared case-insensitively
CTR_NULL = "null"
NO_DETECTION = "NO_DETECTION"

# --- fixed values: regular expressions (Java regex syntax) ---
RE_CMPN = r'"cmpn":"(\w+?)"'              # retargeting pixel id
RE_BRWSOS = r'"brwsos":"(.+?)"'           # retargeting user agent
RE_CONV_HOUR = r'"date":".+? (\d+?):.+?"'  # hour inside the payload date
RE_STATE = r'"st":"(.+?)"'                # retargeting state
RE_DATE = r'"date":"(.+?)"'               # retargeting date text
RE_HOUR = r'(\d\d?):.+?'                  # hour in a formatted timestamp
RE_SEQ_HOUR = r'\s(\d\d?):.+?'            # hour after a blank
RE_BROWSER_DROP = r'[^a-zA-Z]'            # browser family: letters only
RE_OS_DROP = r'\s|(\(.+?\))|\.[a-zA-Z0-9]+?'  # OS family: drop blanks, (...), .x

# Smoothed conversion rate (conv + 1) / (imp + 1000), 8 decimals.
RATE_PRIOR_CONV = 1.0
RATE_PRIOR_IMP = 1000.0
RATE_DECIMALS = 8

# Tag values of the text intermediate format.
TAG_IMP = "IMP"
TAG_CONV = "CONV"

# Retargeting log: first field (cookie) of this length marks a retargeting line.
COOKIE_LENGTH = 32

# Output date format of epoch-millisecond timestamps (UTC).
EPOCH_FORMAT = "yyyyMMdd HH:mm:ss"
DAY_FORMAT = "yyyyMMdd"
