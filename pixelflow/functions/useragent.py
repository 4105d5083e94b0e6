"""User-agent classification by ordered native rules (first hit wins).

A rule is (pattern, name); ``{}`` in a name takes the pattern's first group.
The classifier is one CASE expression generated from the rules.
"""

from pyspark.sql import Column, functions as F

from pixelflow.functions._util import col

# --- fixed values: ordered (regex, display name) rules ---
BOT = r"(?i)bot\b|crawler|spider|slurp"
OS_RULES = (
    (BOT, "Unknown"),
    (r"Windows Phone", "Windows Phone"),
    (r"Windows NT 10", "Windows 10"),
    (r"Windows NT 6\.3", "Windows 8.1"),
    (r"Windows NT 6\.2", "Windows 8"),
    (r"Windows NT 6\.1", "Windows 7"),
    (r"Windows NT 6\.0", "Windows Vista"),
    (r"Windows NT 5\.[12]", "Windows XP"),
    (r"Windows", "Windows"),
    (r"Android ([0-9]+)", "Android {}.x"),
    (r"Android", "Android"),
    (r"iPad.* OS ([0-9]+)_", "iOS {} (iPad)"),
    (r"iPhone OS ([0-9]+)", "iOS {} (iPhone)"),
    (r"iPod.* OS ([0-9]+)_", "iOS {} (iPod)"),
    (r"Mac OS X", "Mac OS X"),
    (r"CrOS", "Chrome OS"),
    (r"BlackBerry|BB10", "BlackBerryOS"),
    (r"Linux|X11", "Linux"),
)
BROWSER_RULES = (
    (BOT, "Robot/Spider"),
    (r"Edg(?:e|A|iOS)?/([0-9]+)", "Microsoft Edge {}"),
    (r"OPR/([0-9]+)", "Opera {}"),
    (r"Opera", "Opera"),
    (r"IEMobile/([0-9]+)", "IE Mobile {}"),
    (r"MSIE ([0-9]+)", "Internet Explorer {}"),
    (r"Trident/7", "Internet Explorer 11"),
    (r"(?:Chrome|CriOS)/([0-9]+)", "Chrome {}"),
    (r"(?:Firefox|FxiOS)/([0-9]+)", "Firefox {}"),
    (r"Android.* Version/", "Android Browser"),
    (r"Safari/", "Safari"),
)
UNKNOWN_NAME = "Unknown"


def _classify(ua: Column, rules, default: str) -> Column:
    expr = F
    for pattern, name in rules:
        before, mark, after = name.partition("{}")
        value = F.concat(F.lit(before), F.regexp_extract(ua, pattern, 1), F.lit(after)) if mark else F.lit(name)
        expr = expr.when(ua.rlike(pattern), value)
    return expr.otherwise(F.lit(default))


def classify_os(ua, rules=OS_RULES) -> Column:
    """OS display name of a user-agent string."""
    return _classify(F.coalesce(col(ua), F.lit("")), rules, UNKNOWN_NAME)


def classify_browser(ua, rules=BROWSER_RULES) -> Column:
    """Browser display name of a user-agent string."""
    return _classify(F.coalesce(col(ua), F.lit("")), rules, UNKNOWN_NAME)
