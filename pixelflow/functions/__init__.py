"""Column functions (built-in Spark expressions only, no Python UDFs)."""

from pixelflow.functions.markers import norm_marker
from pixelflow.functions.text import (payload_extract, clean_browser, clean_os,
                                      first_group)
from pixelflow.functions.dates import format_epoch_ms, day_shift
from pixelflow.functions.hours import (hour_group, hour_group_impressions,
                                       hour_group_conversions, hour_group_ctr)
from pixelflow.functions.geo import geo_parts, geo_state, geo_dma, ctr_state
from pixelflow.functions.useragent import classify_os, classify_browser
from pixelflow.functions.weights import (argmax_of, pick_top, rank_pairs, weighted_argmax,
                                         weighted_pairs, weighted_pick)
from pixelflow.functions.scalars import (click_flag, viewability, ctr_ratio,
                                         smoothed_rate, join_slice)

__all__ = [
    "norm_marker", "payload_extract", "clean_browser", "clean_os", "first_group",
    "format_epoch_ms", "day_shift", "hour_group", "hour_group_impressions",
    "hour_group_conversions", "hour_group_ctr", "geo_parts", "geo_state", "geo_dma",
    "ctr_state", "classify_os", "classify_browser", "weighted_argmax",
    "weighted_pick", "weighted_pairs", "argmax_of", "rank_pairs", "pick_top", "click_flag", "viewability", "ctr_ratio", "smoothed_rate",
    "join_slice",
]
